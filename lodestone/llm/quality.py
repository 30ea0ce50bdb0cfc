"""A quality classifier whose document evidence is combined with hierarchical empirical Bayes for sites."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import durable, salted_lookup, seeded, table
from lodestone.llm.logistic import fit_logistic
from lodestone.llm.sharding import stratum_of

#: Labelled rows that the document classifier is fitted on, at most: those first in a seeded order.
TRAIN_ROWS = 8000
SEED = 19
#: Documents are kept from this posterior on.
KEEP = 0.5
#: Priors are worth at most and at least so many documents.
STRENGTH = (1.0, 1e6)

FEATURES = ("size", "upper", "digits", "shouting", "bars", "marks", "lines", "word_length", "distinct_words", "distinct_lines")


def text_features(text: Column) -> dict[str, Column]:
    """Numbers that describe a text's form, from built-in functions over the whole text; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    n = F.greatest(F.length(text), F.lit(1)).cast("double")
    count = lambda c: (F.length(text) - F.length(F.replace(text, F.lit(c), F.lit("")))) / n
    words, lines = F.split(text, r"[\x20\x09-\x0D]+"), F.split(text, r"\n+")
    return {
        "size": F.log1p(n),
        "upper": F.regexp_count(text, F.lit(r"[A-ZÀ-ÖØ-Þ]")) / n,
        "digits": F.regexp_count(text, F.lit(r"[0-9]")) / n,
        "shouting": count("!"),
        "bars": count("|"),
        "marks": count("#") + count("*"),
        "lines": count("\n"),
        "word_length": F.log1p(n / F.size(words)),
        "distinct_words": F.size(F.array_distinct(words)) / F.size(words),
        "distinct_lines": F.size(F.array_distinct(lines)) / F.size(lines),
    }


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, seed: int = SEED) -> DataFrame:
    """FEATURES and quality of at most `rows` labelled documents whose crc32(doc_id) mod 3 is not 1."""
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = usable.orderBy(seeded(seed, "doc_id"), "doc_id").limit(rows)  # bounded, so it may be broadcast
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return found.select(*[c.cast("double").alias(k) for k, c in text_features(F.col("text")).items()], F.col("quality").cast("double").alias("quality"))


def document_logit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, seed: int = SEED):
    """A column function: the log-odds that a text is good, from a logistic regression on FEATURES and their squares."""
    found = training_rows(docs, labels, rows, seed).collect()  # at most `rows` rows of numbers
    x = np.array([[r[k] for k in FEATURES] for r in found], dtype=float).reshape(-1, len(FEATURES))
    mean = x.mean(axis=0) if len(x) else np.zeros(len(FEATURES))
    scale = np.where(x.std(axis=0) > 1e-9, x.std(axis=0), 1.0) if len(x) else np.ones(len(FEATURES))
    z = np.clip((x - mean) / scale, -6, 6)
    w = fit_logistic(np.column_stack([z, z * z]), np.array([r["quality"] for r in found], dtype=float))

    def logit(parts: dict[str, Column]) -> Column:
        out = F.lit(float(w[0]))
        for i, k in enumerate(FEATURES):
            v = F.greatest(F.lit(-6.0), F.least(F.lit(6.0), (parts[k] - float(mean[i])) / float(scale[i])))
            out = out + v * float(w[1 + i]) + v * v * float(w[1 + len(FEATURES) + i])
        return F.greatest(F.lit(-30.0), F.least(F.lit(30.0), out))

    return logit


def prior_strength(groups: DataFrame, n: str, mean: str, above: str, within: float) -> float:
    """How many documents a prior is worth: by moments, from how far the groups' means spread around those above.

    One row of sums reaches the driver. Spread no larger than chance makes the strongest prior.
    """
    low, high = STRENGTH
    q, k, total, squares = groups.agg(
        F.sum(F.col(n) * (F.col(mean) - F.col(above)) ** 2), F.count(F.lit(1)), F.sum(n), F.sum(F.col(n).cast("double") ** 2)
    ).first()
    if not k or total <= 0 or total - squares / total <= 0:
        return high
    between = (q - (k - 1) * within) / (total - squares / total)
    return min(high, max(low, within / between - 1)) if between > within / high else high


def site_posteriors(scored: DataFrame) -> tuple[DataFrame, float, float]:
    """host, path, n, s and prior of each path; the global rate; the worth of a host's posterior as its paths' prior.

    `scored` has host, path and p, the classifier's probability. Sums are taken per path, then per host from
    the paths' sums. A host's posterior shrinks its mean towards the global rate, a path's towards its host.
    """
    paths = durable(scored.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("s")))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s"))
    total, good = hosts.agg(F.sum("host_n"), F.sum("host_s")).first()
    rate = min(1 - 1e-6, max(1e-6, good / total)) if total else 0.5
    within = rate * (1 - rate)
    hosts = hosts.withColumns({"mean": F.col("host_s") / F.col("host_n"), "above": F.lit(rate)})
    worth = prior_strength(hosts, "host_n", "mean", "above", within)
    hosts = hosts.withColumn("prior", (F.col("host_s") + worth * rate) / (F.col("host_n") + worth))
    joined = paths.join(hosts.select("host", "prior", F.col("mean").alias("host_mean")), "host")
    path_worth = prior_strength(joined.withColumn("mean", F.col("s") / F.col("n")), "n", "mean", "host_mean", within)
    return joined.select("host", "path", "n", "s", "prior"), rate, path_worth


def quality_scores(docs: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None, rows: int = TRAIN_ROWS, seed: int = SEED, keep: float = KEEP) -> DataFrame:
    """doc_id, host, path, document_score, site_rate, score and kept of each row.

    A document's odds are the classifier's, times the odds of its path's posterior over the global odds.
    That posterior is formed without the document itself, so a path of one document says what its host
    does, and a host of one what all do. Hosts are `source` and paths `source` and `lang` unless given.
    Texts are read once and not shuffled; a site of any size is summed in parts and looked up by salted
    keys.

    Null hosts and paths are sites of their own; null texts count as empty, and an empty text has the features of no
    words; very long texts are read whole. Equal scores are kept or left alike. Without labels every document
    score is 0.5. Repeated rows are kept, each as a document. An empty table gives an empty result. Other
    columns are not read.
    """
    host = stratum_of(F.col("source") if host is None else host)
    path = F.concat(host, F.lit("/"), stratum_of(F.col("lang") if path is None else path))
    logit = document_logit(docs, labels, rows, seed)
    parts = docs.select("doc_id", host.alias("host"), path.alias("path"), *[c.alias(k) for k, c in text_features(F.col("text")).items()])
    scored = parts.select("doc_id", "host", "path", logit({k: F.col(k) for k in FEATURES}).alias("logit"))
    scored = durable(scored.withColumn("p", 1 / (1 + F.exp(-F.col("logit")))))
    sites, rate, worth = site_posteriors(scored)
    found = salted_lookup(scored, durable(sites), ["host", "path"], "n", scored.count(), ["doc_id", "logit"])
    others = (F.col("s") - F.col("p") + worth * F.col("prior")) / (F.col("n") - 1 + worth)
    site = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), others))
    score = 1 / (1 + F.exp(-(F.col("logit") + F.log(site / (1 - site)) - float(np.log(rate / (1 - rate))))))
    return found.select("doc_id", "host", "path", F.col("p").alias("document_score"), site.alias("site_rate"), score.alias("score")).withColumn("kept", F.col("score") >= keep)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op10_quality": query}
ORACLES: dict[str, str] = {}
