"""Secrets in texts: three base patterns, and runs that look random to character Markov models."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import seeded, table

#: Kinds in their order; `markov` spans are added by the models.
KINDS = ("assign", "access", "hex", "markov")
# Fixed patterns and lengths of the base kinds.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Runs that the models judge.
RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{8,}"
#: The models' alphabet; other characters share one more symbol, and an edge of a run is another.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-."
#: Documents that the models are trained on, at most: those first in a seeded order.
TRAIN_ROWS = 4000
SEED = 23
#: Mean log-likelihood ratio for a character, in nats, from which a run counts as random; runs shorter than SURE characters
#: need as much in all as one of that length.
RATIO, SURE = 0.8, 16
CHUNK = 256


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once, however often the body's loops use it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(lengths: Column) -> Column:
    """Sums of the first 0, 1, 2 ... numbers of an array, one fewer than there are.

    Summed in chunks, so that an array of n numbers takes about n * (CHUNK + n / CHUNK) steps, not n * n.
    """
    total = lambda a: F.aggregate(a, F.lit(0), lambda x, y: x + y)
    last = F.floor(F.greatest(F.size(lengths) - 1, F.lit(0)) / CHUNK).cast("int")
    chunks = F.transform(F.sequence(F.lit(0), last), lambda c: total(F.slice(lengths, c * CHUNK + 1, F.lit(CHUNK))))

    def sums(chunk: Column) -> Column:
        def upto(i: Column) -> Column:
            c = F.floor(i / CHUNK).cast("int")
            return total(F.slice(chunk, F.lit(1), c)) + total(F.slice(lengths, c * CHUNK + 1, i - c * CHUNK))

        return F.transform(F.sequence(F.lit(0), F.size(lengths) - 1), upto)

    return _let(chunks, sums)


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches: array of (start, end, matched, wanted group), in code points, end exclusive."""
    found = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("w"), F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("g"), F.split(text, pattern, -1).alias("b"))

    def placed(p: Column) -> Column:
        whole, wanted, between = (p.getField(k) for k in "wgb")
        # the gap before each match and the match itself, in turn
        lengths = F.flatten(F.transform(whole, lambda m, i: F.array(F.length(F.element_at(between, i + 1)), F.length(m))))

        def spans(starts: Column) -> Column:
            start = lambda i: F.element_at(starts, 2 * i + 2)
            return F.transform(whole, lambda m, i: F.struct(start(i).alias("start"), (start(i) + F.length(m)).alias("end"), m.alias("text"), F.element_at(wanted, i + 1).alias("group")))

        return _let(lengths, lambda n: _let(_running(n), spans))

    return F.when(F.size(found.getField("w")) > 0, _let(found, placed)).otherwise(F.array().cast(_SPAN))


_SPAN = "array<struct<start:int,end:int,text:string,group:string>>"


def base_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text (null: empty) and the base spans: assign, access, hex. Texts are tested by substrings first."""
    none = F.array().cast(_SPAN)
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    low = F.lower("text")
    worded = F.lit(False)
    for w in ASSIGN_WORDS:
        worded = worded | F.contains(low, F.lit(w))
    marked = docs.withColumns({"_a": worded, "_k": F.contains("text", F.lit("AKIA")), "_h": F.col("text").rlike(f"(?<![0-9a-f])[0-9a-f]{{{HEX_LEAST}}}")})
    return marked.select(
        "doc_id",
        "text",
        F.when(F.col("_a"), F.filter(_matches(F.col("text"), ASSIGN, 2), lambda m: F.length(m.getField("group")) >= ASSIGN_LEAST)).otherwise(none).alias("assign"),
        F.when(F.col("_k"), F.filter(_matches(F.col("text"), ACCESS), lambda m: F.length(m.getField("text")) >= ACCESS_LEAST)).otherwise(none).alias("access"),
        F.when(F.col("_h"), F.filter(_matches(F.col("text"), rf"(?<![0-9a-f])[0-9a-f]{{{HEX_LEAST},}}"), lambda m: F.length(m.getField("text")) >= HEX_LEAST)).otherwise(none).alias("hex"),
    )


def training_strings(docs: DataFrame, rows: int = TRAIN_ROWS, seed: int = SEED) -> DataFrame:
    """label and string from at most `rows` documents: `random` are values of base spans, `ordinary` the other words.

    A word is a run of the alphabet of 6 characters or more; runs that touch a base value are left out.
    """
    chosen = docs.select("doc_id").filter(F.col("doc_id").isNotNull()).orderBy(seeded(seed, "doc_id"), "doc_id").limit(rows).distinct()
    sample = base_spans(docs.join(F.broadcast(chosen), "doc_id"))
    value = lambda name, part: F.transform(name, lambda m: m.getField(part))
    values = F.array_distinct(F.concat(value("assign", "group"), value("access", "text"), value("hex", "text")))
    words = F.array_distinct(F.regexp_extract_all("text", F.lit(r"[A-Za-z0-9+/_=.-]{6,}"), F.lit(0)))
    found = sample.select(values.alias("values"), words.alias("words"))
    ordinary = F.filter("words", lambda w: ~F.exists("values", lambda v: F.contains(w, v) | F.contains(v, w)))
    random = found.select(F.lit("random").alias("label"), F.explode("values").alias("string"))
    return random.unionByName(found.select(F.lit("ordinary").alias("label"), F.explode(ordinary).alias("string")))


def _symbol(c: Column) -> Column:
    """0 for an edge, 1 for a character outside the alphabet, then the alphabet."""
    return F.when(c == "", F.lit(0)).otherwise(F.instr(F.lit(ALPHABET), c) + 1)


SYMBOLS = len(ALPHABET) + 2


def log_ratios(strings: DataFrame) -> list[float]:
    """For each pair of symbols, the log-ratio of its chance under the random and the ordinary model.

    First-order chains with an edge symbol before the string. Counts are smoothed towards the uniform
    chain, so that without samples of a label its model is the uniform one. SYMBOLS ** 2 numbers per
    label at most reach the driver.
    """
    first = _symbol(F.substring("string", 1, 1))
    codes = F.transform(F.expr("sequence(1, length(string))"), lambda i: F.when(i == 1, first).otherwise(_symbol(F.col("string").substr(i - 1, F.lit(1))) * SYMBOLS + _symbol(F.col("string").substr(i, F.lit(1)))))
    counts = {(r["label"], r["code"]): r["count"] for r in strings.filter("length(string) > 0").select("label", F.explode(codes).alias("code")).groupBy("label", "code").count().collect()}
    chance = {}
    for label in ("random", "ordinary"):
        for a in range(SYMBOLS):
            row = [counts.get((label, a * SYMBOLS + b), 0) + 0.5 for b in range(SYMBOLS)]
            total = sum(row)
            for b in range(SYMBOLS):
                chance[label, a * SYMBOLS + b] = row[b] / total
    return [math.log(chance["random", k] / chance["ordinary", k]) for k in range(SYMBOLS**2)]


def random_score(string: Column, ratios: list[float]) -> Column:
    """Mean log-likelihood ratio for a character; null for an empty string. Takes steps in proportion to the length."""
    known = F.lit(",".join(f"{x:.6g}" for x in ratios))
    ratio = F.split(known, ",").cast("array<double>")
    # the number of each character's pair: its own symbol after the one before, which is an edge at the beginning
    before = lambda symbols, i: F.coalesce(F.get(symbols, i - 1), F.lit(0))
    total = lambda symbols: F.aggregate(F.transform(symbols, lambda x, i: before(symbols, i) * SYMBOLS + x), F.lit(0.0), lambda a, pair: a + F.element_at(ratio, pair + 1))
    return F.when(F.length(string) > 0, _let(F.transform(F.split(string, ""), _symbol), total) / F.length(string))


def is_random(string: Column, ratios: list[float], least: float = RATIO) -> Column:
    """Whether the models take a string for random: by its mean ratio, which must be higher for a short one."""
    return random_score(string, ratios) >= least * F.greatest(F.lit(1.0), F.lit(float(SURE)) / F.length(string))


def secret_spans(docs: DataFrame, ratios: list[float], least: float = RATIO) -> DataFrame:
    """doc_id, text and spans: array of (kind, start, end, text), by start, then in the order of KINDS.

    All base spans, and the runs of RUN that `is_random` and that overlap no base span. Each different run of a text is
    judged once; only texts with one that counts look for its places.
    """
    base = base_spans(docs)
    none = F.array().cast(_SPAN)
    runs = F.array_distinct(F.regexp_extract_all("text", F.lit(RUN), F.lit(0)))
    base = base.withColumn("random", F.filter(runs, lambda r: is_random(r, ratios, least)))
    taken = F.concat("assign", "access", "hex")
    apart = lambda m: ~F.exists(taken, lambda b: (b.getField("start") < m.getField("end")) & (m.getField("start") < b.getField("end")))
    placed = F.filter(_matches(F.col("text"), RUN), lambda m: F.array_contains("random", m.getField("text")) & apart(m))
    base = base.withColumn("markov", F.when(F.size("random") > 0, placed).otherwise(none))
    ordered = lambda i: lambda m: F.struct(m.getField("start").alias("start"), F.lit(i).alias("order"), m.getField("end").alias("end"), m.getField("text").alias("text"))
    all_spans = F.concat(*[F.transform(k, ordered(i)) for i, k in enumerate(KINDS)])
    kinds = F.array(*[F.lit(k) for k in KINDS])
    spans = F.transform(F.array_sort(all_spans), lambda m: F.struct(F.element_at(kinds, m.getField("order") + 1).alias("kind"), m.getField("start").alias("start"), m.getField("end").alias("end"), m.getField("text").alias("text")))
    return base.select("doc_id", "text", spans.alias("spans"))


def _digest(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda m: F.concat_ws(":", m.getField("kind"), m.getField("start"), m.getField("end"))), ",")


def find_secrets(docs: DataFrame, rows: int = TRAIN_ROWS, seed: int = SEED, least: float = RATIO) -> DataFrame:
    """Trains the models on the documents' own labelled strings and returns `secret_spans`.

    Null and empty texts have no spans. A match belongs to each row that holds it, repeated rows included;
    null ids are kept. Matches of very long texts are placed in linear passes. An empty table gives an
    empty result. Columns other than doc_id and text are not read.
    """
    return secret_spans(docs, log_ratios(training_strings(docs, rows, seed)), least)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda m: m.getField("kind") == kind)).cast("long")
    base = F.filter("spans", lambda m: m.getField("kind") != "markov")
    counts = {k: count(k).alias(f"n_{k}") for k in KINDS}
    return found.select("doc_id", *[counts[k] for k in KINDS if k != "markov"], F.sha2(_digest(base), 256).alias("base_sha256"), _digest(F.col("spans")).alias("spans"), counts["markov"])


QUERIES = {"op1_secrets": query}
ORACLES: dict[str, str] = {}
