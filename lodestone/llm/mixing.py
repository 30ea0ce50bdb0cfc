"""Mixing sources to target weights: budgets flow down a tree, leaves give prefixes of seeded epochs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.llm.common import bucket_bits, durable, hex_bucket, numbered, salted_lookup, seeded, table, with_running_total
from lodestone.llm.sharding import stratum_of

SEED = 11
LEVELS = ("domain", "lang", "source")
#: Target weights by level and name; names that are not listed weigh 1.
WEIGHTS = {"domain": {"=web": 5, "=books": 3, "=code": 2}, "lang": {"=en": 6, "=de": 2}, "source": {}}
#: Tokens wanted, in hundredths of those there are, and epochs that a leaf may give at most.
PERCENT, EPOCHS = 120, 2


def words(text: Column) -> Column:
    """Tokens of a text for budgets: runs of anything but white space (null: none)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def domain_of(source: Column) -> Column:
    """The production tree's first level: sources by their number; others are `web`."""
    n = F.pmod(F.coalesce(F.regexp_extract(source, r"([0-9]{1,9})$", 1).try_cast("int"), F.lit(0)), F.lit(3))
    return F.when(n == 1, F.lit("books")).when(n == 2, F.lit("code")).otherwise(F.lit("web"))


def water_fill(nodes: DataFrame, parents: list[str], budget: str, name: str, out: str) -> DataFrame:
    """Shares each parent's `budget` among its children by `weight`, none above its `capacity`.

    What a child cannot take goes to its siblings by their weights. Closed form: in the order of
    capacity / weight, a child is full while its capacity is at most its share of what the full ones
    before it have left; the first one that is not sets the rate of the others. Whole tokens, rounded
    down. Weights must be positive; tokens times a parent's sum of weights must stay below 2**63.
    """
    ahead = Window.partitionBy(*parents).orderBy((F.col("capacity") / F.col("weight")).cast("double"), name)
    nodes = nodes.withColumns({
        "_left": F.col(budget) - F.coalesce(F.sum("capacity").over(ahead.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "_weights": F.sum("weight").over(ahead.rowsBetween(0, Window.unboundedFollowing)),
    }).withColumn("_short", F.col("capacity") * F.col("_weights") <= F.col("_left") * F.col("weight"))
    rate = F.first(F.when(~F.col("_short"), F.struct("_left", "_weights")), ignorenulls=True)
    nodes = nodes.withColumns({
        "_rate": rate.over(ahead.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        "_open": F.sum(F.when(F.col("_short"), 0).otherwise(1)).over(ahead.rowsBetween(Window.unboundedPreceding, 0)),
    })
    share = F.least(F.col("capacity"), F.expr("_rate._left * weight div _rate._weights"))
    return nodes.withColumn(out, F.when(F.col("_open") == 0, F.col("capacity")).otherwise(share)).drop("_left", "_weights", "_short", "_rate", "_open")


def leaf_budgets(leaves: DataFrame, tokens: int, weights: dict[str, dict[str, int]] | None = None, epochs: int = EPOCHS, levels: tuple[str, ...] = LEVELS) -> DataFrame:
    """Adds `budget` to a table of leaves (the levels, tokens, docs): the root's `tokens` flow down the tree.

    A node's capacity is that of its leaves, `epochs` times their tokens. So a leaf's shortage is met by
    its siblings as far as they can, and only what a whole subtree lacks reaches the ancestors' siblings.
    """
    weights = WEIGHTS if weights is None else weights
    leaves = leaves.withColumns({"root": F.lit("all"), "capacity": F.col("tokens") * epochs})
    budgets = leaves.groupBy("root").agg(F.sum("capacity").alias("capacity")).select("root", F.least(F.lit(tokens).cast("long"), "capacity").alias("budget"))
    for i, level in enumerate(levels):
        path = ["root", *levels[:i]]
        listed = [F.when(F.col(level) == name, F.lit(w)) for name, w in weights.get(level, {}).items()]
        nodes = leaves.groupBy(*path, level).agg(F.sum("capacity").alias("capacity")).withColumn("weight", F.coalesce(*listed, F.lit(1)).cast("long"))
        nodes = nodes.join(budgets.withColumnRenamed("budget", "above"), path)
        budgets = water_fill(nodes, path, "above", level, "budget").select(*path, level, "budget")
    return leaves.join(budgets.drop("root"), list(levels)).drop("root", "capacity")


def mixture(docs: DataFrame, percent: int = PERCENT, epochs: int = EPOCHS, weights: dict | None = None, seed: int = SEED, id_col: str = "doc_id", domain: Column | None = None, number_col: str | None = None) -> DataFrame:
    """The copies that a mixture takes: doc_id, domain, lang, source, tokens, epoch, budget (its leaf's), and `number`
    if a column is named for it.

    The budget is `percent` hundredths of all tokens. A leaf whose budget is n times its tokens and a rest
    gives n whole epochs, and of the next one the prefix whose tokens stay within the rest, in an order
    that seed, epoch and id decide. The order's running token sums are distributed, whatever a leaf's
    share of the rows; only ids and counts are shuffled, never texts.

    Null text has no tokens; very long texts count whole; null domains, languages and sources are names of their own, written `-`
    (others have `=` before them). Documents without tokens come with the prefix that they stand in.
    Rows that repeat an id are taken as rows of their own, side by side in the order. An empty table
    gives an empty result. Other columns are not read.
    """
    domain = domain_of(F.col("source")) if domain is None else domain
    number = [] if number_col is None else ["number"]
    rows = docs.select(
        *[F.col(number_col).alias(n) for n in number], F.col(id_col).alias("doc_id"), stratum_of(domain).alias("domain"), stratum_of(F.col("lang")).alias("lang"), stratum_of(F.col("source")).alias("source"), words(F.col("text")).alias("tokens")
    )
    rows = durable(rows)
    leaves = rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    leaves = durable(leaves)
    total, tokens = leaves.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0))).first()
    budgets = leaf_budgets(leaves, tokens * percent // 100, weights, epochs)
    budgets = budgets.select(*LEVELS, "docs", "budget", F.coalesce(F.expr("budget div nullif(tokens, 0)"), F.lit(0)).alias("whole"), F.coalesce(F.expr("budget % nullif(tokens, 0)"), F.lit(0)).alias("rest"))
    bits = bucket_bits(total)
    rows = salted_lookup(rows, durable(budgets), list(LEVELS), "docs", total, ["doc_id"])
    rows = rows.withColumn("u", seeded(seed, "whole", "doc_id")).withColumn("bucket", hex_bucket("u", bits))
    rows = durable(rows.drop("docs"))
    rows = with_running_total(rows, rows, list(LEVELS), "bucket", ["u", F.col("doc_id").asc_nulls_first(), "tokens", *number], "tokens", "so_far", bits)
    last = F.when(F.col("so_far") <= F.col("rest"), F.col("whole")).otherwise(F.col("whole") - 1)
    rows = rows.withColumn("last", last).filter("last >= 0").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), "last")))
    return rows.select("doc_id", *LEVELS, "tokens", F.col("epoch").cast("int").alias("epoch"), "budget", *number)


def mixed_documents(docs: DataFrame, percent: int = PERCENT, epochs: int = EPOCHS, weights: dict | None = None, seed: int = SEED, id_col: str = "doc_id") -> DataFrame:
    """The documents of the mixture with all their columns, a row for each epoch that takes them.

    Rows are numbered first and taken by number, so null and repeated ids come as often as the mixture says. Null and
    very long texts are as in `mixture`. An empty table gives an empty result. Columns may have any names.
    """
    rows = numbered(docs)
    flat = rows.select("number", *[F.col("row")[c].alias(a) for c, a in ((id_col, "doc_id"), ("source", "source"), ("lang", "lang"), ("text", "text"))])
    copies = mixture(flat, percent, epochs, weights, seed, number_col="number").select("number")
    return rows.join(copies, "number").select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(table(spark, sf_dir, "documents"))


def _weight_sql(level: str) -> str:
    return "CASE " + level + "".join(f" WHEN '{name}' THEN {w}" for name, w in WEIGHTS[level].items()) + " ELSE 1 END" if WEIGHTS[level] else "1"


def _level_sql(i: int) -> str:
    level, path = LEVELS[i], ["root", *LEVELS[:i]]
    keys, own = ", ".join(path), ", ".join([*path, level])
    w = f"PARTITION BY {keys} ORDER BY capacity::DOUBLE / weight::DOUBLE, {level}"
    return f"""n{i} AS (SELECT {own}, sum(capacity)::HUGEINT AS capacity, {_weight_sql(level)} AS weight FROM leaf GROUP BY {own}),
a{i} AS (SELECT n{i}.*, b.budget AS above FROM n{i} JOIN b{i} b USING ({keys})),
l{i} AS (SELECT *, above - coalesce(sum(capacity) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remains,
  sum(weight) OVER ({w} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights FROM a{i}),
s{i} AS (SELECT *, capacity * weights <= remains * weight AS short FROM l{i}),
o{i} AS (SELECT *, count(*) FILTER (WHERE NOT short) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS opened,
  first_value(CASE WHEN NOT short THEN remains END IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS rate,
  first_value(CASE WHEN NOT short THEN weights END IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS over FROM s{i}),
b{i + 1} AS (SELECT {own}, CASE WHEN opened = 0 THEN capacity ELSE least(capacity, (rate * weight) // over) END AS budget FROM o{i})"""


ORACLE = f"""
WITH d AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS lang, coalesce('=' || source, '-') AS source,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS tokens,
    CASE coalesce(TRY_CAST(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS INTEGER), 0) % 3 WHEN 1 THEN '=books' WHEN 2 THEN '=code' ELSE '=web' END AS domain
  FROM documents
), leaf AS (
  SELECT 'all' AS root, domain, lang, source, sum(tokens) AS tokens, sum(tokens) * {EPOCHS} AS capacity FROM d GROUP BY ALL
), b0 AS (
  SELECT root, least(sum(tokens)::HUGEINT * {PERCENT} // 100, sum(capacity)) AS budget FROM leaf GROUP BY root
), {", ".join(_level_sql(i) for i in range(3))},
p AS (
  SELECT b3.*, coalesce(budget // nullif(tokens, 0), 0) AS whole, coalesce(budget % nullif(tokens, 0), 0) AS rest FROM b3 JOIN leaf USING (root, domain, lang, source)
), u AS (
  SELECT d.*, whole, rest, budget, md5('{SEED}:' || whole || ':' || doc_id) AS u FROM d JOIN p USING (domain, lang, source)
), c AS (
  SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY u, doc_id ROWS UNBOUNDED PRECEDING) AS so_far FROM u
), t AS (
  SELECT *, unnest(range(0, (CASE WHEN so_far <= rest THEN whole + 1 ELSE whole END)::BIGINT)) AS epoch FROM c
)
SELECT doc_id, domain, lang, source, tokens::BIGINT AS tokens, epoch::INTEGER AS epoch, budget::BIGINT AS budget FROM t
"""

QUERIES = {"op5_mixture": query}
ORACLES = {"op5_mixture": ORACLE}
