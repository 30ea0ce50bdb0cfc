"""Exact top-k search by inner product with a vector-approximation file."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.llm.common import durable, table

SCALE = 1024
K = 10
#: Queries and distinct vectors in a block; a task scans one block of each at a time.
QUERY_BLOCK, DATA_BLOCK = 4096, 16384
#: Queries whose bounds are computed at once, and data blocks that one task scans for a block of queries.
QUERIES_AT_ONCE, BLOCKS_IN_TURN = 256, 64
#: Cells along each dimension.
CELLS = 256
#: Parts in which the ids of equal vectors are gathered first.
PARTS = 512
#: Vectors with an integer of this size or more are wide: their integers aren't put into cells.
LARGEST = 1 << 52


def floored(embedding: Column) -> Column:
    """floor(SCALE * x) / SCALE of each component, x as double, which a double holds exactly; null for a vector that takes no part.

    Doubles of LARGEST and more are whole numbers already. Both zeros are one.
    """
    number = lambda x: x.cast("double")
    sound = embedding.isNotNull() & F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(number(x)) & (F.abs(number(x)) < float("inf")))
    whole = lambda x: F.when(F.abs(x) < float(LARGEST // SCALE), F.floor(x * SCALE).cast("double") / SCALE).otherwise(x) + F.lit(0.0)
    return F.when(sound, F.transform(embedding, lambda x: whole(number(x))))


def _is_wide(y: Column) -> Column:
    return F.exists(y, lambda x: F.abs(x) >= float(LARGEST // SCALE))


def _integers(y: Column) -> Column:
    """The integers of a vector that isn't wide."""
    return F.transform(y, lambda x: (x * SCALE).cast("long"))


def _exact_scores(q: Column, y: Column) -> Column:
    """Inner products of integers of any size, within 64 bits."""

    def score(a: np.ndarray, b: np.ndarray) -> int:
        total = sum(int(SCALE * Fraction(x)) * int(SCALE * Fraction(z)) for x, z in zip(a.tolist(), b.tolist(), strict=True))
        return max(-(1 << 63), min((1 << 63) - 1, total))

    @F.pandas_udf("long")
    def scores(q: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([score(a, b) for a, b in zip(q, y, strict=True)], dtype="int64")

    return scores(q, y)


def _smallest_ids(batches: Iterator[pd.DataFrame], most: int) -> Iterator[pd.DataFrame]:
    """Of each batch, the `most` smallest ids of each vector."""
    for batch in batches:
        if len(batch):
            batch = batch.assign(key=[np.asarray(v, dtype=np.float64).tobytes() for v in batch["v"]]).sort_values("vec_id", kind="stable").drop_duplicates(["key", "vec_id"])
            batch = batch[batch.groupby("key").cumcount() < most]
            yield batch[["vec_id", "v"]]


def distinct_vectors(vectors: DataFrame, k: int = K) -> DataFrame:
    """v and ids: each vector of `floored` once, with its k + 1 smallest different ids, in order.

    More can't be in a result: a query leaves out one id, its own. Copies are thinned in each batch, then
    in PARTS parts of a vector's copies, then together, so that no task gathers a large group.
    """
    most = k + 1
    thin = vectors.select("vec_id", "v").mapInPandas(lambda batches: _smallest_ids(batches, most), "vec_id long, v array<double>")
    parts = thin.groupBy("v", F.pmod(F.xxhash64("vec_id"), F.lit(PARTS)).alias("part")).agg(F.slice(F.array_sort(F.collect_set("vec_id")), 1, most).alias("ids"))
    return parts.groupBy("v").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, most).alias("ids"))


def _scan(part: pd.DataFrame, low: np.ndarray, width: np.ndarray, k: int) -> pd.DataFrame:
    """Bounds of the scores of a block of queries with some blocks of cells, one after the other; the candidates of each query.

    A vector's component lies in [low + c * width, low + (c + 1) * width - 1] for its cell c, in integers, so a score
    lies within q.centre plus and minus |q|.reach, and what doubles may round. A block of wide vectors has the vectors
    themselves, whose scores only rounding leaves open; what is no number a double holds is not bounded. Kept are vectors
    whose upper bound is no less than the (k + 1)th largest lower bound so far. Where many vectors stand level, k + 1 that
    surely come before another leave it out. `firsts` and `seconds` are the two least ids of each vector, equal where it
    has but one.
    """
    cell_reach = (width - 1) / 2
    cell_rounding = (len(low) + 8) * 2.0**-52 * np.maximum(np.abs(low), np.abs(low + CELLS * width))
    found = [pd.DataFrame({"query_id": [], "vector": [], "first": [], "lower": [], "upper": []})]
    with np.errstate(over="ignore", invalid="ignore"):
        for ids, components in part.loc[part["ids"].notna(), ["ids", "components"]].itertuples(index=False):
            asked = SCALE * np.asarray(components, dtype=np.float64).reshape(len(ids), len(low))
            best = np.full((len(ids), k + 1), -np.inf)
            for keys, firsts, seconds, cells, whole in part.loc[part["keys"].notna(), ["keys", "firsts", "seconds", "cells", "whole"]].itertuples(index=False):
                if cells is not None:
                    centres, reach, rounding = (low + np.frombuffer(cells, dtype=np.uint8).reshape(len(keys), len(low)) * width + cell_reach).T, cell_reach, cell_rounding
                else:
                    centres = SCALE * np.asarray(whole, dtype=np.float64).reshape(len(keys), len(low)).T
                    reach, rounding = 0.0, (len(low) + 8) * 2.0**-52 * np.abs(centres).max(axis=1)
                most = min(k + 1, len(keys))
                for start in range(0, len(ids), QUERIES_AT_ONCE):
                    q, own = asked[start : start + QUERIES_AT_ONCE], best[start : start + QUERIES_AT_ONCE]
                    middle = q @ centres
                    slack = np.broadcast_to((np.abs(q) @ (reach + rounding))[:, None], middle.shape)
                    bounded = np.isfinite(middle) & np.isfinite(slack)
                    if not bounded.all():
                        slack = np.where(bounded, slack, np.inf)
                        middle = np.where(bounded, middle, 0.0)
                    name = ids[start : start + QUERIES_AT_ONCE, None]
                    own_id = firsts == name
                    least_id = np.where(own_id, seconds, firsts)
                    # beyond 64 bits scores stand level
                    lower, upper = np.clip(middle - slack, -(2.0**63), 2.0**63), np.clip(middle + slack, -(2.0**63), 2.0**63)
                    lower[own_id & (seconds == name)] = upper[own_id & (seconds == name)] = -np.inf  # a vector of the query's id alone
                    near = np.concatenate([own, np.partition(lower, len(keys) - most, axis=1)[:, len(keys) - most :]], axis=1)
                    own[:] = np.partition(near, most, axis=1)[:, most:]
                    kept = (upper >= own.min(axis=1)[:, None]) & (upper > -np.inf)
                    for i in np.flatnonzero(kept.sum(axis=1) > 4 * (k + 1)):
                        at = np.flatnonzero(kept[i])
                        before = at[np.lexsort((least_id[i, at], -lower[i, at]))[: k + 1]]
                        least, last = lower[i, before].min(), least_id[i, before].max()
                        kept[i, at] = (upper[i, at] > least) | ((upper[i, at] == least) & (least_id[i, at] <= last))
                    at, to = np.nonzero(kept)
                    found.append(pd.DataFrame({"query_id": ids[start + at], "vector": keys[to], "first": least_id[at, to], "lower": lower[at, to], "upper": upper[at, to]}))
    return pd.concat(found[1:] or found)


def _padded(v: Column, dimensions: int) -> Column:
    return F.when(F.size(v) < dimensions, F.concat(v, F.array_repeat(F.lit(0.0), F.lit(dimensions) - F.size(v)))).otherwise(v)


def top_scores(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest integer inner products of each query.

    `vectors` and `queries` have vec_id and v, arrays of `floored` doubles, which stand for integers SCALE times as large;
    missing components of shorter arrays count as 0. Ties go to smaller ids; a query's own id is no candidate. Equal vectors are searched as one. The file
    has a cell number for each component of each distinct vector. Scanning it in blocks gives bounds for every pair of
    a query and a vector; exact vectors are then read in the order of their bounds: the best k + 1 of each query first,
    and of the others those whose bound is no worse than the kth exact score so far, which makes the result certain.
    Wide vectors have no cells: blocks of them are scanned as they are, and scores with a wide vector on either side are
    summed in integers of any size. Fewer vectors than k give as many rows. Rows that repeat an id and a vector count once; an id with several vectors
    is a candidate with each, and as a query has the greatest of them. Scores beyond 64 bits are the greatest or least
    number of 64 bits.
    """
    dimensions = max(1, vectors.agg(F.max(F.size("v"))).first()[0] or 0)
    pad = lambda df: df.select("vec_id", _padded(F.col("v"), dimensions).alias("v"))
    distinct = distinct_vectors(pad(vectors), k)
    distinct = durable(distinct.select("v", "ids", F.monotonically_increasing_id().alias("vector"), _is_wide(F.col("v")).alias("wide")))
    narrow = distinct.filter(~F.col("wide")).withColumn("v", _integers(F.col("v")))
    edges = narrow.agg(F.count(F.lit(1)), *[f(F.col("v")[i]) for i in range(dimensions) for f in (F.min, F.max)]).first()
    n, lows, highs = edges[0], [x or 0 for x in edges[1::2]], [x or 0 for x in edges[2::2]]
    wides = distinct.filter("wide").count()
    widths = [-(-(high - low + 1) // CELLS) for low, high in zip(lows, highs, strict=True)]
    low, width = np.array(lows, dtype=np.float64), np.array(widths, dtype=np.float64)
    literals = [F.array(*[F.lit(x).cast("long") for x in numbers]) for numbers in (lows, widths)]
    parts = max(1, -(-n // DATA_BLOCK))
    cells = narrow.withColumns({"low": literals[0], "width": literals[1]})
    cells = cells.select("vector", F.col("ids")[0].alias("first"), F.coalesce(F.get("ids", F.lit(1)), F.col("ids")[0]).alias("second"), F.expr("array_join(transform(v, (x, i) -> lpad(hex((x - low[i]) DIV width[i]), 2, '0')), '')").alias("cell"))
    files = cells.groupBy(F.pmod(F.xxhash64("vector"), F.lit(parts)).cast("int").alias("part")).agg(F.collect_list(F.struct("vector", "first", "second", "cell")).alias("x"))
    files = files.select("part", F.col("x.vector").alias("keys"), F.col("x.first").alias("firsts"), F.col("x.second").alias("seconds"), F.unhex(F.array_join("x.cell", "")).alias("cells"), F.lit(None).cast("array<double>").alias("whole"))
    if wides:
        # as many numbers in a block as a block of cells has, of which each takes eight bytes
        wide_parts = -(-wides * 8 // DATA_BLOCK)
        own = distinct.filter("wide").select("vector", F.col("ids")[0].alias("first"), F.coalesce(F.get("ids", F.lit(1)), F.col("ids")[0]).alias("second"), "v", F.pmod(F.xxhash64("vector"), F.lit(wide_parts)).cast("int").alias("part"))
        own = own.groupBy("part").agg(F.collect_list(F.struct("vector", "first", "second", "v")).alias("x"))
        own = own.select(F.col("part") + parts, F.col("x.vector"), F.col("x.first"), F.col("x.second"), F.lit(None).cast("binary"), F.flatten("x.v"))
        files, parts = files.union(own), parts + wide_parts
    asked = durable(pad(queries).groupBy("vec_id").agg(F.max("v").alias("v")).withColumnRenamed("vec_id", "query_id"))
    blocks, turns = max(1, -(-asked.count() // QUERY_BLOCK)), -(-parts // BLOCKS_IN_TURN)
    asked_blocks = asked.groupBy(F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("block")).agg(F.collect_list(F.struct("query_id", "v")).alias("x"))
    asked_blocks = asked_blocks.select("block", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))).alias("turn"), F.col("x.query_id").alias("ids"), F.flatten("x.v").alias("components"))
    files = files.withColumns({"turn": F.col("part") % turns, "block": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))}).drop("part")
    grid = files.unionByName(asked_blocks, allowMissingColumns=True).groupBy("block", "turn")
    bounds = durable(grid.applyInPandas(lambda part: _scan(part, low, width, k), "query_id long, vector long, first long, lower double, upper double"))
    by_lower = Window.partitionBy("query_id").orderBy(F.desc("lower"), "first", "vector")
    by_upper = Window.partitionBy("query_id").orderBy(F.desc("upper"), "first", "vector")
    # the (k + 1)th largest lower bound over all blocks
    certain = bounds.withColumn("r", F.row_number().over(by_lower)).filter(F.col("r") <= k + 1).groupBy("query_id").agg(F.count(F.lit(1)).alias("vectors"), F.min("lower").alias("least"), F.max("first").alias("last"))
    possible = (F.col("vectors") <= k) | (F.col("upper") > F.col("least")) | ((F.col("upper") == F.col("least")) & (F.col("first") <= F.col("last")))
    left = durable(bounds.join(certain, "query_id").filter(possible).select("query_id", "vector", "first", "upper"))
    wide = sum(max(abs(a), abs(b)) ** 2 for a, b in zip(lows, highs, strict=True)) >= 1 << 62
    number = "decimal(38,0)" if wide else "long"

    def exact(candidates: DataFrame) -> DataFrame:
        read = candidates.join(distinct, "vector").join(asked.withColumnRenamed("v", "q"), "query_id")
        if wides:
            huge = F.col("wide") | _is_wide(F.col("q"))
            widest = read.filter(huge).select("query_id", _exact_scores("q", "v").alias("score"), "ids")
            read = read.filter(~huge)
        read = read.withColumns({"q": _integers(F.col("q")), "v": _integers(F.col("v"))})
        score = F.aggregate(F.zip_with("q", "v", lambda a, b: (a.cast("decimal(19,0)") * b.cast("decimal(19,0)")).cast(number) if wide else a * b), F.lit(0).cast(number), lambda a, x: (a + x).cast(number))
        score = F.greatest(F.least(score, F.lit((1 << 63) - 1).cast(number)), F.lit(-(1 << 63)).cast(number)).cast("long")
        scored = read.select("query_id", score.alias("score"), "ids")
        scored = scored.unionByName(widest) if wides else scored
        return scored.select("query_id", "score", F.explode("ids").alias("vec_id")).filter("vec_id != query_id")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    first = left.withColumn("r", F.row_number().over(by_upper)).filter(F.col("r") <= k + 1).select("query_id", "vector")
    bar = exact(first).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).groupBy("query_id").agg(F.when(F.count(F.lit(1)) == k, F.min("score")).alias("bar"))
    read = left.join(durable(bar), "query_id", "left").filter(F.col("bar").isNull() | (F.col("upper") >= F.col("bar"))).select("query_id", "vector")
    ranked = exact(read).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def search(embeddings: DataFrame, every: int = 100, k: int = K) -> DataFrame:
    """`top_scores` of the vectors whose id is divisible by `every`, against all vectors.

    Null vectors, vectors with a null or non-finite component, and null ids take no part; all others do, however large. Shorter vectors count as filled with zeros. Rows that repeat an id are as in `top_scores`. An empty table
    gives an empty result. Columns other than vec_id and embedding are not read.
    """
    sound = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), floored(F.col("embedding")).alias("v")).filter("vec_id IS NOT NULL AND v IS NOT NULL")
    return top_scores(sound, sound.filter(F.col("vec_id") % every == 0), k)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))


ORACLE = f"""
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * {SCALE})::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, e.vec_id, list_sum(list_transform(list_zip(q.v, e.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM e q JOIN e ON q.vec_id <> e.vec_id WHERE q.vec_id % 100 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= {K}
"""

QUERIES = {"op2_vector_approximation": query}
ORACLES = {"op2_vector_approximation": ORACLE}
