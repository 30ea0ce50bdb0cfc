"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import salted_lookup
from lodestone.tables import discard, written


def _with_least(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each row (u, v) of `edges` with m, the least of u and its neighbours, and the table that m is looked up in.

    Nodes of any degree are no one task's work.
    """
    least = written(edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("degree")))
    total = least.agg(F.coalesce(F.sum("degree"), F.lit(0))).first()[0]
    return salted_lookup(edges, least, ["u"], "degree", total, ["v"]).drop("degree"), least


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first())


def components(links: DataFrame) -> DataFrame:
    """node and component: the least node that can be reached, for every node that `links` (u, v) names.

    Large stars hang each node's larger neighbours on its least one, small stars its smaller ones, until
    nothing changes: about as many rounds as the logarithm of a component's size. Links may repeat, point
    either way, and join a node with itself. Every round is cut by a table in the shared folder.
    """
    edges = written(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct())
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hung, first = _with_least(both)
        large = written(hung.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct())
        hung, second = _with_least(large)
        small = written(hung.select("u", F.col("m").alias("v")).unionByName(hung.select(F.col("v").alias("u"), F.col("m").alias("v"))).filter("u != v").distinct())
        discard(first, second, large, edges)
        edges, last, mark = small, mark, _mark(small)
        if mark == last:
            break
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
