"""The questions asked of one unit's facts: callers, callees, accesses, symbols, template nodes, outlines.

Fact tables: calls (unit, from, to, ord), access (unit, site, field, mode), usage (unit, dependency, place),
symbols (unit, id and more), nodes (unit, id, bucket, bucket_ord).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def refs(calls: DataFrame, access: DataFrame, usage: DataFrame, unit: str, target: str) -> DataFrame:
    """kind and id of everything that refers to `target`: callers, readers, writers and users of a dependency."""
    own = F.col("unit") == unit
    callers = calls.filter(own & (F.col("to") == target)).select(F.lit("caller").alias("kind"), F.col("from").alias("id"))
    accesses = access.filter(own & (F.col("field") == target)).select(F.when(F.col("mode") == "write", "writer").otherwise("reader").alias("kind"), F.col("site").alias("id"))
    users = usage.filter(own & (F.col("dependency") == target)).select(F.lit("user").alias("kind"), F.col("place").alias("id"))
    return callers.unionByName(accesses).unionByName(users).distinct()


def all_callees(calls: DataFrame) -> DataFrame:
    """unit, from, id and ord: what every site calls, once each, with the place of the first call."""
    return calls.groupBy("unit", "from", F.col("to").alias("id")).agg(F.min("ord").alias("ord"))


def callees(calls: DataFrame, unit: str, source: str) -> DataFrame:
    """What `source` calls, in order of first call."""
    return all_callees(calls.filter((F.col("unit") == unit) & (F.col("from") == source))).orderBy("ord").select("id")


def all_accesses(access: DataFrame) -> DataFrame:
    """unit, site, field, mode and places: the fields that every site reads and writes."""
    return access.groupBy("unit", "site", "field", "mode").agg(F.count(F.lit(1)).alias("places"))


def accesses(access: DataFrame, unit: str, site: str) -> DataFrame:
    """Fields that a site reads and writes."""
    return all_accesses(access.filter((F.col("unit") == unit) & (F.col("site") == site))).select("field", "mode")


def symbol(symbols: DataFrame, unit: str, name: str) -> DataFrame:
    """One symbol without its source text; no row if there is none."""
    return symbols.filter((F.col("unit") == unit) & (F.col("id") == name)).drop("source").limit(1)


def all_nodes(nodes: DataFrame) -> DataFrame:
    """unit, id and bucket: every template node with the first bucket that has it."""
    return nodes.groupBy("unit", "id").agg(F.min_by("bucket", "bucket_ord").alias("bucket"))


def node(nodes: DataFrame, unit: str, name: str) -> DataFrame:
    """A template node's row from the first bucket that has it."""
    return all_nodes(nodes.filter((F.col("unit") == unit) & (F.col("id") == name)))


def outline(symbols: DataFrame, calls: DataFrame, access: DataFrame) -> DataFrame:
    """One row for each unit: symbols, calls and field accesses; zeros where there are none."""
    count = lambda df, name: df.groupBy("unit").agg(F.count(F.lit(1)).alias(name))
    found = count(symbols, "symbols").join(count(calls, "calls"), "unit", "full_outer").join(count(access, "accesses"), "unit", "full_outer")
    return found.select("unit", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("symbols", "calls", "accesses")])
