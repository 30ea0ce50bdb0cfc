"""Referential integrity: references that no declaration answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dangling_report(relations: list[str], refs: DataFrame, declared: DataFrame) -> DataFrame:
    """One row for each of `relations`: how many references it has and how many of them dangle.

    `refs` has relation and ref, `declared` relation and id; all relations are checked in one join. References are
    counted per value before it, so that a frequent value crosses the shuffle once per task. Null references count
    and dangle.
    """
    counted = refs.groupBy("relation", "ref").agg(F.count(F.lit(1)).alias("n"))
    ids = declared.select("relation", F.col("id").alias("ref")).distinct().withColumn("found", F.lit(True))
    lost = F.col("found").isNull()
    found = counted.join(ids, ["relation", "ref"], "left").groupBy("relation").agg(
        F.sum("n").alias("refs"),
        F.count("ref").alias("distinct_refs"),
        F.coalesce(F.sum(F.when(lost, F.col("n"))), F.lit(0)).alias("dangling"),
        F.count(F.when(lost, F.col("ref"))).alias("distinct_dangling"),
    )
    names = refs.sparkSession.createDataFrame([(r,) for r in relations], "relation string")
    return names.join(found, "relation", "left").na.fill(0)


def keyed(rows: DataFrame, columns: dict[str, Column], name: str) -> DataFrame:
    """relation and `name`: several key columns of a table as rows, in one scan of it."""
    pairs = [F.struct(F.lit(relation).alias("relation"), c.cast("bigint").alias(name)) for relation, c in columns.items()]
    return rows.select(F.inline(F.array(*pairs)))
