"""Differences between two versions, two forms of a thing, or two vocabularies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def golden_diff(expected: DataFrame, actual: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys whose value differs, null-safely, or that one side lacks: keys, expected, actual, status."""
    e = expected.select(*keys, F.col(value).alias("expected"), F.lit(True).alias("_e"))
    a = actual.select(*keys, F.col(value).alias("actual"), F.lit(True).alias("_a"))
    both = e.join(a, keys, "full_outer")
    status = F.when(F.col("_a").isNull(), "missing").when(F.col("_e").isNull(), "unexpected").otherwise("changed")
    return both.withColumn("status", status).filter(F.col("_a").isNull() | F.col("_e").isNull() | ~F.col("expected").eqNullSafe(F.col("actual"))).select(*keys, "expected", "actual", "status")


# Fixed values of the documents: what differs between any two runs: everything below some properties, properties whose
# names begin so, and properties where they end a path.
VOLATILE_BELOW = ("files", "manifest", "provenance")
VOLATILE_BEGINNINGS = ("warnings",)
VOLATILE_ENDS = ("generatedAt", "inputHash", "loc.file", "resolverVersion", "templateFile", "unit.id", "unit.path", "unitId")


def volatile(path: Column) -> Column:
    """Whether a path of a leaf (names joined by dots, positions in brackets) says nothing about what was found."""
    names = lambda some: "|".join(n.replace(".", r"\.") for n in some)
    return path.rlike(rf"\.({names(VOLATILE_BELOW)})(\.|\[)|\.({names(VOLATILE_BEGINNINGS)})|\.({names(VOLATILE_ENDS)})$")


def stable_diff(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """`golden_diff` of leaves (key, path, leaf) whose paths aren't `volatile`; names match below the top alone, which a run's own record has."""
    stable = lambda leaves: leaves.filter(~volatile(F.col("path")))
    return golden_diff(stable(expected), stable(actual), [key, "path"], "leaf")


def pair_equivalence(projections: DataFrame, pairs: DataFrame, may_differ: DataFrame) -> DataFrame:
    """For each pair (left, right) and projection name whether both sides have the same value.

    `projections` has unit, name and value; `may_differ` lists (left, right, name) that are not compared.
    """
    left = projections.select(F.col("unit").alias("left"), "name", F.col("value").alias("left_value"))
    right = projections.select(F.col("unit").alias("right"), "name", F.col("value").alias("right_value"))
    both = pairs.join(left, "left").join(right, ["right", "name"]).join(may_differ, ["left", "right", "name"], "left_anti")
    return both.select("left", "right", "name", F.col("left_value").eqNullSafe(F.col("right_value")).alias("same"))


def vocabulary_diff(used: DataFrame, declared: DataFrame, column: str) -> DataFrame:
    """Words that only one of two vocabularies has, and which."""
    u, d = used.select(column).distinct(), declared.select(column).distinct()
    return u.exceptAll(d).withColumn("side", F.lit("undeclared")).unionByName(d.exceptAll(u).withColumn("side", F.lit("unused")))
