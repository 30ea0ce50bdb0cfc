"""Directed edges with counts, and their adjacency lists in both directions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def consecutive_edges(rows: DataFrame, within: list[str], order: list[str], label: str, keep: list[str]) -> DataFrame:
    """An edge from each row's label to that of the next row of the same group: from, to, and `keep` of the first row."""
    following = F.lead(label).over(Window.partitionBy(*within).orderBy(*order))
    return rows.select(*keep, *within, F.col(label).alias("from"), following.alias("to")).filter("to IS NOT NULL")


def edge_dedupe(edges: DataFrame, order: list[str], first: list[str]) -> DataFrame:
    """One row per (from, to): how often it occurs and the `first` columns of its first occurrence."""
    one = F.min(F.struct(*order, *[c for c in first if c not in order]))
    return edges.groupBy("from", "to").agg(F.count(F.lit(1)).alias("calls"), one.alias("_first")).select("from", "to", "calls", *[F.col(f"_first.{c}").alias(f"first_{c}") for c in first])


def adjacency(edges: DataFrame, source: str, target: str, order: str | None = None) -> DataFrame:
    """For each source its distinct targets as an array: by first occurrence along `order`, or sorted."""
    distinct = edges.groupBy(source, target).agg(F.min(order).alias("_order")) if order else edges.select(source, target).distinct()
    if not order:
        return distinct.groupBy(source).agg(F.array_sort(F.collect_list(target)).alias("targets"))
    listed = F.array_sort(F.collect_list(F.struct("_order", target)))
    return distinct.groupBy(source).agg(F.transform(listed, lambda x: x.getField(target)).alias("targets"))


def dependency_usage(uses: DataFrame, all_dependencies: DataFrame) -> DataFrame:
    """For each dependency the members used, each with the number of places that use it; none for unused ones.

    `uses` has dependency, member and place; `all_dependencies` has dependency.
    """
    members = uses.groupBy("dependency", "member").agg(F.countDistinct("place").alias("places"))
    listed = members.groupBy("dependency").agg(F.count("member").alias("members"), F.sum("places").alias("places"))
    return all_dependencies.join(listed, "dependency", "left").select("dependency", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("members", "places")])


def listed(values: Column, by: str = ",") -> Column:
    """An array as one string, so that results of different engines compare."""
    return F.array_join(F.transform(values, lambda x: x.cast("string")), by)
