"""Keyed lookups: candidates by rank, last row wins, nearest ancestor, priorities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_candidate(refs: DataFrame, candidates: list[Column], known: DataFrame, key: str, out: str) -> DataFrame:
    """Resolves each row of `refs` (unique by `key`) to the first of its candidates that `known` (name) has; null if none."""
    ranked = refs.select(key, F.posexplode(F.array(*candidates)).alias("rank", "name"))
    found = ranked.join(known.select("name").distinct(), "name").groupBy(key).agg(F.min_by("name", "rank").alias(out))
    return refs.join(found, key, "left")


def last_wins(rows: DataFrame, key: str, order: list[str], values: list[str]) -> DataFrame:
    """One row per key: the values of its last row."""
    last = F.max(F.struct(*order, *[v for v in values if v not in order]))
    return rows.groupBy(key).agg(last.alias("_last")).select(key, *[F.col(f"_last.{v}").alias(v) for v in values])


def filled(rows: DataFrame, dimension: DataFrame, key: str, column: str, value: str) -> DataFrame:
    """`rows` with nulls of `column` taken from `value` of the row of `dimension` with the same key."""
    return rows.join(dimension.select(key, value), key, "left").withColumn(column, F.coalesce(column, value)).drop(value)


def path_prefixes(path: Column) -> Column:
    """A path and its ancestors, the path itself first; the last one is empty."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.size(parts), F.lit(0)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))


def nearest_ancestor(rows: DataFrame, key: str, path: str, marked: DataFrame, out: str) -> DataFrame:
    """For each row (unique by `key`) the longest ancestor of its path that `marked` (prefix) has; null if none.

    Ancestors are exploded and joined by equality, so neither side is compared with all of the other.
    """
    prefixes = rows.select(key, F.explode(path_prefixes(F.col(path))).alias("prefix"))
    found = prefixes.join(marked.select("prefix").distinct(), "prefix").groupBy(key).agg(F.max_by("prefix", F.length("prefix")).alias(out))
    return rows.join(found, key, "left")


# Fixed values of manifests: the dependencies that tell a version, best first.
VERSION_KEYS = (("dependencies", "@angular/core"), ("devDependencies", "@angular/core"), ("dependencies", "@angular/compiler"), ("devDependencies", "@angular/compiler"))


def declared_versions(manifests: DataFrame) -> DataFrame:
    """prefix (a folder) and version of the manifests (path, text) that declare one, by the first of VERSION_KEYS that they have.

    Broken manifests and those without any of them claim nothing.
    """
    document = F.from_json("text", "dependencies map<string, string>, devDependencies map<string, string>")
    version = F.coalesce(*[F.nullif(F.element_at(document.getField(part), name), F.lit("")) for part, name in VERSION_KEYS])
    return manifests.select(F.regexp_extract("path", "^(?:(.*)/)?[^/]*$", 1).alias("prefix"), version.alias("version")).filter("version IS NOT NULL")


def nearest_versions(rows: DataFrame, key: str, path: str, manifests: DataFrame) -> DataFrame:
    """key and version of the nearest folder above each path whose manifest declares one; null without any."""
    declared = declared_versions(manifests)
    found = nearest_ancestor(rows, key, path, declared, "prefix")
    return found.join(declared, "prefix", "left").select(key, "version")


def located(sources: list[DataFrame], key: str, value: str) -> DataFrame:
    """One row per key: `value` from the first of `sources` that has the key."""
    ranked = [s.select(key, F.col(value), F.lit(i).alias("_source")) for i, s in enumerate(sources)]
    both = ranked[0]
    for more in ranked[1:]:
        both = both.unionByName(more)
    return both.groupBy(key).agg(F.min(F.struct("_source", value)).alias("_first")).select(key, F.col(f"_first.{value}").alias(value), (F.col("_first._source")).cast("bigint").alias("source"))
