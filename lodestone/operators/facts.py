"""Facts that are derived from units' edges, members and texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def backfill_report(rows: DataFrame, was: str, now: str) -> DataFrame:
    """change and n: rows that keep what they had, are filled, or stay unresolved; each change is there, if with 0."""
    change = F.when(F.col(was).isNotNull(), "kept").when(F.col(now).isNotNull(), "filled").otherwise("unresolved")
    counted = rows.select(change.alias("change")).agg(*[F.count_if(F.col("change") == c).alias(c) for c in ("kept", "filled", "unresolved")])
    return counted.unpivot([], ["kept", "filled", "unresolved"], "change", "n")


def derived_from(reads: DataFrame, fields: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """unit, from, to and places: reads (unit, from, kind) of the given kinds, with the fields (unit, to) of their unit.

    Reads are counted before the join, so that a member that reads often crosses the shuffle once per task.
    """
    counted = reads.filter(F.col("kind").isin(*kinds)).groupBy("unit", "from").agg(F.count(F.lit(1)).alias("places"))
    return counted.join(fields, "unit").select("unit", "from", "to", "places")


def signal_dependencies(calls: DataFrame, signals: DataFrame) -> DataFrame:
    """The distinct calls (from, to) whose end is a declared signal (to)."""
    return calls.join(signals, "to", "left_semi").select("from", "to").distinct()


def entry_members(*sources: DataFrame) -> DataFrame:
    """unit and members: the union of the sources (unit, member), distinct and sorted. A unit's members fit in a row."""
    return reduce(DataFrame.unionByName, sources).distinct().groupBy("unit").agg(F.array_sort(F.collect_list("member")).alias("members"))


def joined_graph(*edges: DataFrame) -> DataFrame:
    """Edges (from, to, via) of several kinds as one graph: no self edges, each pair once, with the least `via`."""
    return reduce(DataFrame.unionByName, edges).filter("from != to").groupBy("from", "to").agg(F.min("via").alias("via"))


def uncited(recorded: DataFrame, cited: DataFrame, keys: list[str]) -> DataFrame:
    """What is recorded and not cited, by keys, once each."""
    return recorded.select(*keys).distinct().join(cited.select(*keys).distinct(), keys, "left_anti")


def required_sections(texts: DataFrame, unit: str, text: Column, marks: dict[str, str]) -> DataFrame:
    """unit, section and present, for every required section, by the mark that begins it. Null texts have none."""
    found = [F.coalesce(F.contains(text, F.lit(mark)), F.lit(False)).alias(section) for section, mark in marks.items()]
    return texts.select(unit, *found).unpivot([unit], list(marks), "section", "present")
