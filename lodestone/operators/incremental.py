"""Runs that skip what has not changed, and the latest state of append-only events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def content_hash(*parts: Column, digits: int = 16) -> Column:
    """SHA-256 of the parts, joined, cut to so many hex digits."""
    return F.substring(F.sha2(F.concat(*[F.coalesce(p, F.lit("")) for p in parts]), 256), 1, digits)


def changed_units(current: DataFrame, cached: DataFrame, unit: str = "unit", digest: str = "hash") -> DataFrame:
    """The rows of `current` whose unit and hash are not cached."""
    return current.join(cached.select(unit, digest).distinct(), [unit, digest], "left_anti")


def latest_state(events: DataFrame, unit: str, order: list[str], columns: list[str]) -> DataFrame:
    """One row per unit: of each column the last value that is not null, as merging the events in order gives."""
    last = lambda c: F.max(F.when(F.col(c).isNotNull(), F.struct(*order, F.col(c).alias("_value"))))
    return events.groupBy(unit).agg(*[last(c).getField("_value").alias(c) for c in columns])


def pending_units(units: DataFrame, state: DataFrame, unit: str, done: tuple[str, ...] = ("completed", "cached")) -> DataFrame:
    """The units that a resumed run still has to process."""
    return units.join(state.filter(F.col("status").isin(*done)).select(unit), unit, "left_anti")


def step_status(units: DataFrame, events: DataFrame, steps: tuple[str, ...]) -> DataFrame:
    """unit, last_step and status of each unit, from events (unit, at, step, failed); later events have a greater `at`.

    Without events a unit is `pending`; if its last event failed, `failed`; with every step done, `completed`; with a
    failure that later events left behind, `degraded`; else `running`. last_step is the furthest of `steps` reached.
    """
    names = F.array(*[F.lit(s) for s in steps])
    place = F.nullif(F.array_position(names, F.col("step")), F.lit(0))
    state = events.groupBy("unit").agg(
        F.max(F.when(F.col("failed"), F.col("at"))).alias("_failed"), F.max("at").alias("_last"), F.max(place).alias("_reached"), F.countDistinct(place).alias("_steps")
    )
    status = (
        F.when(F.col("_last").isNull(), "pending").when(F.col("_failed") == F.col("_last"), "failed").when(F.col("_steps") == len(steps), "completed").when(F.col("_failed").isNotNull(), "degraded").otherwise("running")
    )
    last = F.when(F.col("_reached").isNotNull(), F.element_at(names, F.col("_reached").cast("int")))
    return units.join(state, "unit", "left").select("unit", last.alias("last_step"), status.alias("status"))


def manifest(entries: DataFrame, unit: str, at: str, columns: list[str]) -> DataFrame:
    """A manifest of entries: of each column its last value that is not null, as a struct with its time, and updated_at."""
    last = lambda c: F.max(F.when(F.col(c).isNotNull(), F.struct(F.col(at).alias("at"), F.col(c).alias("value"))))
    return entries.groupBy(unit).agg(*[last(c).alias(c) for c in columns], F.max(at).alias("updated_at"))


def upserted(old: DataFrame, new: DataFrame, unit: str, columns: list[str]) -> DataFrame:
    """Two manifests as one, in values: the later of each column, and the later updated_at. Units of either are there."""
    both = old.unionByName(new).groupBy(unit).agg(*[F.max(c).alias(c) for c in columns], F.max("updated_at").alias("updated_at"))
    return both.select(unit, *[F.col(c).getField("value").alias(c) for c in columns], "updated_at")
