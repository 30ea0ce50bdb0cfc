"""Warnings, statuses, counts of constructs, coverage and run summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Severities in rising order.
SEVERITIES = ("info", "warning", "error")


def deduped_warnings(warnings: DataFrame, unit: str, order: list[str], first: str) -> DataFrame:
    """One row per unit, code and message: its first `first`, and its count where it occurs twice or more."""
    n = F.count(F.lit(1))
    found = warnings.groupBy(unit, "code", "message").agg(n.alias("_n"), F.min(F.struct(*order, *([] if first in order else [first]))).alias("_first"))
    return found.select(unit, "code", "message", F.col(f"_first.{first}").alias("first"), F.when(F.col("_n") >= 2, F.col("_n")).alias("count"))


def parse_status(units: DataFrame, warnings: DataFrame, unit: str) -> DataFrame:
    """`ok`, `partial` or `failed` for each unit, by the worst severity among its warnings; `ok` without any."""
    rank = F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), F.col("severity"))
    worst = warnings.groupBy(unit).agg(F.max(rank).alias("_worst"))
    return units.select(unit).distinct().join(worst, unit, "left").select(unit, F.when(F.col("_worst") >= 3, "failed").when(F.col("_worst") == 2, "partial").otherwise("ok").alias("status"))


def construct_counts(texts: DataFrame, unit: str, text: str, patterns: dict[str, str]) -> DataFrame:
    """Long form: how often each pattern matches in each text. The text is read once."""
    counted = texts.select(unit, *[F.regexp_count(F.coalesce(text, F.lit("")), F.lit(p)).cast("bigint").alias(k) for k, p in patterns.items()])
    return counted.unpivot([unit], list(patterns), "construct", "occurrences")


def recall_gaps(scanned: DataFrame, recorded: DataFrame, keys: list[str]) -> DataFrame:
    """Constructs of which a scan sees more than were recorded; those whose recorded number is null are not measured."""
    both = scanned.join(recorded, keys, "left").filter("recorded IS NOT NULL AND scanned > recorded")
    return both.select(*keys, "scanned", "recorded", (F.col("scanned") - F.col("recorded")).alias("gap"))


def coverage_ratio(rows: DataFrame, group: list[str], hit: Column) -> DataFrame:
    """Total, hits and their ratio to three places for each group; null where there is nothing."""
    n, k = F.count(F.lit(1)), F.coalesce(F.sum(F.when(hit, 1).otherwise(0)), F.lit(0))
    return rows.groupBy(*group).agg(n.alias("total"), k.cast("bigint").alias("hits"), F.round(k / F.nullif(n, F.lit(0)), 3).alias("ratio"))


def run_summary(rows: DataFrame, columns: list[str], measure: str) -> DataFrame:
    """Counts and sums by each column and overall, in one pass: facet, value, n, total."""
    facet = F.lit("all")
    for c in columns:
        facet = F.when(F.grouping(c) == 0, F.lit(c)).otherwise(facet)
    value = F.coalesce(*[F.col(c).cast("string") for c in columns])
    found = rows.groupingSets([[c] for c in columns] + [[]], *columns).agg(facet.alias("facet"), F.count(F.lit(1)).alias("n"), F.round(F.sum(measure), 2).alias("total"))
    return found.select("facet", value.alias("value"), "n", "total")


def validation_totals(checked: DataFrame) -> DataFrame:
    """Checked, failed, skipped and legacy rows by status; `passed` is false if nothing was checked."""
    total = lambda status: F.count(F.when(F.col("status") == status, 1))
    found = checked.agg(F.count(F.when(F.col("status").isin("ok", "failed"), 1)).alias("checked"), total("failed").alias("failed"), total("skipped").alias("skipped"), total("legacy").alias("legacy"))
    return found.withColumn("passed", (F.col("checked") > 0) & (F.col("failed") == 0))


def run_record(results: DataFrame, questions: DataFrame, risks: DataFrame) -> DataFrame:
    """One row that sums up a run: units, by_status and by_tier (maps of counts), blocking, non_blocking, risks (by severity) and elapsed_ms.

    `results` has unit, status, tier and elapsed_ms; `questions` (unit, blocking) and `risks` (unit, severity) count for
    completed units alone. Risks without a severity are low; other names than high, medium and low are not counted.
    Nulls of tier are left out. Groups are few: their counts, not their units, meet in one row.
    """
    done = results.filter("status = 'completed'").select("unit").distinct()
    counted = lambda rows, name: rows.filter(F.col(name).isNotNull()).groupBy(F.col(name).alias("name")).agg(F.count(F.lit(1)).alias("n"))
    as_map = lambda rows, out: rows.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "n")))).alias(out))
    severity = F.coalesce(F.lower("severity"), F.lit("low"))
    known = risks.join(done, "unit").select(severity.alias("severity")).filter(F.col("severity").isin("high", "low", "medium"))
    asked = questions.join(done, "unit").agg(F.count(F.when(F.col("blocking"), 1)).alias("blocking"), F.count(F.when(~F.coalesce("blocking", F.lit(False)), 1)).alias("non_blocking"))
    whole = results.agg(F.count(F.lit(1)).alias("units"), F.coalesce(F.sum("elapsed_ms"), F.lit(0)).alias("elapsed_ms"))
    one = [whole, as_map(counted(results, "status"), "by_status"), as_map(counted(results, "tier"), "by_tier"), asked, as_map(counted(known, "severity"), "risks")]
    # each has one row, which the same number joins
    rows = [df.withColumn("_one", F.lit(1)) for df in one]
    out = rows[0]
    for more in rows[1:]:
        out = out.join(more, "_one")
    return out.drop("_one")
