"""Classification by rules that are data: bounds on measures, the first rule whose bounds all hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: rank, result and (measure, least, most) of each rule; a rule without bounds always holds.
TIERS = (
    (0, "complex", (("lines", 201, None),)),
    (1, "complex", (("methods", 11, None),)),
    (2, "trivial", (("forms", None, 0), ("streams", None, 0), ("requests", None, 0), ("called_members", None, 0), ("methods", None, 3))),
    (3, "standard", ()),
)
OVERSIZED = (
    (0, "oversized", (("lines", 801, None),)),
    (1, "oversized", (("methods", 41, None),)),
    (2, "regular", ()),
)


def rule_table(spark: SparkSession, rules: tuple) -> DataFrame:
    """rank, result, measure, least and most: a row for each bound of a rule, or one without a measure."""
    rows = []
    for rank, result, bounds in rules:
        rows += [(rank, result, *b) for b in bounds] or [(rank, result, None, None, None)]
    return spark.createDataFrame(rows, "rank int, result string, measure string, least bigint, most bigint")


def classified(units: DataFrame, measures: DataFrame, rules: DataFrame) -> DataFrame:
    """unit, result and rank: the first rule all of whose bounds hold, for every one of `units` (unit).

    `measures` (unit, measure, value) may lack measures, which are 0 then, and repeat them, which are summed; a unit's
    measures are combined in each task before they meet. Rules are few: they are read once, into one expression. A unit
    that no rule fits has nulls.
    """
    bounds: dict[tuple, list] = {}
    for r in rules.collect():
        bounds.setdefault((r["rank"], r["result"]), []).extend([r] if r["measure"] is not None else [])
    names = sorted({r["measure"] for own in bounds.values() for r in own})
    column = {name: f"_m{k}" for k, name in enumerate(names)}
    total = lambda name: F.sum(F.when(F.col("measure") == name, F.col("value"))).alias(column[name])
    values = measures.groupBy("unit").agg(F.count(F.lit(1)).alias("_n"), *[total(name) for name in names])
    rows = units.select("unit").distinct().join(values, "unit", "left")
    out = F.lit(None).cast("struct<result: string, rank: int>")
    for (rank, result), own in sorted(bounds.items(), reverse=True):
        holds = F.lit(True)
        for r in own:
            value = F.coalesce(column[r["measure"]], F.lit(0))
            holds &= value.between(r["least"] if r["least"] is not None else value, r["most"] if r["most"] is not None else value)
        out = F.when(holds, F.struct(F.lit(result).alias("result"), F.lit(rank).alias("rank"))).otherwise(out)
    return rows.select("unit", out.alias("_first")).select("unit", "_first.result", "_first.rank")
