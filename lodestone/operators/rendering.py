"""Documents about units, put together from rows: fenced sections in order, short pages for trivial units, scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.operators.sections import fenced

#: Sections of a unit's document, in order, with their headings.
SECTIONS = (
    ("overview", "Overview"), ("inputs", "Inputs"), ("outputs", "Outputs"), ("state", "State"), ("behaviour", "Behaviour"), ("services", "Services"),
    ("screen", "Screen"), ("forms", "Forms"), ("workflow", "Workflow"), ("risks", "Risks"), ("questions", "Open questions"), ("migration", "Migration"),
)


#: Parts of sections in order: their headings, the shape of their items, and the columns of tables.
PARTS = {
    "overview": (("purpose", None, "text", ()), ("responsibilities", "Responsibilities", "list", ())),
    "inputs": (("inputs", None, "list", ()),),
    "outputs": (("outputs", None, "list", ()),),
    "state": (("own", "Own state", "list", ()), ("derived", "Derived state", "list", ()), ("streams", "Streams", "nested", ())),
    "behaviour": (("methods", "Methods", "nested", ()), ("rules", "Rules", "list", ())),
    "services": (("calls", None, "table", ("Service", "Members", "Called from")),),
    "screen": (("labels", "Labels", "list", ()), ("states", "States", "table", ("State", "Shown when", "What it shows"))),
    "forms": (("groups", None, "text", ()), ("controls", "Controls", "table", ("Control", "Rules"))),
    "workflow": (("steps", None, "numbered", ()),),
    "risks": (("risks", None, "table", ("Severity", "Risk")),),
    "questions": (("questions", None, "list", ()),),
    "migration": (("effort", None, "text", ()), ("steps", "Steps", "numbered", ()), ("notes", "Notes", "list", ())),
}


def _rendered(shape: Column, columns: Column, items: Column) -> Column:
    """The lines of a part from its items (cells, below), in order.

    A text is its paragraphs. A list has the first cell in bold and the others after it, or one cell alone; it is nested if
    lines are below its items, numbered if its order counts. A table has its columns' names, and a cell that is not there is
    empty; bars in cells are escaped.
    """
    some = lambda cells: F.filter(cells, lambda c: c.isNotNull())
    said = lambda cells: F.when(F.size(some(cells)) < 2, F.array_join(some(cells), "")).otherwise(F.concat(F.lit("**"), F.get(some(cells), F.lit(0)), F.lit("** "), F.array_join(F.slice(some(cells), F.lit(2), F.size(some(cells)) - 1), "; ")))
    below = lambda x: F.array_join(F.transform(F.coalesce(x["below"], F.expr("cast(array() as array<string>)")), lambda b: F.concat(F.lit("\n  - "), b)), "")
    row = lambda cells: F.concat(F.lit("| "), F.array_join(F.transform(cells, lambda c: F.replace(F.coalesce(c, F.lit("")), F.lit("|"), F.lit("\\|"))), " | "), F.lit(" |"))
    rule = F.concat(F.lit("|"), F.repeat(F.lit("-|"), F.size(columns)))
    table = F.concat(F.array(row(columns), rule), F.transform(items, lambda x: row(x["cells"])))
    text = F.array_join(F.transform(items, lambda x: F.array_join(some(x["cells"]), " ")), "\n\n")
    listed = F.array_join(F.transform(items, lambda x: F.concat(F.lit("- "), said(x["cells"]), below(x))), "\n")
    numbered = F.array_join(F.transform(items, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), said(x["cells"]), below(x))), "\n")
    return F.when(shape == "text", text).when(shape == "table", F.array_join(table, "\n")).when(shape == "numbered", numbered).otherwise(listed)


def shaped_bodies(items: DataFrame, key: str = "unit", parts: dict | None = None) -> DataFrame:
    """key, section and body from items (key, section, part, ord, cells, below), each part in its shape and place.

    Items of a part are in the order of `ord`, nulls as 0, then of their cells. Parts without items are left out; items of
    unknown parts are none's.
    """
    known = [(section, part, k, heading, shape, list(columns)) for section, own in (parts or PARTS).items() for k, (part, heading, shape, columns) in enumerate(own)]
    names = items.sparkSession.createDataFrame(known, "section string, part string, place int, heading string, shape string, columns array<string>")
    ordered = F.array_sort(F.collect_list(F.struct(F.coalesce("ord", F.lit(0)).alias("ord"), "cells", "below")))
    whole = items.groupBy(key, "section", "part").agg(ordered.alias("items")).join(names, ["section", "part"])
    heading = F.when(F.col("heading").isNotNull(), F.concat(F.lit("### "), "heading", F.lit("\n"))).otherwise("")
    bodies = whole.select(key, "section", "place", F.concat(heading, _rendered(F.col("shape"), F.col("columns"), F.col("items"))).alias("body"))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("place", "body"))), lambda b: b["body"])
    return bodies.groupBy(key, "section").agg(F.array_join(lines, "\n\n").alias("body"))


def section_bodies(items: DataFrame, key: str = "unit") -> DataFrame:
    """key, section and body: the items (key, section, ord, line) of each section as a list, in the order of `ord`, nulls as 0.

    A section is one row; a unit's items fit in it.
    """
    ordered = F.array_sort(F.collect_list(F.struct(F.coalesce("ord", F.lit(0)).alias("ord"), "line")))
    return items.groupBy(key, "section").agg(F.array_join(F.transform(ordered, lambda x: F.concat(F.lit("- "), x.getField("line"))), "\n").alias("body"))


def documents(bodies: DataFrame, key: str = "unit", names: tuple = SECTIONS) -> DataFrame:
    """key and document: every section of `names` in order, fenced with its hash; empty ones say so, others are left out."""
    found = F.map_from_entries(F.collect_list(F.struct("section", "body")))
    rows = bodies.filter(F.col("section").isin(*[n for n, _ in names])).groupBy(key).agg(found.alias("_bodies"))
    parts = [F.concat(F.lit(f"## {heading}\n"), fenced(F.lit(name), F.coalesce(F.element_at("_bodies", F.lit(name)), F.lit("_None._")))) for name, heading in names]
    return rows.select(key, F.concat_ws("\n\n", *parts).alias("document"))


def trivial_page(title: Column, kind: Column, path: Column, facts: dict[str, Column]) -> Column:
    """The short page of a trivial unit: title, kind, path and a line for each fact that is there."""
    lines = [F.when(value.isNotNull(), F.concat(F.lit(f"- {name}: "), value.cast("string"))) for name, value in facts.items()]
    return F.concat_ws("\n", F.concat(F.lit("# "), title), F.concat(kind, F.lit(" in "), path), *lines)


def scores(units: DataFrame, missing: DataFrame, totals: dict[str, str]) -> DataFrame:
    """unit and, for each kind of `totals` (kind and the column that has its number), the share that is not missing.

    `missing` has unit and kind, a row for each thing that is missing. Shares have three places; null where nothing is due.
    """
    absent = missing.groupBy("unit").pivot("kind", list(totals)).agg(F.count(F.lit(1)))
    absent = absent.select("unit", *[F.col(k).alias(f"_{k}") for k in totals])
    share = lambda k, n: F.when(F.col(n) > 0, F.round((F.col(n) - F.coalesce(f"_{k}", F.lit(0))) / F.col(n), 3)).alias(k)
    return units.join(absent, "unit", "left").select("unit", *[share(k, n) for k, n in totals.items()])
