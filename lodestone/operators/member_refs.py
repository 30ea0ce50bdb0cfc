"""References between members, harvested from nested documents, and what becomes of each: known, dangling, unowned or unlinked."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.tables import written

# Fixed values of the documents: properties whose values are references, in alphabetical order.
REFERENCE_NAMES = (
    "batchedWith", "boundTo", "calledBy", "calledFrom", "calls", "consumedBy", "consumes", "coveredByExistingTest", "coveredMembers", "dep",
    "dependsOn", "derivedFrom", "emittedFrom", "entryPoints", "evidence", "executionOrder", "from", "fromMethods", "leafMethods", "mutatingMethods",
    "occurrences", "patchedBy", "produces", "publicMethods", "readBy", "reads", "resetHandler", "resolvesTo", "service", "signalDependencies",
    "submitHandler", "targets", "templateReachableMembers", "to", "uncoveredNodeIds", "unreachableMethods", "usedBy", "usedByMethods", "via", "viaDependency",
    "writes", "writtenBy",
)
# Fixed values of the documents: the tier that defines the ids of each prefix.
OWNERS = {
    "signature": ("accessor", "dep", "field", "field-initializer", "form", "input", "method", "model", "output", "stream"),
    "dependencies": ("http", "nav", "type"),
    "functions": ("test",),
    "template": ("hostbind", "hostlisten", "query", "tpl", "tpl-handler"),
}
# Fixed values of the documents: where each tier defines ids: the value, the members of a list, or the names of a map.
DECLARATIONS = (
    ("signature", "/publicApi/inputs[]/id", "value"), ("signature", "/publicApi/outputs[]/id", "value"), ("signature", "/publicApi/twoWayBindings[]/id", "value"),
    ("signature", "/injectedDependencies[]/id", "value"), ("signature", "/stateOutline/fields[]/id", "value"), ("signature", "/stateOutline/fields[]/name", "field-initializer:"),
    ("signature", "/stateOutline/methodIds", "members"), ("signature", "/stateOutline/accessorIds", "members"), ("signature", "/stateOutline/formIds", "members"), ("signature", "/stateOutline/streamIds", "members"),
    ("dependencies", "/callGraph/nodes", "members"), ("dependencies", "/httpInteractions[]/id", "value"), ("dependencies", "/routing/navigations[]/id", "value"),
    ("dependencies", "/dataTypes[]/id", "value"), ("dependencies", "/streams[]/id", "value"),
    ("functions", "/symbols", "names"), ("functions", "/tests/cases[]/id", "value"), ("functions", "/forms/groups[]/id", "value"), ("functions", "/forms/groups[]/controls[]/id", "value"), ("functions", "/signals[]/id", "value"),
    ("template", "/ast/*[]/id", "value"),
)
#: A property of this name holds a reference even if it names no member.
UNLINKED_NAME = "coveredByExistingTest"


def _is(value: Column, kind: str) -> Column:
    return F.startswith(F.schema_of_variant(value), F.lit(kind))


def properties(documents: DataFrame) -> DataFrame:
    """unit, tier, path, place, name and value (a variant) of every property of every object in documents (unit, tier, text).

    `place` is the path without the positions in lists. Documents are parsed once; each level is written, and made from
    the one above it alone. Null and broken texts have no properties.
    """
    spark = documents.sparkSession
    level = documents.select("unit", "tier", F.lit("").alias("path"), F.lit("").alias("place"), F.try_parse_json("text").alias("value")).filter("value IS NOT NULL")
    found = []
    while True:
        inside = level.filter(_is(F.col("value"), "OBJECT") | _is(F.col("value"), "ARRAY")).withColumnRenamed("value", "outer_value")
        each = inside.lateralJoin(spark.tvf.variant_explode(F.col("outer_value").outer()))
        step = lambda c, index: F.concat(c, F.when(F.col("key").isNull(), index).otherwise(F.concat(F.lit("/"), "key")))
        position = F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]"))
        level = written(each.select("unit", "tier", step("path", position).alias("path"), step("place", F.lit("[]")).alias("place"), F.col("key").alias("name"), "value"))
        found.append(level.filter("name IS NOT NULL"))
        if not level.limit(1).count():
            return reduce(DataFrame.unionByName, found)


def _inside(rows: DataFrame) -> DataFrame:
    """The columns of `rows` but value, with name and value of each member of the lists and maps there; names are null in lists."""
    kept = [c for c in rows.columns if c not in ("name", "value")]
    each = rows.withColumnRenamed("value", "held").lateralJoin(rows.sparkSession.tvf.variant_explode(F.col("held").outer()))
    return each.select(*kept, F.col("key").alias("name"), "value")


def _texts(rows: DataFrame, path: Column | str = "path") -> DataFrame:
    """unit, tier, path and ref of the values that are strings."""
    return rows.filter(_is(F.col("value"), "STRING")).select("unit", "tier", F.col(path).alias("path") if isinstance(path, str) else path.alias("path"), F.try_variant_get("value", "$", "string").alias("ref"))


def references(found: DataFrame, names: tuple[str, ...] = REFERENCE_NAMES) -> DataFrame:
    """unit, tier, path and ref of every reference among `found` (properties): the value of a property of these names, if it
    is a string, its strings, if it is a list, or its names and the strings in its lists, if it is a map."""
    named = found.filter(F.col("name").isin(*names))
    within = _inside(named.drop("name"))
    listed, mapped = within.filter("name IS NULL"), within.filter("name IS NOT NULL").withColumn("path", F.concat("path", F.lit("/"), "name"))
    keys = mapped.select("unit", "tier", "path", F.col("name").alias("ref"))
    below = _inside(mapped.filter(_is(F.col("value"), "ARRAY")).drop("name"))
    return reduce(DataFrame.unionByName, [_texts(named), _texts(listed), keys, _texts(below)])


def declared_ids(found: DataFrame, declarations: tuple[tuple[str, str, str], ...] = DECLARATIONS) -> DataFrame:
    """unit and id of everything that `found` (properties) declares, once each, by tier and place.

    A declaration takes the value, the members of a list, the names of a map, or the value after a prefix.
    """
    out = []
    for how in dict.fromkeys(d[2] for d in declarations):
        at = F.lit(False)
        for tier, place, own in declarations:
            if own == how:
                same = F.col("place").rlike("^" + "[^/]*".join(p.replace("[", r"\[").replace("]", r"\]") for p in place.split("*")) + "$") if "*" in place else F.col("place") == place
                at |= (F.col("tier") == tier) & same
        own_rows = found.filter(at)
        if how == "names":
            out.append(_inside(own_rows.drop("name")).select("unit", F.col("name").alias("id")))
        else:
            values = _texts(_inside(own_rows.drop("name")).filter("name IS NULL") if how == "members" else own_rows)
            out.append(values.select("unit", F.concat(F.lit(how if how.endswith(":") else ""), "ref").alias("id")))
    return reduce(DataFrame.unionByName, out).filter("id <> ''").distinct()


def outcomes(refs: DataFrame, declared: DataFrame, present: DataFrame) -> DataFrame:
    """unit, tier, path, ref, n, owner and outcome of references (unit, tier, path, ref), equal ones counted together first.

    known: declared in its unit. dangling: the tier that owns its prefix is `present` (unit, tier) and doesn't declare it.
    unowned: that tier isn't there. unlinked: of no known prefix where a reference was due (UNLINKED_NAME). Other texts
    without a known prefix are no references; their outcome is text.
    """
    owner = F.lit(None).cast("string")
    for tier, prefixes in OWNERS.items():
        owner = F.when(F.substring_index("ref", ":", 1).isin(*prefixes), tier).otherwise(owner)
    counted = refs.filter("ref IS NOT NULL").groupBy("unit", "tier", "path", "ref").agg(F.count(F.lit(1)).alias("n")).withColumn("owner", owner)
    known = declared.select("unit", F.col("id").alias("ref")).distinct().withColumn("known", F.lit(True))
    there = present.select("unit", F.col("tier").alias("owner")).distinct().withColumn("there", F.lit(True))
    joined = counted.join(known, ["unit", "ref"], "left").join(there, ["unit", "owner"], "left")
    unlinked = F.when(F.endswith("path", F.lit(UNLINKED_NAME)), "unlinked").otherwise("text")
    outcome = F.when(F.col("owner").isNull(), unlinked).when(F.col("known"), "known").when(F.col("there"), "dangling").otherwise("unowned")
    return joined.select("unit", "tier", "path", "ref", "n", "owner", outcome.alias("outcome"))


def outcome_report(found: DataFrame) -> DataFrame:
    """unit, outcome, owner, refs, ids (distinct) and the first place with an example, of all outcomes but text."""
    # by id before: a frequent one is one row, and ids needn't be held to be told apart
    ids = found.filter("outcome <> 'text'").groupBy("unit", "outcome", "owner", "ref").agg(F.sum("n").alias("n"), F.min(F.struct("tier", "path")).alias("place"))
    whole = ids.groupBy("unit", "outcome", "owner").agg(F.sum("n").alias("refs"), F.count(F.lit(1)).alias("ids"), F.min(F.struct("place", "ref")).alias("first"))
    return whole.select("unit", "outcome", "owner", "refs", "ids", F.col("first.ref").alias("example"), F.concat("first.place.tier", "first.place.path").alias("cited_at"))


def unit_verdicts(found: DataFrame, declared: DataFrame, present: DataFrame, legacy: DataFrame) -> DataFrame:
    """unit, declared, refs, dangling, unowned, unlinked and verdict of each unit that has a tier.

    verdict is ok without dangling references, else legacy for a unit in `legacy` (unit), whose documents are of an older
    version, else failed.
    """
    total = lambda outcome: F.coalesce(F.sum(F.when(F.col("outcome") == outcome, F.col("n"))), F.lit(0)).alias(outcome)
    counts = found.groupBy("unit").agg(F.sum("n").alias("refs"), total("dangling"), total("unowned"), total("unlinked"))
    ids = declared.groupBy("unit").agg(F.count(F.lit(1)).alias("declared"))
    old = legacy.select("unit").distinct().withColumn("old", F.lit(True))
    rows = present.select("unit").distinct().join(ids, "unit", "left").join(counts, "unit", "left").join(old, "unit", "left").na.fill(0)
    verdict = F.when(F.col("dangling") == 0, "ok").when(F.col("old"), "legacy").otherwise("failed")
    return rows.select("unit", "declared", "refs", "dangling", "unowned", "unlinked", verdict.alias("verdict"))
