"""Views of units' tier documents that do not depend on order, so that units written in different ways can be compared.

A view is a list of items at a place in one tier's document. Items are maps of the fields that matter; equal items are
counted, so that two units agree in a view if they have the same items equally often.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the analysed framework: the constructs of templates by what they do.
CONSTRUCTS = {
    "conditional": ("*ngIf", "@if"),
    "defer": ("@defer",),
    "loop": ("*ngFor", "@for"),
    "switch": ("@switch", "ngSwitch"),
}
# Fixed values of the analysed framework: the parts of constructs.
BRANCHES = {
    "case": ("*ngSwitchCase", "@case"),
    "default": ("*ngSwitchDefault", "@default"),
    "else": ("@else", "@else if"),
    "empty": ("@empty",),
}


@dataclass(frozen=True)
class View:
    """Where items are and what of them is compared.

    `place` leads to a list, or to lists in lists (`[]`) or to all values of a map (`{}`). `fields` are kept of each item,
    with what stands for a field that isn't there; without fields an item is a text. `links` says that the place has a map
    of lists, whose items are pairs. `flags` are kept as whether they say anything but the given text, `sets` as their
    sorted members or, of a map, the names that are true. `classes` keeps the class of the field `construct` and drops
    items that have none. An item of which a field says `nothing` is none.
    """

    tier: str
    place: str
    fields: dict[str, str] = field(default_factory=dict)
    links: bool = False
    flags: dict[str, str] = field(default_factory=dict)
    sets: tuple[str, ...] = ()
    classes: dict[str, tuple[str, ...]] | None = None
    nothing: str | None = None


#: The names are those that manifests of pairs use.
VIEWS = {
    "inputs": View("signature", "publicApi.inputs[]", {"name": "", "required": "false", "alias": "-"}),
    "outputs": View("signature", "publicApi.outputs[]", {"name": "", "payloadType": "-"}),
    "twoWay": View("signature", "publicApi.twoWayBindings[]", {"name": ""}),
    "publicMethods": View("signature", "publicApi.publicMethods[]"),
    "deps": View("signature", "injectedDependencies[]", {"propertyName": "", "token": "", "visibility": "-"}, sets=("modifiers",)),
    "lifecycleHooks": View("signature", "lifecycle.implementedHooks[]"),
    "fields": View("signature", "stateOutline.fields[]", {"name": "", "visibility": "-"}),
    "callEdges": View("dependencies", "callGraph.calls", links=True),
    "fieldWrites": View("dependencies", "fieldAccess.writes", links=True),
    "unreachable": View("dependencies", "callGraph.unreachableMethods[]"),
    "controlFlowPrimary": View("template", "ast.controlFlow[]", classes=CONSTRUCTS),
    "controlFlowBranches": View("template", "ast.controlFlow[]", classes=BRANCHES),
    "loopTracking": View("template", "ast.controlFlow[]", classes={"loop": CONSTRUCTS["loop"]}, flags={"trackBy": ""}),
    "templateHandlers": View("template", "ast.eventBindings[]", {"event": "", "handlerMethod": "?"}),
    "pipes": View("template", "ast.pipesUsed[]", {"name": ""}),
    "elementTags": View("template", "ast.elements[]", {"tag": ""}),
    "formApproach": View("functions", "forms", {"approach": "none"}, nothing="none"),
    "formConstraints": View("functions", "forms.groups[].controls[]", {"path": ""}, flags={"disabledExpression": ""}, sets=("syncValidators",)),
    "leakRisk": View("functions", "symbols{}.ast.subscriptions[]", flags={"unsubscribeStrategy": "none"}),
    "testTitles": View("functions", "tests.cases[]", {"title": ""}),
}


def _got(value: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(value, "$" + path, kind)


def _elements(document: Column, place: str) -> Column:
    """An array of variants: what is at a place, with the lists and maps on the way taken apart; nulls are no items."""
    found = F.array(document)
    for step in place.replace("[]", ".[]").replace("{}", ".{}").split("."):
        if step == "[]":
            found = F.flatten(F.transform(found, lambda v: F.coalesce(_got(v, "", "array<variant>"), F.array())))
        elif step == "{}":
            found = F.flatten(F.transform(found, lambda v: F.coalesce(F.map_values(_got(v, "", "map<string, variant>")), F.array())))
        else:
            path = f".{step}"
            found = F.transform(found, lambda v: _got(v, path, "variant"))  # noqa: B023 - called at once
        found = F.filter(found, lambda v: v.isNotNull() & ~F.is_variant_null(v))
    return found


def _item(view: View, value: Column) -> Column:
    """A map of what is compared of one item."""
    pairs = []
    if view.classes:
        kinds = F.create_map(*[F.lit(x) for kind, names in view.classes.items() for name in names for x in (name, kind)])
        pairs.append(("class", F.element_at(kinds, _got(value, ".construct", "string"))))
    pairs += [(name, F.coalesce(_got(value, f".{name}", "string"), F.lit(absent))) for name, absent in view.fields.items()]
    pairs += [(name, (~F.coalesce(_got(value, f".{name}", "string"), F.lit(none)).isin("", none)).cast("string")) for name, none in view.flags.items()]
    for name in view.sets:
        true = F.map_filter(F.coalesce(_got(value, f".{name}", "map<string, boolean>"), F.expr("cast(map() as map<string, boolean>)")), lambda _, v: F.coalesce(v, F.lit(False)))
        pairs.append((name, F.array_join(F.array_sort(F.concat(F.map_keys(true), F.coalesce(_got(value, f".{name}", "array<string>"), F.expr("cast(array() as array<string>)")))), ",")))
    if not pairs:
        pairs.append(("name", _got(value, "", "string")))
    return F.map_from_arrays(F.array(*[F.lit(n) for n, _ in pairs]), F.array(*[c for _, c in pairs]))


def _items(view: View, document: Column) -> Column:
    if view.links:
        held = F.coalesce(_got(document, f".{view.place}", "map<string, array<string>>"), F.expr("cast(map() as map<string, array<string>>)"))
        pair = lambda a, b: F.map_from_arrays(F.array(F.lit("from"), F.lit("to")), F.array(a, b))
        return F.flatten(F.transform(F.map_entries(held), lambda e: F.transform(F.coalesce(e["value"], F.array()), lambda to: pair(e["key"], to))))
    items = F.transform(_elements(document, view.place), lambda v: _item(view, v))
    if view.nothing is not None:
        items = F.filter(items, lambda i: ~F.array_contains(F.map_values(i), view.nothing))
    return F.filter(items, lambda i: i["class"].isNotNull()) if view.classes else items


def projections(tiers: DataFrame, views: dict[str, View] | None = None) -> DataFrame:
    """unit, name, item (a map) and n of every different item of each view, from tiers (unit, tier, text).

    Each document is parsed once, and its views are taken in one pass. A tier that is missing or broken has no items; so
    has a unit none in a view of which its document says nothing.
    """
    views = views or VIEWS
    parsed = tiers.withColumn("document", F.try_parse_json("text")).filter("document IS NOT NULL")
    named = lambda name, view: F.transform(_items(view, F.col("document")), lambda i: F.struct(F.lit(name).alias("name"), i.alias("item")))
    own = lambda tier: F.flatten(F.array(*[named(name, v) for name, v in views.items() if v.tier == tier]))
    rows = F.coalesce(*[F.when(F.col("tier") == tier, own(tier)) for tier in dict.fromkeys(v.tier for v in views.values())])
    each = parsed.select("unit", F.inline(rows))
    # maps can't be grouped by; their entries can
    counted = each.groupBy("unit", "name", F.map_entries("item").alias("entries")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select("unit", "name", F.map_from_entries("entries").alias("item"), "n")


def view_values(items: DataFrame, units: DataFrame, views: dict[str, View] | None = None) -> DataFrame:
    """unit, name and value for every one of `units` (unit) and every view: its items with their numbers, sorted, as one JSON text."""
    value = F.to_json(F.array_sort(F.collect_list(F.struct(F.map_entries("item").alias("item"), "n"))))
    whole = items.groupBy("unit", "name").agg(value.alias("value"))
    names = F.explode(F.array(*[F.lit(n) for n in views or VIEWS])).alias("name")
    return units.select("unit").distinct().select("unit", names).join(whole, ["unit", "name"], "left").withColumn("value", F.coalesce("value", F.lit("[]")))


def declared_pairs(manifest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs (id, left, right) and the projections in which each may differ (left, right, name), from a manifest's text.

    The manifest is one JSON document with `fixtures`, each with an id, a pair and equivalence.mayDiffer.
    """
    shape = "fixtures array<struct<id string, pair array<string>, equivalence struct<mayDiffer array<string>>>>"
    rows = manifest.select(F.inline(F.from_json("text", shape).getField("fixtures")))
    pairs = rows.select("id", F.get("pair", 0).alias("left"), F.get("pair", 1).alias("right"), F.col("equivalence.mayDiffer").alias("free"))
    return pairs.drop("free"), pairs.select("left", "right", F.explode("free").alias("name"))


