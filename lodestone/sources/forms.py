"""Reactive forms of source texts: groups, controls, validators and conditions, from tokens and their brackets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.sources.tokens import bound, token_arrays

# Fixed values of the analysed framework: what makes forms and controls, the builder's methods among it, and modifiers of members.
CLASSES = {"FormArray": "array", "FormControl": "control", "FormGroup": "group", "FormRecord": "record"}
METHODS = ("array", "control", "group", "record")
BUILT_GROUPS = ("group", "record")
MODIFIERS = ("private", "protected", "public", "readonly", "static", "override", "declare")
#: Names in a row before the bracket of a call, at most: `this.fb.nonNullable.group(` has four.
CHAIN = 5


def _is(token: Column, sign: str) -> Column:
    return (token["kind"] == "sign") & (token["value"] == sign)


def _places(begin: Column, stop: Column) -> Column:
    """The places from `begin` on, before `stop`."""
    return F.when(begin < stop, F.sequence(begin, stop - 1)).otherwise(F.expr("cast(array() as array<int>)"))


def _spans(bounds: Column, f) -> Column:
    """f of each bound and the next one, in order: as many as there are bounds, less one."""
    return bound(bounds, lambda b: F.transform(F.slice(b, 1, F.size(b) - 1), lambda begin, k: f(begin, F.get(b, k + 1))))


def _made(tokens: Column, at: Column) -> Column:
    """What an expression that begins at a place makes: a class after `new`, or the last name of a chain that is called; and where its bracket is."""
    said = lambda k: F.get(tokens, at + k)["value"]
    made = lambda new, name, bracket: F.struct(F.lit(new).alias("new"), said(name).alias("name"), (at + bracket).alias("bracket"))
    out = F.when((said(0) == "new") & (said(2) == "("), made(True, 1, 2)).when((said(0) == "new") & (said(2) == "<") & (said(4) == ">") & (said(5) == "("), made(True, 1, 5))
    for names in range(2, CHAIN + 1):
        dots = F.lit(True)
        for k in range(names - 1):
            dots &= said(2 * k + 1) == "."
        out = out.when(dots & (said(2 * names - 1) == "("), made(False, 2 * names - 2, 2 * names - 1))
    return out


def object_properties(tokens: Column, opened: Column) -> Column:
    """name, ord, value_ord and stop of every property of the object that opens at a place of a source's tokens.

    `stop` is the token that ends a property's value: a comma in the same bracket or the bracket's end. Each part between
    two of these is looked at once, so the work grows with the object alone.
    """
    token = lambda k: F.get(tokens, k)
    close = token(opened)["close"]
    commas = F.filter(_places(opened + 1, close), lambda k: (token(k)["parent"] == opened) & _is(token(k), ","))
    named = lambda begin: token(begin + 1)["kind"].isin("name", "text") & _is(token(begin + 2), ":")
    one = lambda begin, stop: F.struct(token(begin + 1)["value"].alias("name"), (begin + 1).alias("ord"), (begin + 3).alias("value_ord"), stop.alias("stop"))
    return F.array_compact(_spans(F.concat(F.array(opened), commas, F.array(close)), lambda begin, stop: F.when((begin + 1 < stop) & named(begin), one(begin, stop))))


def _class_forms(sources: DataFrame) -> DataFrame:
    """path, text, tokens, and the forms (name, new, made, object) of each source, as form_groups says."""
    outer, tokens = F.col("outer"), F.col("tokens")
    at = lambda k: F.get(outer, k)

    def head(t: Column, k: Column) -> Column:
        begins = at(k - 1)["value"].isin("{", "}", ";", ")", *MODIFIERS) | (at(k - 1)["line"] < t["line"])
        return (t["depth"] == 1) & (t["kind"] == "name") & at(k + 1)["value"].isin("=", ":", "!", "?") & ~t["value"].isin(*MODIFIERS) & begins

    def forms(begin: Column, stop: Column) -> Column:
        """Those from one property's head to the next one."""
        value = lambda k: (at(k)["depth"] == 1) & (at(k)["parent"] == at(begin)["parent"]) & (at(k - 1)["value"] == "=")
        made = F.transform(F.filter(_places(begin, stop), value), lambda k: _made(outer, k))
        kept = F.filter(made, lambda m: F.when(m["new"], m["name"].isin(*CLASSES)).otherwise(m["name"].isin(*BUILT_GROUPS)))
        # what follows the call's bracket at once may lie deeper than the outer tokens
        first = lambda m: F.get(tokens, at(m["bracket"])["ord"] + 1)
        opened = lambda m: F.when(_is(first(m), "{") & (first(m)["depth"] == 2), first(m)["ord"])
        return F.transform(kept, lambda m: F.struct(at(begin)["value"].alias("name"), m["new"].alias("new"), m["name"].alias("made"), opened(m).alias("object")))

    rows = token_arrays(sources).withColumn("outer", F.filter("tokens", lambda t: t["depth"] <= 1))
    heads = F.array_compact(F.transform("outer", lambda t, k: F.when(head(t, k), k)))
    return rows.select("path", "text", "tokens", F.flatten(_spans(F.concat(heads, F.array(F.size("outer"))), forms)).alias("forms"))


def form_groups(sources: DataFrame) -> DataFrame:
    """path, name, built_with and object of every property of a class that is made a form.

    A form is made by `new` of a form class or by a builder's `group` or `record`; object is the ord of the object that is
    its first argument, null if that is none. A property's head is a name at the beginning of a member, before `=` or its
    type.
    """
    built = lambda f: F.when(f["new"], F.concat(F.lit("new "), f["made"])).otherwise("FormBuilder")
    # an expression, since Catalyst would filter sources by a named array first and so make it twice
    groups = F.transform("forms", lambda f: F.struct(f["name"].alias("name"), built(f).alias("built_with"), f["object"].alias("object")))
    return _class_forms(sources).select("path", F.inline(groups))


def form_controls(sources: DataFrame) -> DataFrame:
    """path, id, kind, validators and disabled of every control that a group's object names.

    validators are the names after `Validators.` in the control's value, in order; disabled is the text of the property of
    that name in the value, or in the first element of a list, the last one if there are several. Values are told apart by
    the commas of their object, so each token is looked at for the one control whose value holds it.
    """
    token = lambda k: F.get(F.col("tokens"), k)
    classes = F.create_map(*[F.lit(x) for pair in CLASSES.items() for x in pair])

    def kind(at: Column) -> Column:
        by_class = lambda m: F.when(m["new"], F.try_element_at(classes, m["name"])).when(m["name"].isin(*METHODS), m["name"])
        return F.coalesce(bound(_made(F.col("tokens"), at), by_class), F.lit("control"))

    def validators(p: Column) -> Column:
        used = F.filter(_places(p["ord"] + 1, p["stop"]), lambda k: (token(k)["value"] == "Validators") & (token(k)["kind"] == "name") & (token(k + 1)["value"] == "."))
        return F.transform(used, lambda k: token(k + 2)["value"])

    def disabled(at: Column) -> Column:
        flags = F.when(_is(token(at), "{"), F.filter(object_properties(F.col("tokens"), at), lambda p: p["name"] == "disabled"))
        begin, stop = lambda p: token(p["value_ord"])["start"], lambda p: token(p["stop"])["start"]
        return bound(flags, lambda f: bound(F.get(f, F.size(f) - 1), lambda p: F.trim(F.substring("text", begin(p) + 1, stop(p) - begin(p)))))

    def control(form: Column, p: Column) -> Column:
        first = p["value_ord"] + F.when(_is(token(p["value_ord"]), "["), 1).otherwise(0)
        name = F.concat(F.lit("control:"), form, F.lit("."), p["name"])
        return bound(first, lambda at: F.struct(name.alias("id"), kind(at).alias("kind"), validators(p).alias("validators"), disabled(at).alias("disabled")))

    groups = F.filter("forms", lambda f: token(f["object"])["close"].isNotNull())
    controls = F.transform(groups, lambda f: F.transform(object_properties(F.col("tokens"), f["object"]), lambda p: control(f["name"], p)))
    return _class_forms(sources).select("path", F.inline(F.flatten(controls)))
