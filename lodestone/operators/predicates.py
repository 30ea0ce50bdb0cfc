"""What calls, hooks and sources say about a unit: requests, navigations, side effects, teardown, forms, warnings.

Calls are rows (unit, site, ord, owner, member, argument) for `this.owner.member(argument)`; dependencies are rows
(unit, property, token). `ord` rises with the place in the source and is unique within a unit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.sources.tokens import code_only

# Fixed values of the analysed framework: names that requests, navigations, hooks, timers and stores have.
HTTP_VERBS = ("get", "post", "put", "patch", "delete")
NAVIGATIONS = ("navigate", "navigateByUrl")
ROUTE_READS = ("queryParams", "params", "data")
HOOKS = ("ngOnInit", "ngOnDestroy", "ngOnChanges", "ngDoCheck", "ngAfterContentInit", "ngAfterContentChecked", "ngAfterViewInit", "ngAfterViewChecked")
#: Tokens that come with the framework, by what they serve; all others are a project's own.
FRAMEWORK_TOKENS = {
    "requests": ("HttpClient", "HttpHeaders", "HttpParams"),
    "routing": ("ActivatedRoute", "ActivatedRouteSnapshot", "Router"),
    "views": ("ChangeDetectorRef", "DestroyRef", "ElementRef", "Injector", "NgZone", "Renderer2", "TemplateRef", "ViewContainerRef"),
    "forms": ("FormBuilder", "NonNullableFormBuilder", "UntypedFormBuilder"),
}
DOM_ROOTS = ("document", "window")
STORES = ("localStorage", "sessionStorage")
TIMERS = ("setTimeout", "setInterval", "requestAnimationFrame")
#: A unit's way to clean up, and what it means for one stream.
PER_STREAM = {"ngOnDestroy-unsubscribe": "Subscription.unsubscribe", "takeUntilDestroyed": "takeUntilDestroyed", "DestroyRef": "DestroyRef", "async-pipe-only": "async-pipe", "none": "none"}
TEST_FRAMEWORKS = (("jest", "jest"), ("jasmine", "jasmine-karma"), ("vitest", "vitest"))


def token_origin(token: Column) -> Column:
    """`angular` for a token that comes with the framework, whole names alone, else `internal`; null for a null token."""
    known = [name for names in FRAMEWORK_TOKENS.values() for name in names]
    return F.when(token.isin(*known), "angular").when(token.isNotNull(), "internal")


def calls_with_token(calls: DataFrame, deps: DataFrame) -> DataFrame:
    """Calls on injected dependencies, with the token of each."""
    return calls.join(deps.withColumnRenamed("property", "owner"), ["unit", "owner"])


def _numbered(found: DataFrame, prefix: str) -> DataFrame:
    n = F.row_number().over(Window.partitionBy("unit").orderBy("ord"))
    return found.withColumn("id", F.concat(F.lit(f"{prefix}:"), n.cast("string")))


def http_calls(calls: DataFrame, deps: DataFrame) -> DataFrame:
    """unit, id, method, url, site of each request on a client that is injected; ids count from 1 in source order."""
    found = calls_with_token(calls, deps).filter(F.col("member").isin(*HTTP_VERBS) & F.col("token").startswith("Http"))
    return _numbered(found, "http").select("unit", "id", F.upper("member").alias("method"), F.coalesce("argument", F.lit("")).alias("url"), "site")


def navigations(calls: DataFrame, deps: DataFrame) -> DataFrame:
    """unit, id, api, target, site of each navigation by an injected router."""
    found = calls_with_token(calls, deps).filter(F.col("member").isin(*NAVIGATIONS) & F.col("token").endswith("Router"))
    return _numbered(found, "nav").select("unit", "id", F.concat(F.lit("router."), "member").alias("api"), F.coalesce("argument", F.lit("")).alias("target"), "site")


def route_reads(calls: DataFrame, deps: DataFrame) -> DataFrame:
    """unit, kind, site, ord: what each site reads of an injected route, once for a kind and site; the first counts."""
    found = calls_with_token(calls, deps).filter(F.col("member").isin(*ROUTE_READS) & F.contains("token", F.lit("ActivatedRoute")))
    return found.groupBy("unit", F.col("member").alias("kind"), "site").agg(F.min("ord").alias("ord"))


def side_effects(steps: DataFrame) -> DataFrame:
    """One row of flags for each unit and site, with dom_apis, the distinct DOM calls in order of their first.

    Steps are rows (unit, site, ord, form, root, callee, member): form is call, throw, try or assign (to a property of
    an injected dependency), root the first name of a call chain, callee its text, member its last name, null for a
    plain function. Equal callees are counted together first, so that long sites cross the shuffle as few rows.
    """
    call, member = F.col("form") == "call", F.col("member")
    flag = lambda c: F.coalesce(c, F.lit(False))
    flags = {
        "touches_dom": call & F.col("root").isin(*DOM_ROOTS),
        "uses_storage": call & F.col("root").isin(*STORES),
        "uses_timers": call & member.isNull() & F.col("callee").isin(*TIMERS),
        "subscribes": call & (member == "subscribe"),
        "navigates": call & member.isin(*NAVIGATIONS),
        "mutates_injected": F.col("form") == "assign",
        "throws": F.col("form") == "throw",
        "has_try": F.col("form") == "try",
    }
    once = steps.select("unit", "site", "ord", "callee", *[flag(c).alias(name) for name, c in flags.items()])
    once = once.groupBy("unit", "site", "callee").agg(F.min("ord").alias("ord"), *[F.bool_or(name).alias(name) for name in flags])
    dom = F.array_sort(F.collect_list(F.when(F.col("touches_dom"), F.struct("ord", "callee"))))
    return once.groupBy("unit", "site").agg(*[F.bool_or(name).alias(name) for name in flags], F.transform(dom, lambda x: x.getField("callee")).alias("dom_apis"))


def public_methods(methods: DataFrame) -> DataFrame:
    """The methods (unit, name, visibility) that are public and no lifecycle hooks."""
    return methods.filter((F.col("visibility") == "public") & ~F.col("name").isin(*HOOKS))


#: What a source says when it ends its streams: a call of `name` as a member, a plain use of `name`, a call of `inject` for
#: `name` with or without type arguments, and a template pipe of `name`, whatever white space stands between.
def _member_call(name: str) -> str:
    return rf"\.\s*{name}\s*\("


def _injected(name: str) -> str:
    return rf"\binject\s*(?:<[^()]*>)?\s*\(\s*{name}\b"


def _piped(name: str) -> str:
    return rf"(?<!\|)\|(?!\|)\s*{name}\b"


def cleanup_strategy(destroys: Column, body: Column, template: Column) -> Column:
    """How a unit cleans up; `destroys` says whether it has the destroy hook.

    A unit with the hook ends its streams there or not at all. Of the others, the first that holds: a stream that ends with
    the unit by `takeUntilDestroyed`, an injected `DestroyRef`, streams that only the template reads.
    """
    ways = (
        ("takeUntilDestroyed", ~destroys & body.rlike(r"\btakeUntilDestroyed\b")),
        ("DestroyRef", ~destroys & body.rlike(_injected("DestroyRef"))),
        ("async-pipe-only", ~destroys & template.rlike(_piped("async"))),
        ("ngOnDestroy-unsubscribe", destroys & body.rlike(_member_call("unsubscribe"))),
    )
    return F.coalesce(*[F.when(holds, F.lit(name)) for name, holds in ways], F.lit("none"))


def stream_strategy(cleanup: Column) -> Column:
    """What a unit's way to clean up means for each stream; null where it is unknown, which callers report as a gap."""
    return F.element_at(F.create_map(*[F.lit(x) for pair in PER_STREAM.items() for x in pair]), cleanup)


def subscription_strategy(operators: Column, cleanup: Column) -> Column:
    """How one subscription ends: by its own operators first, else by its unit's way to clean up."""
    own = F.exists(operators, lambda name: F.contains(name, F.lit("takeUntilDestroyed")))
    return F.when(own, "takeUntilDestroyed").when(cleanup.isin("ngOnDestroy-unsubscribe", "DestroyRef"), stream_strategy(cleanup)).otherwise("none")


def leak_risk(strategy: Column) -> Column:
    return F.when(F.coalesce(strategy, F.lit("none")) == "none", "possible").otherwise("none")


def form_approach(groups: Column, bound: Column) -> Column:
    """By the numbers of form groups in the code and of model bindings in the template."""
    return F.when((groups > 0) & (bound > 0), "mixed").when(groups > 0, "reactive").when(bound > 0, "template-driven").otherwise("none")


def control_kind(initializer: Column) -> Column:
    """The kind of control that an initializer makes; a plain value or an array of one is a control."""
    made = F.regexp_extract(initializer, r"^\s*\[?\s*new\s+Form(Array|Record|Group|Control)\b", 1)
    built = F.regexp_extract(initializer, r"^\s*\[?\s*[\w$.]+\.(array|record|group|control)\s*\(", 1)
    return F.lower(F.coalesce(F.nullif(made, F.lit("")), F.nullif(built, F.lit("")), F.lit("control")))


def test_framework(spec: Column) -> Column:
    """The framework that a spec names, the first of several; `unknown` without one or without a spec."""
    out = F.lit("unknown")
    for word, name in reversed(TEST_FRAMEWORKS):
        out = F.when(F.coalesce(spec.rlike(rf"\b{word}\b"), F.lit(False)), name).otherwise(out)
    return out


def complexity(text: Column) -> Column:
    """1 and one for each branch of a source text outside comments and literals, found by keywords and operators."""
    branches = r"\b(?:if|for|while|catch)\s*(?=\()|\bcase\b|&&|\|\||\?\?|\s\?\s"
    return (F.regexp_count(code_only(text), F.lit(branches)) + 1).cast("bigint")


def with_severity(warnings: DataFrame, codes: DataFrame) -> DataFrame:
    """Warnings with the severity that `codes` (code, severity) gives; a code that is not among them fails the query."""
    unknown = F.raise_error(F.concat(F.lit("unknown warning code: "), F.coalesce("code", F.lit("null"))))
    return warnings.join(codes, "code", "left").withColumn("severity", F.coalesce("severity", unknown))


def scanned_once(edges: DataFrame, key: str, scan) -> DataFrame:
    """Edges joined with what `scan` finds for each distinct `key`, so that a shared key is scanned once."""
    return edges.join(scan(edges.select(key).distinct()), key, "left")
