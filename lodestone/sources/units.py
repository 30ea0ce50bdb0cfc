"""Source units and their facts, taken from files with Spark's own functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.functions.text import base_name, dir_name, joined_path
from lodestone.sources.tokens import bound, code_tokens, token_arrays

# Decorators that make a unit, in order of precedence, with the kinds they make.
DECORATORS = (("Component", "component"), ("NgModule", "module"), ("Directive", "directive"), ("Pipe", "pipe"), ("Injectable", "service"))
# What the name of an injectable's file says of its kind.
INFIXES = ((".guard.", "guard"), (".interceptor.", "interceptor"), (".resolver.", "route-resolver"))
# Folders that are not walked.
SKIPPED = ("node_modules", ".git", "dist", "target", ".angular", "coverage", ".cache", "e2e", "cypress")


def read_sources(spark: SparkSession, path: str, pattern: str = "*.ts") -> DataFrame:
    """path and text of every source file under a folder, without specs, declarations and skipped folders."""
    files = spark.read.format("text").option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    rows = files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    skipped = "|".join(s.replace(".", "[.]") for s in SKIPPED)
    return rows.filter(~F.col("path").rlike(rf"/({skipped})/|\.(spec|d)\.ts$"))


def with_status(asked: DataFrame, sources: DataFrame) -> DataFrame:
    """The paths that were asked for, with text and status: one that `sources` lacks is `unreadable`, not an error."""
    return asked.select("path").join(sources.select("path", "text"), "path", "left").withColumn("status", F.when(F.col("text").isNull(), "unreadable").otherwise("read"))


def without_comments(text: Column) -> Column:
    """Without block comments and comment lines."""
    return F.regexp_replace(F.regexp_replace(text, r"(?s)/\*.*?\*/", " "), r"(?m)^\s*//.*$", "")


def _neighbours(tokens: DataFrame, n: int = 4) -> DataFrame:
    """Tokens with the one before (before) and the next ones (next1 to next4), of those at hand in each source."""
    order = Window.partitionBy("path").orderBy("ord")
    one = F.struct("kind", "value", "depth", "ord", "close")
    return tokens.withColumns({"before": F.lag("value").over(order), **{f"next{k}": F.lead(one, k).over(order) for k in range(1, n + 1)}})


def decorated_classes(sources: DataFrame) -> DataFrame:
    """path, class_no, class_name, and the decorators (ord, name, called) before each class that isn't inside brackets, in order.

    What stands between two such classes belongs to the later one; decorators that no class follows have a null name.
    """
    tokens = _neighbours(code_tokens(sources, 0), 2)
    named = (F.col("next1.kind") == "name") & ~F.coalesce(F.col("next1.value").isin("extends", "implements"), F.lit(False))
    is_class = (F.col("kind") == "name") & (F.col("value") == "class") & named & ~F.col("before").eqNullSafe(".")
    before = Window.partitionBy("path").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    marked = tokens.withColumn("is_class", is_class).withColumn("class_no", F.coalesce(F.count(F.when(F.col("is_class"), 1)).over(before), F.lit(0)))
    decorator = F.when((F.col("value") == "@") & (F.col("kind") == "sign") & (F.col("next1.kind") == "name"), F.struct("ord", F.col("next1.value").alias("name"), F.col("next2.value").eqNullSafe("(").alias("called")))
    name = F.max(F.when(F.col("is_class"), F.col("next1.value")))
    return marked.groupBy("path", "class_no").agg(name.alias("class_name"), F.array_sort(F.collect_list(decorator)).alias("decorators"))


def argument_properties(sources: DataFrame) -> DataFrame:
    """path, decorator (its ord), ord, name, kind, value, line of each property with a plain literal in the object that is a decorator's first argument.

    A property lies in the bracket that opens the object, which follows the decorator's name and bracket at once; a
    literal is the whole value if a comma or the object's end follows it.
    """
    found = _neighbours(code_tokens(sources, 2), 3).filter("depth = 2 AND kind = 'name'")
    alone = (F.col("next1.value") == ":") & F.col("next2.kind").isin("text", "plain") & F.col("next3.value").isin(",", "}")
    return found.filter(alone & F.col("before").isin("{", ",")).select("path", (F.col("parent") - 3).alias("decorator"), "ord", F.col("value").alias("name"), F.col("next2.kind").alias("kind"), F.col("next2.value").alias("value"), F.col("line").alias("line"))


def _unit_classes(sources: DataFrame) -> DataFrame:
    """path, class_name, kind and decorators of the first decorated class of each source that makes a unit."""
    names = F.transform("decorators", lambda d: d["name"])
    kind = F.coalesce(*[F.when(F.array_contains(names, d), F.lit(k)) for d, k in DECORATORS])
    by_name = F.coalesce(*[F.when(F.contains(base_name(F.col("path")), F.lit(infix)), F.lit(k)) for infix, k in INFIXES], F.lit("service"))
    classes = decorated_classes(sources).withColumn("kind", F.when(kind == "service", by_name).otherwise(kind)).filter("kind IS NOT NULL")
    first = F.min_by(F.struct("class_name", "kind", "decorators"), "class_no")
    return classes.groupBy("path").agg(first.alias("c")).select("path", "c.*")


def _decorated_properties(classes: DataFrame, sources: DataFrame, decorators: tuple[str, ...]) -> DataFrame:
    """The literal properties of the classes' decorators of these names: containment of each property in its argument."""
    each = classes.select("path", F.explode(F.filter("decorators", lambda d: d["called"] & d["name"].isin(*decorators))).alias("d"))
    return each.select("path", F.col("d.ord").alias("decorator")).join(argument_properties(sources), ["path", "decorator"])


def units(sources: DataFrame) -> DataFrame:
    """unit_id, kind, class_name, selector, path: the first class of each file that has a unit's decorator.

    Only classes outside brackets count, with the decorators before them, of which DECORATORS says the order of precedence;
    a selector is a quoted property of the argument of Component or Directive, not of any other object.
    """
    classes = _unit_classes(sources).filter("class_name IS NOT NULL")
    selectors = _decorated_properties(classes, sources, ("Component", "Directive")).filter("name = 'selector' AND kind = 'text'")
    selectors = selectors.groupBy("path").agg(F.min_by("value", "ord").alias("selector"))
    return classes.join(selectors, "path", "left").select(F.concat_ws(":", "kind", "path", "class_name").alias("unit_id"), "kind", "class_name", "selector", "path")


def _each(sources: DataFrame, pattern: str, groups: dict[str, int]) -> DataFrame:
    """path, ord and the groups of every match of a pattern."""
    code = without_comments(F.col("text"))
    zipped = F.arrays_zip(*[F.regexp_extract_all(code, F.lit(pattern), F.lit(g)).alias(name) for name, g in groups.items()])
    return sources.select("path", F.posexplode(zipped).alias("ord", "m")).select("path", "ord", *[F.col(f"m.{name}").alias(name) for name in groups])


def imports(sources: DataFrame) -> DataFrame:
    """path, ord, module, group (angular, rxjs, internal or third-party), package (of third parties) and relative of every import."""
    found = _each(sources, r"\b(?:import|export)\b[^;'\"]*?\bfrom\s*['\"]([^'\"]+)['\"]", {"module": 1})
    group = F.when(F.col("module").startswith("@angular/"), "angular").when(F.col("module").rlike("^rxjs(/|$)"), "rxjs").when(F.col("module").rlike(r"^(\.|app/)"), "internal").otherwise("thirdParty")
    package = F.when(group == "thirdParty", F.substring_index("module", "/", 1))
    return found.withColumn("group", group).withColumn("package", package).withColumn("relative", F.col("module").rlike(r"^\.\.?/"))


def injected(sources: DataFrame) -> DataFrame:
    """path, ord, property, token and style of injected dependencies."""
    by_call = _each(sources, r"([A-Za-z_$][\w$]*)\s*=\s*inject\(\s*([A-Za-z_$][\w$]*)", {"property": 1, "token": 2}).withColumn("style", F.lit("inject"))
    by_parameter = _each(sources, r"(?:private|protected|public)\s+(?:readonly\s+)?([A-Za-z_$][\w$]*)\s*:\s*([A-Za-z_$][\w$]*)\s*[,)]", {"property": 1, "token": 2}).withColumn("style", F.lit("constructor"))
    return by_call.unionByName(by_parameter)


def public_api(sources: DataFrame) -> DataFrame:
    """path, ord, direction (input or output) and name, for decorators and for functions."""
    decorated = _each(sources, r"@(Input|Output)\([^)]*\)\s*(?:set\s+|readonly\s+)?([A-Za-z_$][\w$]*)", {"direction": 1, "name": 2})
    called = _each(sources, r"([A-Za-z_$][\w$]*)\s*=\s*(input|output)(?:\.required)?\s*[<(]", {"name": 1, "direction": 2})
    return decorated.unionByName(called).withColumn("direction", F.lower("direction"))


#: After these, a name and a bracket are no call of that name.
NO_CALL = (".", "function", "new")


def _titled_call(t: Column) -> Column:
    """Whether a token begins a call of a plain name with a literal first argument."""
    near = lambda k: F.get(F.col("tokens"), t["ord"] + k)
    called = (t["kind"] == "name") & (near(1)["value"] == "(") & (near(1)["kind"] == "sign") & near(2)["kind"].isin("text", "plain")
    return called & ~F.coalesce(near(-1)["value"].isin(*NO_CALL), F.lit(False))


def test_titles(specs: DataFrame) -> DataFrame:
    """path, ord and title of every test case that has a literal title, also those that are skipped or focused."""
    near = lambda t, k: F.get(F.col("tokens"), t["ord"] + k)
    member = lambda t: (t["kind"] == "name") & t["value"].isin("it", "test") & (near(t, 1)["value"] == ".") & (near(t, 2)["kind"] == "name") & (near(t, 3)["value"] == "(") & near(t, 4)["kind"].isin("text", "plain")
    title = lambda t: F.when(t["value"].isin("it", "test", "xit", "fit") & _titled_call(t), near(t, 2)["value"]).when(member(t), near(t, 4)["value"])
    return token_arrays(specs).select("path", F.posexplode(F.array_compact(F.transform("tokens", title))).alias("ord", "title"))


def test_cases(specs: DataFrame, members: DataFrame, dependencies: DataFrame) -> DataFrame:
    """path, id, suite_path, title, line, targets and mocks of every `it` with a literal title, numbered in order of place.

    A case's suites are the calls of `describe` whose brackets hold it, outermost first; a case inside another one isn't
    one. targets are the ids of the `members` (path, name, id) whose name is a word of the case's text, mocks the
    `dependencies` (path, name) likewise, whatever the case of letters; both sorted. Words are met with names by hash: no
    name is compared with every text.
    """
    token = lambda k: F.get(F.col("tokens"), k)
    # a call that never closes goes on to the end of its source
    close = lambda t: F.coalesce(token(t["ord"] + 1)["close"], F.lit(2**31 - 1))
    until = lambda t: F.coalesce(token(token(t["ord"] + 1)["close"])["end"], F.length("text"))
    call = lambda t: F.struct(t["ord"].alias("ord"), close(t).alias("close"), token(t["ord"] + 2)["value"].alias("title"), t["line"].alias("line"), t["start"].alias("start"), until(t).alias("until"))
    calls = lambda name: F.transform(F.filter("tokens", lambda t: (t["value"] == name) & _titled_call(t)), call)
    # brackets hold each other or are apart, so a case that is inside another one is inside the last one kept
    after = lambda kept, c: c["ord"] > F.coalesce(F.get(kept, F.size(kept) - 1)["close"], F.lit(-1))
    outer = lambda its: F.aggregate(its, F.slice(its, 1, 0), lambda kept, c: F.when(after(kept, c), F.concat(kept, F.array(c))).otherwise(kept))
    around = lambda suites, c: F.transform(F.filter(suites, lambda s: (s["ord"] < c["ord"]) & (c["ord"] < s["close"])), lambda s: s["title"])
    # ASCII words and the letters that a name may have, as the pattern's word ends see them
    words = lambda c: F.array_distinct(F.regexp_extract_all(F.substring("text", c["start"] + 1, c["until"] - c["start"]), F.lit(r"([A-Za-z0-9_]+)"), F.lit(1)))
    case = lambda suites, c: F.struct(around(suites, c).alias("suite_path"), c["title"].alias("title"), c["line"].alias("line"), words(c).alias("words"))
    cases = bound(calls("describe"), lambda suites: F.transform(bound(calls("it"), outer), lambda c: case(suites, c)))
    rows = token_arrays(specs).select("path", cases.alias("cases"))

    own = members.select("path", F.lit("own").alias("list"), F.col("name").alias("word"), "id")
    injected = dependencies.select("path", F.lit("injected").alias("list"), F.lower("name").alias("word"), F.concat(F.lit("dep:"), "name").alias("id"))
    lists = [F.collect_set(F.when(F.col("list") == name, F.struct("word", "id"))).alias(name) for name in ("own", "injected")]
    # its size is estimated from tables that many more rows are made of, so it must not be broadcast
    names = own.unionByName(injected).groupBy("path").agg(*lists).hint("merge")

    def named(words: Column, names: Column) -> Column:
        """The sorted ids of the names that are among the words."""
        ids = lambda met: F.transform(F.filter(names, lambda n: F.array_contains(met, n["word"])), lambda n: n["id"])
        found = bound(F.array_intersect(words, F.transform(names, lambda n: n["word"])), ids)
        return F.coalesce(F.array_sort(F.array_distinct(F.array_compact(found))), F.expr("cast(array() as array<string>)"))

    lower = lambda words: F.array_distinct(F.transform(words, lambda w: F.lower(w)))
    whole = lambda c, n: F.struct(F.concat(F.lit("test:"), (n + 1).cast("string")).alias("id"), c["suite_path"].alias("suite_path"), named(c["words"], F.col("own")).alias("targets"), named(lower(c["words"]), F.col("injected")).alias("mocks"), c["title"].alias("title"), c["line"].alias("line"))
    return rows.join(names, "path", "left").select("path", F.inline(F.transform("cases", whole)))


def element_selectors(found: DataFrame) -> DataFrame:
    """Units with a selector, and whether it names an element; attribute and class selectors are reported, not joined."""
    return found.filter("selector IS NOT NULL").withColumn("is_element", ~F.col("selector").rlike(r"^[\[.]"))


def route_paths(sources: DataFrame) -> DataFrame:
    """path, ord and route of every `path` property that is a plain string."""
    return _each(sources, r"[{,]\s*path\s*:\s*(['\"])([^'\"\n]*)\1", {"route": 2})


def declared_templates(sources: DataFrame) -> DataFrame:
    """path, kind and what the unit's component decorator says of its template.

    kind is absent (the unit is no component), none, inline (template has the text, start_line its first line from 0) or
    external (url has the file). The first property that says so counts: `template` with a literal without
    substitutions, or `templateUrl` with a quoted one. Comments and other objects say nothing.
    """
    classes = _unit_classes(sources).filter("kind = 'component'")
    said = _decorated_properties(classes, sources, ("Component",)).filter("name = 'template' OR (name = 'templateUrl' AND kind = 'text')")
    first = said.groupBy("path").agg(F.min_by(F.struct("name", "value", "line"), "ord").alias("p"))
    rows = sources.select("path").join(classes.select("path", F.lit(True).alias("component")), "path", "left").join(first, "path", "left")
    kind = F.when(F.col("component").isNull(), "absent").when(F.col("p").isNull(), "none").when(F.col("p.name") == "template", "inline").otherwise("external")
    inline, external = kind == "inline", kind == "external"
    return rows.select("path", kind.alias("kind"), F.when(inline, F.col("p.value")).alias("template"), F.when(external, F.col("p.value")).alias("url"), F.when(inline, F.col("p.line")).cast("bigint").alias("start_line"))


def read_templates(declared: DataFrame, files: DataFrame) -> DataFrame:
    """path, template and status of every declared template, with external ones from `files` (path, text).

    Urls are seen from the source's folder, with `.` and `..` folded. A declared file that is not there gives an empty text
    and the status `template-not-found`; so does one above a relative root, which no file can have.
    """
    asked = declared.withColumn("file", F.when(F.col("kind") == "external", joined_path(dir_name(F.col("path")), F.col("url"))))
    there = files.select(F.col("path").alias("file"), F.col("text").alias("_text"))
    status = F.when((F.col("kind") == "external") & F.col("_text").isNull(), "template-not-found").otherwise(F.col("kind"))
    return asked.join(there, "file", "left").select("path", F.coalesce("template", "_text", F.lit("")).alias("template"), status.alias("status"))


def with_specs(sources: DataFrame, specs: DataFrame) -> DataFrame:
    """Sources with the text of the spec beside them, null where there is none, by the name that a spec must have."""
    named = sources.withColumn("spec_path", F.regexp_replace("path", r"\.ts$", ".spec.ts"))
    return named.join(specs.select(F.col("path").alias("spec_path"), F.col("text").alias("spec")), "spec_path", "left")
