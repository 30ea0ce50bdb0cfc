"""Scanner, unit facts, references, symbols, levels, rules and enrichment by known answers and brute force."""

from __future__ import annotations

import json
import random

import pytest
from oracle import assert_same
from pyspark.sql import functions as F

from lodestone.functions.text import folded_path, joined_path, relative_path
from lodestone.operators import enrichment, graph, member_refs, predicates, rules, symbols
from lodestone.plans import member_lane, source_lane
from lodestone.sources import tokens, units


@pytest.mark.parametrize("name", sorted(member_lane.QUERIES))
def test_query_is_that_of_sql(spark, sf_dir, duck, name):
    assert assert_same(member_lane.QUERIES[name](spark, sf_dir), duck, member_lane.ORACLES[name]) > 0


# ---- scanner -------------------------------------------------------------------------------------------------


def stripped_by_hand(text):
    out, i = [], 0
    while i < len(text):
        if text.startswith("//", i):
            while i < len(text) and text[i] != "\n":
                i += 1
        elif text.startswith("/*", i):
            end = text.find("*/", i + 2)
            i = len(text) if end < 0 else end + 2
        elif text[i] in "\"'`":
            quote, i = text[i], i + 1
            while i < len(text) and text[i] != quote:
                i += 2 if text[i] == "\\" else 1
            out.append(" ")
            i += 1
        else:
            out.append(text[i])
            i += 1
    return "".join(out)


def test_code_alone_is_what_a_scanner_leaves(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("\"'`/*\\\na ") for _ in range(rng.randrange(25))) for _ in range(5000)]
    assert [tokens.strip_non_code(t) for t in texts] == [stripped_by_hand(t) for t in texts]
    long = ['"' + "a\\n" * 400_000 + '" b', "/*" + "*" * 1_000_000 + "/ c", "`" + "x" * 1_000_000, "/* open", "", None]
    found = spark.createDataFrame([(k, t) for k, t in enumerate(long)], "k int, text string").select("k", tokens.code_only(F.col("text")).alias("code"), predicates.complexity(F.col("text")).alias("n")).orderBy("k").collect()
    assert [r.code for r in found] == ["  b", " c", " ", "", "", None]
    assert [r.n for r in found] == [1, 1, 1, 1, 1, None]


def test_tokens_know_their_brackets():
    found = tokens.scan("f(`a${ g({ b: 'x}' }) }c`, /[/\"]/g, [1]) // end\n}/2")
    plain = [(t[6], t[7], t[3]) for t in found]
    assert plain[:4] == [("name", "f", 0), ("sign", "(", 0), ("template", None, 1), ("name", "g", 3)]
    assert ("text", "x}", 5) in plain and ("pattern", '/[/"]/g', 1) in plain
    opened = {k: t[5] for k, t in enumerate(found) if t[7] in ("(", "[", "{")}
    assert all(found[c][7] == {"(": ")", "[": "]", "{": "}"}[found[k][7]] for k, c in opened.items())
    assert [t[7] for t in found[-3:]] == ["}", "/", "2"] and found[-1][2] == 1
    assert tokens.unescaped(r"a\nb\x41B\u{43}\q\'") == "a\nbABCq'"
    assert tokens.scan("") == [] and len(tokens.scan("(" * 50_000)) == 50_000


# ---- unit facts ----------------------------------------------------------------------------------------------

SHAPES = {
    "p/a.ts": "class Helper { selector = 'h' }\n// @Component({ selector: 'no' })\n@Component({ providers: [{ selector: 'deep' }], selector: 'app-a', templateUrl: '../q/./a.html' })\nexport class A {}",
    "p/b.resolver.ts": "@Injectable()\nexport class B {}\n@Component({ selector: 'late' }) class Late {}",
    "p/c.ts": "@Input @Directive({ selector: `no` }) export abstract class C extends D { @Component({}) x; }",
    "p/d.ts": "const class_ = { class: 'x' }; function f() { @Component({}) class Inner {} }",
    "p/e.ts": "/* template: 'old' */ @Component({ // template: 'old'\n template: `one\n'two'`, templateUrl: './e.html' }) @Injectable() export default class E {}",
    "p/f.ts": "@Component({ selector: 'a' + b, template: x ? 'y' : 'z' }) class F {}",
    "p/g.ts": "@Component({ templateUrl: '../../../g.html' }) class G {}",
    "p/h.guard.ts": "@Pipe({ name: 'h' }) @Injectable() class H {}",
    "p/i.ts": None,
}


def test_facts_of_units_come_from_their_decorators(spark):
    sources = spark.createDataFrame(list(SHAPES.items()), "path string, text string")
    found = {(r.path, r.kind, r.class_name, r.selector) for r in units.units(sources).collect()}
    assert found == {
        ("p/a.ts", "component", "A", "app-a"),
        ("p/b.resolver.ts", "route-resolver", "B", None),
        ("p/c.ts", "directive", "C", None),
        ("p/e.ts", "component", "E", None),
        ("p/f.ts", "component", "F", None),
        ("p/g.ts", "component", "G", None),
        ("p/h.guard.ts", "pipe", "H", None),
    }
    declared = units.declared_templates(sources)
    assert {r.path: (r.kind, r.template, r.url, r.start_line) for r in declared.collect() if r.kind != "absent"} == {
        "p/a.ts": ("external", None, "../q/./a.html", None),
        "p/e.ts": ("inline", "one\n'two'", None, 1),
        "p/f.ts": ("none", None, None, None),
        "p/g.ts": ("external", None, "../../../g.html", None),
    }
    read = {r.path: (r.template, r.status) for r in units.read_templates(declared, spark.createDataFrame([("q/a.html", "<a>"), ("g.html", "<g>")], "path string, text string")).collect()}
    assert read["p/a.ts"] == ("<a>", "external") and read["p/g.ts"] == ("", "template-not-found") and len(read) == len(SHAPES)


def test_suites_hold_their_cases(spark):
    text = "describe('a', () => { it('x', () => { load(); }); describe(`b`, () => { it(\"y\", () => SAVE); fdescribe('c', () => it('z', f)) }) });\nit('w', f); it.each([1])('v', f); describe(name, () => { it('u', () => it('t', f)) }); // it('s', f)\nit('open', () => {"
    specs = spark.createDataFrame([("s", text), ("none", None)], "path string, text string")
    members = spark.createDataFrame([("s", "load", "method:load"), ("s", "f", "method:f"), ("o", "load", "method:other")], "path string, name string, id string")
    deps = spark.createDataFrame([("s", "save")], "path string, name string")
    found = sorted(((r.id, r.suite_path, r.title, r.targets, r.mocks, r.line) for r in units.test_cases(specs, members, deps).collect()), key=lambda r: int(r[0][5:]))
    assert found == [
        ("test:1", ["a"], "x", ["method:load"], [], 0),
        ("test:2", ["a", "b"], "y", [], ["dep:save"], 0),
        ("test:3", ["a", "b"], "z", ["method:f"], [], 0),
        ("test:4", [], "w", ["method:f"], [], 1),
        ("test:5", [], "u", ["method:f"], [], 1),
        ("test:6", [], "open", [], [], 2),
    ]


def test_suites_are_not_broadcast(spark, sf_dir):
    plan = source_lane.QUERIES["test_suites"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and plan.count("MapInArrow") == 1


def test_cases_of_odd_and_long_specs(spark):
    many = 1500
    long = "".join(f"describe('d{k}', () => {{ it('c{k}', () => {{ a{k}(); it('no', f) }}) }});" for k in range(many))
    odd = "it('', f); new it('no', f); x.it('no', f); function it('no') {} it(`two ${x}`, f); describe(x, () => it('in', Svc)); describe('d', () => { it('é', () => { é_a; _B })"
    specs = spark.createDataFrame([("long", long), ("odd", odd), ("empty", ""), (None, "it('null', f)")], "path string, text string")
    members = spark.createDataFrame([("long", f"a{k}", f"m{k}") for k in range(many)] + [("odd", None, "x"), ("odd", "_a", None), ("odd", "_a", "b"), ("odd", "_a", "a"), ("odd", "_a", "a"), (None, "f", "no")], "path string, name string, id string")
    deps = spark.createDataFrame([("odd", "_b"), ("odd", "SVC"), ("odd", "svc"), ("odd", None), ("empty", "f")], "path string, name string")
    found = {(r.path, r.id): (r.suite_path, r.title, r.targets, r.mocks) for r in units.test_cases(specs, members, deps).collect()}
    assert {k: v for k, v in found.items() if k[0] != "long"} == {
        ("odd", "test:1"): ([], "", [], []),
        ("odd", "test:2"): ([], "in", [], ["dep:SVC", "dep:svc"]),
        ("odd", "test:3"): (["d"], "é", ["a", "b"], ["dep:_b"]),
        (None, "test:1"): ([], "null", [], []),
    }
    assert {k[1]: v for k, v in found.items() if k[0] == "long"} == {f"test:{k + 1}": ([f"d{k}"], f"c{k}", [f"m{k}"], []) for k in range(many)}


def test_paths_fold(spark):
    rows = [("a/./b//../c", "a/c"), ("../x/..", ".."), ("/../a", "/a"), ("", "."), ("a\\b\\..\\c", "a/c"), ("../../a", "../../a"), ("/", "/")]
    made = spark.createDataFrame(rows, "path string, folded string").select("folded", folded_path(F.col("path")).alias("found"))
    assert all(r.folded == r.found for r in made.collect())
    pairs = [("a/b", "a/c/d", "../c/d"), ("a", "a", "."), ("", "x/y", "x/y"), ("/a/b", "/a", ".."), ("../a", "b", None), ("/a", "b", None), ("../a", "../b", "../b")]
    found = spark.createDataFrame(pairs, "folder string, path string, way string").select("way", relative_path(F.col("folder"), F.col("path")).alias("found"), joined_path(F.col("folder"), F.col("path")).alias("joined")).collect()
    assert [(r.way, r.found) for r in found] == [(w, w) for _, _, w in pairs]
    assert found[0].joined == "a/b/a/c/d" and found[3].joined == "/a"


# ---- references ----------------------------------------------------------------------------------------------


def test_references_of_nested_documents(spark):
    signature = {"stateOutline": {"methodIds": ["method:a"], "fields": [{"id": "field:f", "name": "f"}]}, "deep.er": [[{"usedBy": ["method:a", 3, None, "method:gone"]}]]}
    dependencies = {"calls": {"method:a": ["method:a", {"reads": "field:f"}], "method:lost": {}}, "evidence": "tpl:1", "x": {"coveredByExistingTest": ["adds"]}, "from": "free text"}
    rows = [("u", "signature", json.dumps(signature)), ("u", "dependencies", json.dumps(dependencies)), ("v", "signature", "{}"), ("w", "signature", "{oops"), ("x", "functions", None)]
    documents = spark.createDataFrame(rows, "unit string, tier string, text string")
    found = member_refs.properties(documents)
    declared = member_refs.declared_ids(found)
    assert {(r.unit, r.id) for r in declared.collect()} == {("u", "method:a"), ("u", "field:f"), ("u", "field-initializer:f")}
    result = member_refs.outcomes(member_refs.references(found), declared, documents)
    assert {(r.path, r.ref, r.n, r.outcome) for r in result.collect()} == {
        ("/deep.er[0][0]/usedBy", "method:a", 1, "known"),
        ("/deep.er[0][0]/usedBy", "method:gone", 1, "dangling"),
        ("/calls/method:a", "method:a", 2, "known"),
        ("/calls/method:a[1]/reads", "field:f", 1, "known"),
        ("/calls/method:lost", "method:lost", 1, "dangling"),
        ("/evidence", "tpl:1", 1, "unowned"),
        ("/x/coveredByExistingTest", "adds", 1, "unlinked"),
        ("/from", "free text", 1, "text"),
    }
    report = {(r.outcome, r.owner): (r.refs, r.ids, r.example, r.cited_at) for r in member_refs.outcome_report(result).collect()}
    assert report["dangling", "signature"] == (2, 2, "method:lost", "dependencies/calls/method:lost")
    verdicts = {r.unit: (r.declared, r.refs, r.verdict) for r in member_refs.unit_verdicts(result, declared, documents, documents.filter("unit = 'v'")).collect()}
    assert verdicts == {"u": (3, 9, "failed"), "v": (0, 0, "ok"), "w": (0, 0, "ok"), "x": (0, 0, "ok")}
    assert member_refs.properties(documents.limit(0)).count() == 0


def test_a_name_of_several_kinds_is_the_best_of_them(spark):
    table = spark.createDataFrame([("u", "x", k) for k in ("field", "accessor", "method", "dependency")] + [("u", "s", "signal"), ("v", "x", "field")], "unit string, name string, kind string")
    asked = [("u", 1, "x", "call", None), ("u", 2, "x", "call", "set"), ("u", 3, "x", "plain", None), ("u", 4, "s", "call", "set"), ("u", 5, "s", "call", "get"), ("v", 6, "x", "call", None), ("v", 7, "x", "call", "get"), ("w", 8, "x", "assign", None)]
    places = spark.createDataFrame([(u, p, "m", n, f, m) for u, p, n, f, m in asked], "unit string, place int, site string, name string, form string, member string")
    found = {r.place: (r.relation, r.target) for r in symbols.resolved(places, table).collect()}
    assert found == {1: ("calls", "method:x"), 2: ("uses", "dep:x"), 3: ("reads", "field:x"), 4: ("writes", "field:s"), 5: ("reads", "field:s"), 6: (None, None), 7: ("reads", "field:x"), 8: (None, None)}


# ---- levels and orders ---------------------------------------------------------------------------------------


def levels_by_hand(nodes, links):
    needs = {n: {t for f, t in links if f == n and t != n and t in nodes} for n in nodes}
    out = {}
    while ready := [n for n in nodes if n not in out and all(t in out for t in needs[n])]:
        for n in ready:
            out[n] = 1 + max((out[t] for t in needs[n]), default=-1)
    return {n: out.get(n) for n in nodes}


def test_levels_are_those_of_taking_leaves_off(spark):
    rng = random.Random(6)
    for size, per_node, cyclic in ((30, 1, False), (40, 2, False), (25, 1, True), (60, 1.2, True), (1, 0, False)):
        links = [(a, b) for a, b in ((rng.randrange(size), rng.randrange(size + 2)) for _ in range(int(size * per_node))) if cyclic or a > b or b >= size]
        nodes = spark.createDataFrame([(n,) for n in range(size)] * 2, "node int")
        found = {r.node: r.level for r in graph.topo_levels(nodes, spark.createDataFrame(links, "from int, to int")).collect()}
        assert found == levels_by_hand(range(size), links)


def test_a_chain_takes_few_rounds(spark, monkeypatch):
    tables = []
    monkeypatch.setattr(graph, "written", lambda df, own=graph.written: tables.append(1) or own(df))
    n = 100_000
    links = spark.range(1, n).selectExpr("id AS from", "id - 1 AS to")
    row = graph.topo_levels(spark.range(n).selectExpr("id AS node"), links).agg(F.count(F.when(F.col("level") == F.col("node"), 1)).alias("right")).first()
    assert row.right == n and len(tables) < 40


def test_post_order_and_the_edges_it_cuts(spark):
    rng = random.Random(9)
    rows, links = [], []
    for u in range(40):
        size = rng.randrange(1, 8)
        rows += [(f"u{u}", f"n{k}", k) for k in range(size)]
        links += [(f"u{u}", f"n{rng.randrange(size)}", f"n{rng.randrange(size + 1)}", k) for k in range(rng.randrange(12))]
    found = {}
    for r in graph.leaf_first_order(spark.createDataFrame(rows, "unit string, node string, ord int"), spark.createDataFrame(links, "unit string, from string, to string, ord int")).collect():
        found.setdefault(r.unit, {})[r.node] = (r.position, r.cuts)
    for u in {r[0] for r in rows}:
        own = [n for v, n, _ in rows if v == u]
        calls = {n: [] for n in own}
        for v, a, b, _ in links:
            if v == u and b in calls and b not in calls[a]:
                calls[a].append(b)
        order, opened, cuts = [], [], {n: [] for n in own}

        def visit(n):
            opened.append(n)
            for c in calls[n]:
                if c in opened:
                    cuts[n].append(c)
                elif c not in order:
                    visit(c)
            opened.pop()
            order.append(n)

        for n in own:
            if n not in order:
                visit(n)
        assert found[u] == {n: (k, cuts[n]) for k, n in enumerate(order)}


# ---- rules and enrichment ------------------------------------------------------------------------------------


def test_rules_are_data(spark):
    made = rules.rule_table(spark, ((0, "both", (("a", 2, None), ("b", None, 5))), (1, "exact", (("a", 1, 1),))))
    measures = spark.createDataFrame([("u", "a", 1), ("u", "a", 1), ("u", "other", 9), ("v", "a", 1), ("w", "a", 9), ("w", "b", 6), ("x", "a", None)], "unit string, measure string, value bigint")
    found = {r.unit: (r.result, r.rank) for r in rules.classified(spark.createDataFrame([(u,) for u in "uvwxyu"], "unit string"), measures, made).collect()}
    assert found == {"u": ("both", 0), "v": ("exact", 1), "w": (None, None), "x": (None, None), "y": (None, None)}
    always = {r.unit: r.result for r in rules.classified(measures.select("unit"), measures, rules.rule_table(spark, rules.TIERS)).collect()}
    assert always == {"u": "trivial", "v": "trivial", "w": "trivial", "x": "trivial"}


def test_versions_are_published_whole(spark, tmp_path):
    folder = str(tmp_path / "records")
    with pytest.raises(FileNotFoundError):
        enrichment.snapshot(spark, folder)
    records = spark.createDataFrame([("a", [("d", "B", None)], [], None, None), ("b", [], ["x"], ["y"], []), ("c", None, None, None, None)], enrichment.RECORDS)
    enrichment.publish(records, folder)
    index = spark.createDataFrame([("b", "service", "B"), ("c", "service", "B"), ("a", "component", None)], "unit string, kind string, class_name string")
    edges = spark.createDataFrame([("a", "b"), ("a", "b"), ("c", "b")], "from string, to string")
    requests = spark.createDataFrame([("b", 1, "GET", "/"), ("c", 1, "PUT", "/c")], "service string, ord int, method string, url string")
    first = enrichment.enrich_table(spark, folder, index, edges, requests)
    assert first == {"signature_updates": 1, "dependency_updates": 2, "requests_added": 1, "edges_added": 2}
    # a run that is lost before it publishes leaves data that nothing names
    records.write.parquet(f"{folder}/data-lost")
    (tmp_path / "records/published/000000002").mkdir()
    assert enrichment.published(spark, folder)[0] == 1
    assert set(enrichment.enrich_table(spark, folder, index, edges, requests).values()) == {0}
    enrichment.publish(enrichment.snapshot(spark, folder), folder)
    assert enrichment.published(spark, folder)[0] == 3
    found = {r.unit: r for r in enrichment.snapshot(spark, folder).collect()}
    assert found["a"].dependencies[0].resolved == "b" and found["a"].outbound == ["b"] and not found["a"].inbound
    assert [(q.id, q.via, q.service, q.direct) for q in found["a"].requests] == [("http:1", "d", "b", False)]
    assert (found["b"].outbound, found["b"].inbound) == (["x"], ["y"]) and found["c"].outbound == ["b"]
