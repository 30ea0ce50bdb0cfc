"""Known answers of operators on small inputs."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from lodestone.functions import text as T
from lodestone.functions.json_paths import flattened
from lodestone.operators import audit, diff, edges, graph, incremental, lookup, sections
from lodestone.operators.integrity import dangling_report
from lodestone.operators.mentions import mentions


def _edges(spark, *pairs):
    return spark.createDataFrame(list(pairs), "from string, to string")


def _nodes(spark, names):
    return spark.createDataFrame([(n,) for n in names], "node string")


def test_reach_in_a_cycle_takes_the_fewest_steps(spark):
    found = graph.reach(_edges(spark, ("a", "b"), ("b", "c"), ("c", "a"), ("a", "c"), ("x", "y")), _nodes(spark, "a"))
    assert {r.node: r.depth for r in found.collect()} == {"a": 0, "b": 1, "c": 1}


def test_levels_leave_the_cyclic_remainder(spark):
    links = _edges(spark, ("a", "b"), ("b", "c"), ("d", "e"), ("e", "d"), ("f", "d"), ("a", "outside"), ("c", "c"))
    found = {r.node: r.level for r in graph.topo_levels(_nodes(spark, "abcdef"), links).collect()}
    assert found == {"c": 0, "b": 1, "a": 2, "d": None, "e": None, "f": None}
    assert sorted(r.node for r in graph.cyclic_remainder(_nodes(spark, "abcdef"), links).collect()) == ["d", "e", "f"]


def test_leaf_first_order_cuts_cycles(spark):
    nodes = spark.createDataFrame([("u", n, i) for i, n in enumerate("abcd")], "unit string, node string, ord int")
    links = spark.createDataFrame([("u", "a", "c"), ("u", "a", "b"), ("u", "b", "a"), ("u", "c", "d")], "unit string, from string, to string")
    found = {r.node: r.position for r in graph.leaf_first_order(nodes, links).collect()}
    assert sorted(found, key=found.get) == ["b", "d", "c", "a"]


def test_unreachable_and_leaves(spark):
    links = _edges(spark, ("a", "b"))
    assert [r.node for r in graph.unreachable(_nodes(spark, "abc"), links, _nodes(spark, "a")).collect()] == ["c"]
    assert sorted(r.node for r in graph.leaves(_nodes(spark, "abc"), links).collect()) == ["b", "c"]


def test_dangling_counts_null_references(spark):
    refs = spark.createDataFrame([("r", 1), ("r", 1), ("r", 2), ("r", None)], "relation string, ref bigint")
    ids = spark.createDataFrame([("r", 1), ("s", 2)], "relation string, id bigint")
    assert sorted(map(tuple, dangling_report(["r", "none"], refs, ids).collect())) == [("none", 0, 0, 0, 0), ("r", 4, 2, 2, 1)]


def test_edge_dedupe_keeps_the_first(spark):
    rows = spark.createDataFrame([("a", "b", 3), ("a", "b", 1), ("b", "c", 2)], "from string, to string, at int")
    assert sorted(map(tuple, edges.edge_dedupe(rows, ["at"], ["at"]).collect())) == [("a", "b", 2, 1), ("b", "c", 1, 2)]


def test_golden_diff_is_null_safe(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (3, None), (4, "k")], "id int, v string")
    b = spark.createDataFrame([(1, "y"), (2, None), (3, "z"), (5, "k")], "id int, v string")
    assert {r.id: r.status for r in diff.golden_diff(a, b, ["id"], "v").collect()} == {1: "changed", 3: "changed", 4: "missing", 5: "unexpected"}


def test_first_candidate_goes_by_rank(spark):
    refs = spark.createDataFrame([(1, "m"), (2, "n"), (3, "o")], "id int, ref string")
    known = spark.createDataFrame([("m.ts",), ("m/index.ts",), ("n/index.ts",)], "name string")
    found = lookup.first_candidate(refs, [F.concat("ref", F.lit(".ts")), F.concat("ref", F.lit("/index.ts"))], known, "id", "file")
    assert {r.id: r.file for r in found.collect()} == {1: "m.ts", 2: "n/index.ts", 3: None}


def test_latest_state_merges_columns(spark):
    events = spark.createDataFrame([("u", 1, "pending", 5), ("u", 2, None, 7), ("u", 3, "done", None)], "unit string, at int, status string, n int")
    assert tuple(incremental.latest_state(events, "unit", ["at"], ["status", "n"]).first()) == ("u", "done", 7)


def test_sections_of_people_stay(spark):
    old = spark.createDataFrame([("a", "mine", "old"), ("b", "gen", "gen")], "name string, body string, made string").withColumn("hash", sections.body_hash(F.col("made")))
    new = spark.createDataFrame([("a", "new a"), ("b", "new b"), ("c", "new c")], "name string, body string")
    assert {r.name: (r.body, r.kept) for r in sections.merged_sections(new, old, ["name"]).collect()} == {"a": ("mine", True), "b": ("new b", False), "c": ("new c", False)}


def test_text_functions(spark):
    row = spark.createDataFrame([("Hello,  Wörld 7!", "a\nb\n", "x `code` <!-- c --> y", "^18.2.1")], "a string, b string, c string, d string").select(
        T.normalised(F.col("a")), T.line_count(F.col("b")), T.collapsed(T.prose(F.col("c"))), T.major_version(F.col("d")), T.line_count(F.lit("")), T.major_version(F.lit("latest"))
    ).first()
    assert tuple(row) == ("hello w rld 7", 2, "x y", 18, 0, None)


def test_mentioned_in_needs_long_words(spark):
    rows = spark.createDataFrame([("a b c", "x y"), ("alpha beta gamma", "gamma beta"), ("alpha beta gamma delta", "alpha gamma beta")], "needle string, hay string")
    assert [r[0] for r in rows.select(T.mentioned_in(F.col("needle"), F.col("hay"))).collect()] == [False, False, True]


def test_flattened_skips_comments_and_broken_texts(spark):
    rows = spark.createDataFrame([(1, '{"a": [1, {"b": null}], "$comment": 3, "c": "x"}'), (2, "{"), (3, None)], "id int, doc string")
    assert sorted(map(tuple, flattened(rows, "id", "doc").collect())) == [(1, "a[0]", "1"), (1, "a[1].b", None), (1, "c", "x")]


def test_a_check_of_nothing_does_not_pass(spark):
    assert audit.validation_totals(spark.createDataFrame([], "status string")).first().passed is False
    assert audit.validation_totals(spark.createDataFrame([("ok",), ("legacy",)], "status string")).first().passed is True


def test_levels_follow_the_longest_of_several_paths(spark):
    links = [("a", "b"), ("b", "c"), ("c", "d"), ("a", "d"), ("a", "e"), ("e", "d"), ("f", "a"), ("f", "d")]
    nodes = spark.createDataFrame([(n,) for n in "abcdefg"], "node string")
    found = {r.node: r.level for r in graph.topo_levels(nodes, spark.createDataFrame(links, "from string, to string")).collect()}
    assert found == {"d": 0, "g": 0, "c": 1, "e": 1, "b": 2, "a": 3, "f": 4}


def test_flattened_takes_nested_documents_apart(spark):
    doc = '{"a": {"b": [1, [true, null], {"c": "x"}], "$comment": 5, "$commentary": {"z": 1}}, "d": [], "e": {}, "f": 2.5}'
    rows = spark.createDataFrame([(1, doc), (2, "[3]"), (3, '"s"'), (4, None), (5, "{")], "id int, doc string")
    expected = [(1, "a.b[0]", "1"), (1, "a.b[1][0]", "true"), (1, "a.b[1][1]", None), (1, "a.b[2].c", "x"), (1, "f", "2.5"), (2, "[0]", "3"), (3, "", "s")]
    assert sorted(map(tuple, flattened(rows, "id", "doc").collect())) == expected


def test_mentions_are_those_of_comparing_every_pair(spark):
    rnd = random.Random(6)
    syllables = ["ka", "lo", "mi", "tre", "s", "unda"]
    word = lambda: "".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 4)))
    items = [(i, " ".join(word() for _ in range(rnd.randint(1, 5)))) for i in range(60)] + [(60, ""), (61, "ka s"), (62, "s")]
    texts = [(i, " ".join(word() for _ in range(rnd.randint(0, 12)))) for i in range(80)]

    def mentioned(needle, hay):
        words = [w for w in needle.split(" ") if len(w) > 3]
        return needle in hay or (words and 10 * sum(w in hay for w in words) >= 7 * len(words))

    found = mentions(spark.createDataFrame(items, "item_id int, needle string"), spark.createDataFrame(texts, "doc_id int, hay string"))
    assert sorted(map(tuple, found.collect())) == sorted((i, d) for i, n in items for d, h in texts if mentioned(n, h))
