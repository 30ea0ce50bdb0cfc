"""Exact and near duplicates against brute force, and their odd cases."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from oracle import assert_same
from pyspark.sql import functions as F

from lodestone.llm import exact_dedup, jaccard_join
from lodestone.llm.components import components

ODD = [
    (1, "a b c d e f", "en", "s"),
    (2, "a  b c d e f", "en", "s"),
    (3, None, "en", None),
    (4, "", None, "s"),
    (5, " \n", None, "s"),
    (6, "one two", "en", "s"),
    (6, "one two", "en", "s"),
    (None, "solo text of no id", "en", "s"),
    (8, "x" * 200_000, "en", "s"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string"


def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).withColumns({"kept": F.lit("clash"), "n": F.lit(0), "h": F.lit(1), "norm": F.lit(2), "component_id": F.lit(3)})


def brute_components(texts: dict[int, str | None], words: int, percent: int) -> tuple[dict, dict]:
    def shingles(text):
        split = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
        if not split:
            return frozenset()
        return frozenset([tuple(split)]) if len(split) < words else frozenset(tuple(split[i : i + words]) for i in range(len(split) - words + 1))

    sets = {i: shingles(t) for i, t in texts.items()}
    having = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            having[x].append(i)
    parent = {i: i for i in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in sets.items():
        for j, overlap in Counter(j for x in s for j in having[x] if j > i).items():
            if 100 * overlap >= percent * (len(s) + len(sets[j]) - overlap):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: len(s) for i, s in sets.items()}, {i: root(i) for i in texts}


def test_exact_groups_agree_with_sql(spark, sf_dir, duck):
    assert assert_same(exact_dedup.query(spark, sf_dir), duck, exact_dedup.ORACLE)


def test_exact_groups_of_odd_rows(spark):
    found = defaultdict(list)
    for r in exact_dedup.exact_groups(odd(spark)).collect():
        found[r.doc_id].append((r.keep_id, r.group_size, r.kept))
    assert found[1] == [(2, 2, False)] and found[2] == [(2, 2, True)]  # the longer original stays
    assert found[3] == [(5, 3, False)] and found[5] == [(5, 3, True)]
    assert found[6] == [(6, 2, True)] * 2
    assert found[None] == [(None, 1, True)]
    row = exact_dedup.exact_groups(odd(spark)).filter("doc_id = 4").first()
    assert row.text_sha256 == hashlib.sha256(b"").hexdigest()
    assert exact_dedup.exact_groups(odd(spark).limit(0)).count() == 0
    kept = exact_dedup.exact_dedup(odd(spark))
    assert kept.columns == odd(spark).columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 2), (False, 5), (False, 6), (False, 8), (True, 0)]


def test_exact_dedup_keeps_the_best_row_of_each_text(spark):
    rows = [(3, "long  text"), (5, "A"), (5, "longtext"), (3, "longtext"), (7, "A"), (None, "B"), (None, "B"), (9, None), (8, "")]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id bigint, text string, n int")
    docs = docs.withColumns({name: F.col("n") for name in ("_keep", "row", "key", "h", "points")})
    kept = exact_dedup.exact_dedup(docs)
    assert kept.columns == docs.columns
    found = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in kept.collect())
    assert found == [(False, 3, "long  text"), (False, 5, "A"), (False, 8, ""), (True, 0, "B")]
    assert exact_dedup.exact_dedup(docs.limit(0)).count() == 0


def test_colliding_hashes_do_not_join_texts(spark):
    docs = spark.createDataFrame([(i, f"t{i % 6}") for i in range(24)], "doc_id bigint, text string")
    found = exact_dedup.exact_groups(docs, hashed=lambda t: F.lit("same"))
    assert {(r.doc_id, r.keep_id, r.group_size) for r in found.collect()} == {(i, i % 6, 4) for i in range(24)}


@pytest.mark.parametrize("small", [False, True])
def test_near_duplicates_agree_with_brute_force(spark, sf_dir, monkeypatch, small):
    if small:  # so that frequent tokens, blocks and several ranges occur
        for name, value in (("LARGE", 2), ("FREQUENT", 2), ("BLOCK", 3), ("BLOCK_TOKENS", 2000), ("LEADERS", 1), ("GATHERED", 20_000), ("OFTEN", 2)):
            monkeypatch.setattr(jaccard_join, name, value)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    base = "the quick brown fox jumps over the lazy dog while seven old ravens watch from a dead oak near the river bank today".split()
    texts = [" ".join(base[:k] + [f"new{k}"] + base[k + 1 :]) for k in range(12)] + [" ".join(base), " ".join(base * 2), "Only three WORDS", "only three words", ""]
    docs = docs.unionByName(spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(texts)], "doc_id bigint, text string"))
    sizes, roots = brute_components({r.doc_id: r.text for r in docs.collect()}, 4, 85 if not small else 60)
    found = jaccard_join.near_duplicates(docs, percent=85 if not small else 60).collect()
    assert {r.doc_id: r.n_shingles for r in found} == sizes
    assert {r.doc_id: r.component_id for r in found} == roots


def test_a_token_of_all_sets_is_sent_once_for_each_batch(spark):
    line = "this very line stands in every single document of the table as a license would"
    docs = spark.createDataFrame([(i, " ".join([line, *(f"w{i}x{k}" for k in range(60))])) for i in range(300)], "doc_id bigint, text string").coalesce(1)
    rows = jaccard_join._spread(docs, 3, 4).collect()
    sent = [r for r in rows if r.ids is None]
    times = sorted(n for r in sent for n in np.frombuffer(r.times, "<u4").tolist())
    assert times == [300] * (len(line.split()) - 3)
    assert sum(len(r.tokens) for r in sent) // 4 == 300 * 60
    found = jaccard_join.documents_and_prefixes(docs).filter("kind = 2").count()
    assert found == 0  # tokens of one set alone fill every prefix


def test_a_set_is_gathered_once_however_many_copies_the_bitmap_hits(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BITS", 32)  # so that copies are hit by mistake
    shared = "one text that many documents share"
    rows = [(i, shared) for i in range(200)] + [(0, shared)] * 20 + [(0, "another text of the same id"), (500, "another text of the same component")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = jaccard_join.documents_and_prefixes(docs).filter("kind = 0").collect()
    nodes = {i: r.node for i, text in ((0, shared), (500, rows[-1][1])) for r in found if r.doc_id == (1 if text == shared else i)}
    places = spark.createDataFrame([(i, nodes[i], 7) for i in (0, 500)], "doc_id bigint, node bigint, place bigint")
    (block,) = jaccard_join._gathered(docs, places).collect()
    found, sets = jaccard_join._sets_of([r.asDict() for r in block.x], 4)
    assert len(block.x) == 3 and sorted(found) == sorted(nodes.values()) and all(len(s) == 3 for s in sets)


def test_shingle_sets_of_a_batch_are_those_of_each_text():
    texts = ["a b c d e", "", None, "A  b\tc d", "one", "a b c d a b c d", "\u0130 x y", " \n "]
    counts, tokens = jaccard_join.shingle_sets(texts)
    assert counts.tolist() == [2, 0, 0, 1, 1, 4, 1, 0]
    alone = [jaccard_join.shingle_sets([t])[1].tolist() for t in texts]
    assert [x.tolist() for x in jaccard_join._cut(counts, tokens)] == alone
    assert set(alone[3]) <= set(alone[0]) and set(alone[3]) <= set(alone[5])


def test_near_duplicates_of_odd_rows(spark):
    found = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(odd(spark)).collect()]
    assert sorted((x for x in found if x[0] is not None)) == [(1, 3, 1), (2, 3, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 1, 6), (6, 1, 6), (8, 1, 8)]
    assert [x for x in found if x[0] is None] == [(None, 2, None)]
    assert jaccard_join.near_duplicates(odd(spark).limit(0)).count() == 0
    kept = jaccard_join.without_near_duplicates(odd(spark))
    assert kept.columns == odd(spark).columns and 2 not in [r.doc_id for r in kept.collect()]


def test_one_row_of_each_component_stays_whatever_ids_repeat(spark):
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    rows = [(3, base), (5, base + " more"), (5, "quite another text that has the same id"), (3, base + " else"), (9, "alone"), (9, "alone"), (None, base), (None, "no id and no other")]
    docs = spark.createDataFrame([(*r, n) for n, r in enumerate(rows)], "doc_id bigint, text string, n int")
    docs = docs.withColumns({name: F.col("n") for name in ("_first", "row", "key", "mark")})
    kept = jaccard_join.without_near_duplicates(docs, 4, 80)
    assert kept.columns == docs.columns
    found = [(r.doc_id, r.text) for r in kept.collect()]
    assert (5, rows[2][1]) in found and (9, "alone") in found
    assert sum(i == 3 for i, _ in found) == 1 and (None, rows[-1][1]) in found and len(found) == 4


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (3, 2)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0
