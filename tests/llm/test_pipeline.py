"""The pipeline's stages against brute force, each on what the one before it keeps, and the run as a whole."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import pytest
from test_dedup_and_join import brute_components
from test_layout import _check_packing, poured

import corpus_pipeline
from lodestone.llm import mixing, packing, toxicity


@pytest.fixture(scope="module")
def tables(spark, sf_dir, tmp_path_factory):
    """The documents of the smallest tables with copies, near copies and odd rows among them."""
    folder = str(tmp_path_factory.mktemp("tables"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    some = docs.orderBy("doc_id").limit(40).collect()
    more = [(90_000 + i, re.sub(" ", "  ", r.text or "", count=3), r.lang, r.source, r.n_chars) for i, r in enumerate(some)]
    more += [(91_000 + i, (r.text or "") + " and some more", r.lang, r.source, r.n_chars) for i, r in enumerate(some)]
    more += [(92_000, None, None, None, None), (92_001, "", "en", None, 0), (None, "a text without an id", "en", "s", 20)]
    more += [(93_000 + i, f"we will kill you number {i}. we will hurt you. they said nothing", "en", "s1", 60) for i in range(3)]
    docs.unionByName(spark.createDataFrame(more, docs.schema)).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{sf_dir}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    return folder


def brute_mixture(rows: list, percent: int, weights: dict) -> list:
    """The ids that one epoch takes: budgets poured down the tree, then each leaf's prefix in its seeded order."""
    leaves = defaultdict(list)
    for r in rows:
        number = re.search("([0-9]{1,9})$", r.source or "")
        domain = ("=web", "=books", "=code")[int(number[1]) % 3 if number else 0]
        leaves[domain, "=" + r.lang if r.lang is not None else "-", "=" + r.source if r.source is not None else "-"].append((len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")), r.doc_id))
    size = {leaf: sum(n for n, _ in docs) for leaf, docs in leaves.items()}
    budgets = {(): sum(size.values()) * percent // 100}
    for depth, level in enumerate(mixing.LEVELS):
        below = defaultdict(dict)
        for leaf, n in size.items():
            weight = weights[level].get(leaf[depth], 1)
            below[leaf[:depth]][leaf[: depth + 1]] = (weight, below[leaf[:depth]].get(leaf[: depth + 1], (0, 0))[1] + n)
        budgets = {child: n for path, children in below.items() for child, n in poured(budgets[path], children).items()}
    taken = []
    for leaf, docs in leaves.items():
        whole, rest = divmod(budgets[leaf], size[leaf]) if size[leaf] else (0, 0)
        if whole:
            taken += [i for _, i in docs]
            continue
        so_far = 0
        for n, i in sorted(docs, key=lambda d: (hashlib.md5(f"{mixing.SEED}:0:{'' if d[1] is None else d[1]}".encode()).hexdigest(), d[1] is not None, d[1] or 0)):
            so_far += n
            if so_far <= rest:
                taken.append(i)
    return taken


def ids(rows) -> list:
    return sorted((r if isinstance(r, int) or r is None else r.doc_id for r in rows), key=lambda i: (i is not None, i or 0))


def test_each_stage_agrees_with_brute_force_and_the_run_with_the_stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact_dedup", "jaccard_join", "mixture", "packing"]
    model = toxicity.train_grammar(docs, spark.read.parquet(f"{tables}/labels.parquet"))
    kept = {}
    for name, stage in list(stages.items())[:-1]:
        after = stage(spark, docs, tables)
        assert after.columns == docs.columns
        after.write.parquet(f"{tables}/after-{name}")
        before, docs = docs.collect(), spark.read.parquet(f"{tables}/after-{name}")
        kept[name] = (before, docs.collect())

    before, after = kept["toxicity"]
    rejected = {r.doc_id for r in before if model.scores([r.text])[0] >= toxicity.THRESHOLD}
    assert rejected and ids(after) == ids(r for r in before if r.doc_id not in rejected)

    before, after = kept["exact_dedup"]
    groups = defaultdict(list)
    for r in before:
        groups[re.sub(r"[\x20\x09-\x0D]", "", r.text or "")].append((-len(r.text or ""), r.doc_id is None, r.doc_id))
    assert len(groups) < len(before) and ids(after) == ids(min(g)[2] for g in groups.values())

    before, after = kept["jaccard_join"]
    _, roots = brute_components({r.doc_id: r.text for r in before if r.doc_id is not None}, 5, 80)
    assert len(set(roots.values())) < len(roots) and ids(after) == ids({*roots.values(), *(None for r in before if r.doc_id is None)})

    before, after = kept["mixture"]
    assert ids(after) == ids(brute_mixture(before, corpus_pipeline.MIX_PERCENT, corpus_pipeline.MIX_WEIGHTS))

    packed = stages["packing"](spark, docs, tables).collect()
    sizes, covered, _ = _check_packing(docs, packed, packing.CAPACITY)
    assert covered == {i: len(x) for i, x in sizes.items()}

    found = corpus_pipeline.run(spark, tables)
    assert sorted(map(repr, found.collect())) == sorted(repr(r) for r in stages["packing"](spark, docs, tables).select(*found.columns).collect())


def test_the_pipeline_of_an_empty_table(spark, sf_dir, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
