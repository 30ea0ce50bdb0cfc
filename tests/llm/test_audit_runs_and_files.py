"""Filter audit, periodic runs and token files against SQL, brute force and round trips, and their odd cases."""

from __future__ import annotations

import hashlib
import itertools
import os
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from oracle import assert_same
from pyspark.sql import functions as F
from test_dedup_and_join import odd

from lodestone.llm import filter_audit, periodic_runs, token_files

# ---- filter audit --------------------------------------------------------------------------------------------


def test_audit_is_that_of_sql(spark, sf_dir, duck):
    assert assert_same(filter_audit.query(spark, sf_dir), duck, filter_audit.ORACLES["op11_filter_audit"]) % 600 == 0


def audit_by_hand(docs, labels):
    """Every row is put through every order, one filter after the other."""
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))

    def fails(i, text):
        text = text or ""
        words = [w for w in text.replace("\t", " ").replace("\n", " ").split(" ") if w]
        few, repeated = len(words) < 200, 100 * len(set(words)) < 50 * len(words)
        capitals = 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text)
        found = {"A": few, "B": repeated, "C": capitals, "D": any(c in text for c in "#$%&*|"), "E": i is not None and least[text] < i}
        return {k for k, v in found.items() if v}

    good, toxic = ({i for i, *marks in labels if marks[k] == 1} for k in (0, 1))
    out = {}
    for part in {p or "" for _, _, p in docs}:
        rows = [(fails(i, t), i) for i, t, p in docs if (p or "") == part]
        shapley = Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = rows
            for step, x in enumerate(order, 1):
                removed = [r for r in left if x in r[0]]
                left = [r for r in left if x not in r[0]]
                failing = sum(x in f for f, _ in rows)
                lost = [sum(i in marked for _, i in removed) for marked in (good, toxic)]
                out[part, order, step] = [len(left), len(removed), failing - len(removed), sum(f == {x} for f, _ in rows), *lost]
                shapley[x] += len(removed)
        for (p, order, step), values in out.items():
            if p == part:
                values.append(shapley[order[step - 1]])
    return out


def audited(spark, docs, labels, ranges=None):
    made = spark.createDataFrame([(*d, "own", 1) for d in docs], "doc_id bigint, text string, lang string, part string, mask int")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    return {(r.part, r.filter_order, r.step): list(r)[3:] for r in filter_audit.filter_audit(made, marks, ranges).collect()}


def test_audit_of_odd_rows(spark):
    long = "the same beginning " * 3000
    texts = [None, "", "a", "A", "ABC def", "# x", long, long + "b", long + "c", long[:-1], "é" * 300, "中　文 " * 250, " ".join(map(str, range(300))), "\t\n "]
    rng = random.Random(7)
    docs = [(rng.choice([None, *range(40)]), rng.choice(texts), rng.choice(["en", "de", None, ""])) for _ in range(150)]
    docs += docs[:20]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(30)] + [(3, 1, 1), (3, 0, 0), (None, 1, 1)]
    expected = audit_by_hand(docs, labels)
    assert audited(spark, docs, labels) == expected
    assert audited(spark, docs, labels, 9) == expected
    assert audited(spark, docs, [], 3) == audit_by_hand(docs, [])
    assert audited(spark, [], labels) == {}


def test_a_full_trie_is_sent_on(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "LOCAL_BYTES", 10)
    docs = spark.createDataFrame([(i, f"text {i % 7}", "en") for i in reversed(range(60))], "doc_id bigint, text string, lang string").coalesce(1)
    found = Counter()
    for r in filter_audit.masks(docs, 4).collect():
        found[bool(r["mask"] & filter_audit.COPY)] += r["n"]
    assert found == {False: 7, True: 53}


def test_trie_holds_what_was_put_in():
    rng = random.Random(2)
    trie, least = filter_audit.Trie(), {}
    for _ in range(4000):
        text = bytes(rng.choice(b"ab") for _ in range(rng.randrange(9)))
        i = rng.randrange(1000)
        for copy in trie.insert(text, i, "", 0, 1):
            assert copy[2] == filter_audit.COPY
        least[text] = min(i, least.get(text, i))
    assert {t: h.least for t, h in trie.terminals()} == least


def test_ranges_are_even_although_texts_begin_alike(spark):
    rng = random.Random(4)
    same = "x" * 5000
    texts = [same + "%08d" % rng.randrange(10**8) for _ in range(2000)] + ["%08d" % rng.randrange(10**8) for _ in range(2000)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").select(F.col("text").cast("binary").alias("text"))
    prefixes = filter_audit.adaptive_prefixes(docs, 10)
    assert prefixes == sorted(set(prefixes))
    sizes = Counter(filter_audit.bisect_right(prefixes, t.encode()) for t in texts if t.startswith("x"))
    assert len(sizes) >= 8 and max(sizes.values()) < 500


# ---- periodic runs -------------------------------------------------------------------------------------------


def runs_by_hand(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((i, e - i, q) for (i, e), q in found.items())


def some_words(rng):
    n, kinds = rng.choice([0, 1, 5, 6, 7, 12, 30, 60, 150]), rng.choice([1, 2, 3, 5, 30])
    words = [b"%d" % rng.randrange(kinds) for _ in range(n)]
    for _ in range(rng.randrange(4)):
        if n > 8:
            a = rng.randrange(n)
            p, length = 1 + rng.randrange(max(1, (n - a) // 3)), rng.randrange(n - a) + 1
            words[a : a + length] = (words[a : a + p] * length)[:length]
    return words


@pytest.mark.parametrize("matrix", [4, 64, 1 << 18])
def test_runs_are_those_of_comparing_every_distance(matrix, monkeypatch):
    monkeypatch.setattr(periodic_runs, "MATRIX", matrix)
    rng = random.Random(5)
    texts = [some_words(rng) for _ in range(800)]
    expected = [runs_by_hand(w) for w in texts]
    assert periodic_runs.runs_of_texts(texts) == expected
    assert [periodic_runs.runs_of_texts([w])[0] for w in texts[:200]] == expected[:200]
    assert len({q for runs in expected for _, _, q in runs}) > 10


def test_sums_of_squared_differences_are_exact():
    rng = np.random.default_rng(1)
    for b in (1, 2, 8, 64):
        ids = rng.integers(0, 1 << 20, (5, 3 * b)).astype(np.uint64)
        ids[0, 2 * b :] = ids[0, :b]
        exact = [[sum((int(r[i]) - int(r[b + s + i])) ** 2 for i in range(b)) for s in range(b)] for r in ids]
        for transform in periodic_runs._TRANSFORMS:
            assert (transform.squared_differences(ids[:, :b], ids[:, b:]) == np.array(exact, dtype=object) % int(transform.prime)).all()
        zero = periodic_runs.zero_mismatches(ids.ravel(), np.arange(5) * 3 * b, b)
        assert zero.tolist() == [[x == 0 for x in row] for row in exact]


def digests(doc_id, text):
    words = periodic_runs.planted_repeats(doc_id, (text or "").encode().split())
    runs = runs_by_hand(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]
    sha = lambda data: hashlib.sha256(data).hexdigest()
    four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *four, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()), sha(b" ".join(kept)))


def test_query_of_runs_on_whole_texts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = periodic_runs.query(spark, sf_dir)
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    # comparing every distance is too slow for the longest texts
    short = {d.doc_id: d.text for d in docs if len(d.text or "") < 9000}
    rows = {r.doc_id: tuple(r) for r in found.collect()}
    assert len(rows) == len(docs) and sum(r[1] > 0 for r in rows.values()) > 5
    assert [rows[i] for i in short] == [digests(i, t) for i, t in short.items()]


def test_runs_of_odd_rows(spark):
    rows = [(None, None), (None, "a " * 9), (1, ""), (1, ""), (2, "x y " * 4), (3, "same　same " * 6), (4, " \t\n"), (5, "w " * 200_000), (6, "a a a a a b b b b b b")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, runs int")
    found = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs.periodic_runs(docs).collect()]
    assert sorted(found, key=str) == sorted(
        [
            (None, 0, [], ""),
            (None, 9, [(0, 9, 1)], "a"),
            (1, 0, [], ""),
            (1, 0, [], ""),
            (2, 8, [(0, 8, 2)], "x y"),
            (3, 6, [(0, 6, 1)], "same　same"),
            (4, 0, [], ""),
            (5, 200_000, [(0, 200_000, 1)], "w"),
            (6, 11, [(5, 6, 1)], "a a a a a b"),
        ],
        key=str,
    )
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0
    tie = docs.limit(1).select(periodic_runs.strongest(F.expr(f"cast(array((9L, 8L, 2L), (1L, 4L, 1L), (2L, 12L, 3L)) as {periodic_runs.RUNS})")).alias("r")).first().r
    assert tuple(tie) == (9, 8, 2)


# ---- token files ---------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(token_files.tokenizer_path())


def whole(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [token_files.END_ID]


def test_ids_are_those_of_whole_texts(tokenizer):
    signs = [" ", " ", "  ", "\n", "\n\n", "\t", "\xa0", "　", "a", "b", "é", "İ", "ß", "中", "1", "23", ".", ",", "'s", "'ll", "!", "$$$", "<|endoftext|>", "☃", "😀", "\x1c", "\x85", "​", "Word", "\r", "_", "́", "ǅ", "ʰ"]
    rng = random.Random(3)
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(25))) for _ in range(4000)]
    ids_of = token_files.SpacedIds(token_files.tokenizer_path())
    for some in (texts, texts[:1], [*texts[:9], None, "", "a b"], texts):
        assert list(ids_of(some)) == [token_files.pack_ids(tokenizer.encode(t or "", add_special_tokens=False).ids) for t in some]


def test_words_beside_other_white_space_are_their_own(tokenizer):
    white = [" ", "\n", "\t", "\x0b", "\x1c", *map(chr, (0x85, 0xA0, 0x1680, 0x180E, 0x2000, 0x200A, 0x200B, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))]
    ids_of = token_files.SpacedIds(token_files.tokenizer_path())
    texts = [f"{a}{v}{w}{b}" for v in ("", *white) for w in white for a in ("x", "é", "…", "你", "<|endoftext|>", "") for b in ("x", ".", "")]
    texts += ["<|endoftext|>", "x<|endoftext|> y", "x|>", "x|", "x| <|endoftext|>|y"]
    for text, found in zip(texts, ids_of(texts), strict=True):
        assert found == token_files.pack_ids(tokenizer.encode(text, add_special_tokens=False).ids), repr(text)


def test_known_words_take_little_memory_and_are_encoded_once():
    import tracemalloc

    ids, letters = token_files.SpacedIds(token_files.tokenizer_path()), "abcdefghij"
    texts = ["\n\n  ".join(" ".join(f"{a}{b}{c}{d}{e}z." for c in letters for d in letters) for e in letters) for a in letters for b in letters]
    tracemalloc.start()
    try:
        before = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes()
        first = list(map(zlib.crc32, ids(texts)))
        assert tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before < 75 * 100_000
    finally:
        tracemalloc.stop()
    ids.tokenizer = None
    assert list(map(zlib.crc32, ids(texts))) == first


def cost(lengths, counts):
    return sum(n * w for n, w in zip(lengths, counts, strict=True))


def best_cost(counts, longest):
    """The least cost of any lengths that satisfy Kraft's inequality, by trying all."""
    used = [c for c in counts if c]
    return min(cost(x, used) for x in itertools.product(range(1, longest + 1), repeat=len(used)) if sum(2.0**-n for n in x) <= 1)


def test_codes_are_the_shortest_of_limited_length():
    rng = random.Random(8)
    for _ in range(60):
        counts = [rng.choice([0, 1, 2, 5, 30, 200]) for _ in range(rng.randrange(2, 7))]
        if not any(counts):
            continue
        lengths = token_files.code_lengths(np.array(counts), 3)
        assert cost(lengths, counts) == best_cost(counts, 3) and lengths.max() <= 3
    skewed = np.array([2**k for k in range(40)])
    lengths = token_files.code_lengths(skewed, 8)
    assert lengths.max() == 8 and sum(2.0**-n for n in lengths) == 1
    with pytest.raises(ValueError):
        token_files.code_lengths(np.ones(9, np.int64), 3)


@pytest.mark.parametrize("n", [1, 2, 255, 256, 257, 5000])
def test_bits_come_back_from_every_checkpoint(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.02, n), 900)
    code = token_files.Code(token_files.code_lengths(np.bincount(ids, minlength=1000)))
    bits, points = code.encode(ids)
    assert (code.decode(bits, points, n) == ids).all()
    for k in range(len(points)):
        assert (code.decode(bits, points[k:], n - k * token_files.CHECKPOINT) == ids[k * token_files.CHECKPOINT :]).all()


def expected_files(tokenizer, docs):
    rows, at = [], 0
    for i, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, zlib.crc32(token_files.pack_ids(whole(tokenizer, d[1]))))):
        ids = whole(tokenizer, text)
        rows.append((i, at, len(ids), zlib.crc32(token_files.pack_ids(ids))))
        at += len(ids)
    return rows


def test_query_of_files_on_whole_texts(spark, sf_dir, tokenizer):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in token_files.query(spark, sf_dir).collect()) == expected_files(tokenizer, docs)


def test_files_of_odd_rows(spark, tokenizer, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 700)
    docs = [(i, t) for i, t in odd(spark).select("doc_id", "text").collect()]
    docs += [(None, "b"), (None, "a c"), (5, "a long text, " * 3000), (5, "another"), (5, "another"), (-3, None), (2**40, "")]
    made = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id bigint, text string, ids int, number int")
    token_files.write_token_files(made, f"{tmp_path}/a")
    found = sorted((tuple(r) for r in token_files.read_documents(spark, f"{tmp_path}/a", with_ids=True).collect()), key=lambda r: r[1])
    expected = expected_files(tokenizer, docs)
    assert [r[:4] for r in found] == expected
    stream = [i for r in found for i in r[4]]
    assert all(zlib.crc32(token_files.pack_ids(r[4])) == r[3] for r in found)
    for first, last in ((0, 1), (300, 900), (0, len(stream)), (len(stream) - 1, len(stream)), (700, 701)):
        pieces = sorted((r.start, r.ids) for r in token_files.read_span(spark, f"{tmp_path}/a", first, last).collect())
        assert pieces[0][0] == first and [i for _, ids in pieces for i in ids] == stream[first:last]
    token_files.write_token_files(made.limit(0), f"{tmp_path}/b")
    assert token_files.read_documents(spark, f"{tmp_path}/b").count() == 0


def test_blocks_of_files_ascend_and_damage_is_found(spark, tmp_path):
    docs = spark.createDataFrame([((i * 37) % 500, "w " * (i % 50)) for i in range(500)], "doc_id bigint, text string")
    token_files.write_token_files(docs, f"{tmp_path}/a")
    blocks = spark.read.parquet(f"{tmp_path}/a/blocks")
    order = [i for r in sorted(blocks.collect(), key=lambda r: (r.part, r.block)) for i in r.doc_ids]
    assert order == list(range(500))
    blocks.withColumn("bits", F.overlay("bits", F.lit(b"\xff\x00\xff"), F.lit(1))).write.parquet(f"{tmp_path}/b/blocks")
    spark.read.parquet(f"{tmp_path}/a/code").write.parquet(f"{tmp_path}/b/code")
    with pytest.raises(Exception, match="damaged"):
        token_files.read_documents(spark, f"{tmp_path}/b").collect()
