"""Sharding, mixing, token counts and packing against brute force, and their odd cases."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from oracle import assert_same
from pyspark.sql import functions as F
from test_dedup_and_join import odd

from lodestone.llm import mixing, packing, sharding, token_counts


def test_shards_are_even_and_hold_the_mixture(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = sharding.interleaved_shards(docs, 7).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    by_shard, by_stratum = defaultdict(list), defaultdict(Counter)
    for r in found:
        by_shard[r.shard].append(r.slot)
        by_stratum[r.stratum][r.shard] += 1
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 16, zlib.crc32(data))
    assert sorted(r.doc_id for r in found) == sorted(texts)
    sizes = [len(s) for s in by_shard.values()]
    assert len(sizes) == 7 and max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    for counts in by_stratum.values():
        assert all(abs(counts[s] - sum(counts.values()) / 7) < 2.1 for s in range(7))


def test_shards_are_those_of_sorting_everything(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    docs = docs.unionByName(spark.createDataFrame([(None, None, None), (3, "src0", "again"), (3, "src0", "again"), (7_000, "alone", "")], docs.schema))
    strata = defaultdict(list)
    for r in docs.collect():
        data = (r.text or "").encode()
        u = hashlib.md5(f"{sharding.SEED}:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()
        strata["-" if r.source is None else "=" + r.source].append((u, r.doc_id is not None, r.doc_id or 0, zlib.crc32(data), len(data) + 16))
    rows = []
    for name, members in strata.items():
        phase = int(hashlib.md5(f"{sharding.SEED + 1}:{name}".encode()).hexdigest()[:8], 16) / 2**32
        rows += [((k + phase) / len(members), name, *m) for k, m in enumerate(sorted(members))]
    rows.sort()
    shards, total = 9, len(rows)
    expected = []
    for position, (_, name, _, _, doc_id, crc, size) in enumerate(rows):
        shard = position * shards // total
        expected.append((doc_id, name, size, crc, shard, position - -(-shard * total // shards)))
    found = [(r.doc_id or 0, r.stratum, r.size, r.text_crc32, r.shard, r.slot) for r in sharding.interleaved_shards(docs, shards).collect()]
    assert sorted(found) == sorted(expected)


def test_shards_do_not_depend_on_the_partitions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    place = lambda d: {r.doc_id: (r.shard, r.slot) for r in sharding.interleaved_shards(d).collect()}
    assert place(docs) == place(docs.repartition(5))


def test_shards_of_odd_rows(spark):
    found = sharding.interleaved_shards(odd(spark), 4).collect()
    assert sorted(Counter(r.shard for r in found).values()) == [2, 2, 2, 3]
    assert sharding.interleaved_shards(odd(spark).limit(0)).count() == 0


HELPERS = ("_id", "_last", "_epoch", "_keep", "_first", "shard", "slot", "row", "number", "key", "Slot_")


def clashing(spark):
    """Null ids, repeated ids and repeated rows, beside columns with the names of helpers."""
    rows = [(i % 4 if i % 5 else None, f"text of row {i % 7}", "en", f"s{i % 3}", i) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n int")
    return docs.withColumns({name: F.col("n") for name in HELPERS})


def test_writing_shards_keeps_every_row_and_column(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sharding, "FILE_ROWS", 3)
    docs = clashing(spark)
    sharding.shard_documents(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert set(back.columns) == {*docs.columns, "shard_", "slot__"}
    assert sorted(r.n for r in back.collect()) == list(range(30)) and all(r.shard == r.n for r in back.collect())
    by_shard = defaultdict(list)
    for r in back.collect():
        by_shard[r["shard_"]].append(r["slot__"])
    assert sorted(map(len, by_shard.values())) == [7, 7, 8, 8] and all(sorted(s) == list(range(len(s))) for s in by_shard.values())


def test_mixed_documents_take_each_row_as_often_as_the_mixture(spark):
    docs = clashing(spark)
    for percent, epochs in ((200, 2), (150, 2), (70, 1)):
        mixed = mixing.mixed_documents(docs, percent, epochs)
        assert mixed.columns == docs.columns
        wanted = mixing.mixture(docs, percent, epochs, number_col="n").groupBy("number").count()
        budget = sum(r.tokens for r in mixing.mixture(docs, percent, epochs).collect())
        assert sum(len(r.text.split()) for r in mixed.collect()) == budget <= 120 * percent // 100
        assert sum(r["count"] for r in wanted.collect()) == mixed.count()
    assert Counter(r.n for r in mixing.mixed_documents(docs, 200, 2).collect()) == dict.fromkeys(range(30), 2)


def poured(budget, children):
    """Shares a budget in rounds: what one child can't take is offered to the others again."""
    got, open_ = dict.fromkeys(children, 0), dict(children)
    while open_ and budget > 0:
        weights = sum(w for w, _ in open_.values())
        full = [c for c, (w, capacity) in open_.items() if capacity * weights <= budget * w]
        for c in full:
            got[c] = open_.pop(c)[1]
        budget -= sum(got[c] for c in full)
        if not full:
            return got | {c: min(capacity, budget * w // weights) for c, (w, capacity) in open_.items()}
    return got


def test_water_filling_agrees_with_pouring_in_rounds(spark):
    rnd = random.Random(4)
    cases = {f"p{p:02}": (rnd.randint(0, 400), {f"c{c}": (rnd.randint(1, 5), rnd.choice([0, rnd.randint(1, 120)])) for c in range(rnd.randint(1, 6))}) for p in range(40)}
    rows = [(p, c, w, capacity, min(budget, sum(x for _, x in children.values()))) for p, (budget, children) in cases.items() for c, (w, capacity) in children.items()]
    nodes = spark.createDataFrame(rows, "parent string, child string, weight bigint, capacity bigint, above bigint")
    found = defaultdict(dict)
    for r in mixing.water_fill(nodes, ["parent"], "above", "child", "budget").collect():
        found[r.parent][r.child] = r.budget
    assert found == {p: poured(min(budget, sum(x for _, x in children.values())), children) for p, (budget, children) in cases.items()}


def test_mixture_agrees_with_sql(spark, sf_dir, duck):
    assert assert_same(mixing.query(spark, sf_dir), duck, mixing.ORACLE)


def test_shortages_go_to_siblings_first(spark):
    leaves = spark.createDataFrame([("a", "x", "s", 10, 1), ("a", "y", "s", 100, 1), ("b", "x", "s", 1000, 1)], "domain string, lang string, source string, tokens bigint, docs bigint")
    found = {(r.domain, r.lang): r.budget for r in mixing.leaf_budgets(leaves, 120, {}, 1).collect()}
    assert found == {("a", "x"): 10, ("a", "y"): 50, ("b", "x"): 60}
    found = {(r.domain, r.lang): r.budget for r in mixing.leaf_budgets(leaves, 400, {}, 1).collect()}
    assert found == {("a", "x"): 10, ("a", "y"): 100, ("b", "x"): 290}


def test_mixture_of_odd_rows(spark):
    found = mixing.mixture(odd(spark), 100, 1).collect()
    assert Counter(r.doc_id for r in found) == Counter(r.doc_id for r in odd(spark).collect())
    assert mixing.mixture(odd(spark).limit(0)).count() == 0
    mixed = mixing.mixed_documents(odd(spark), 200, 2)
    assert mixed.columns == odd(spark).columns
    assert Counter(r.doc_id for r in mixed.collect())[1] == 2


def test_token_counts_agree_with_a_unigram_tokenizer(spark, sf_dir):
    from tokenizers import Tokenizer, models

    vocabulary = token_counts.read_vocabulary(token_counts.vocabulary_path())
    other = Tokenizer(models.Unigram([("<unk>", 0.0), *[(f"<0x{i:02X}>", 0.0) for i in range(256)], *vocabulary], 0, True))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    odd_rows = [(-1, "  two  spaces "), (-2, "你好\n\nwörld\t🙂"), (-3, ""), (-4, None), (None, "no id"), (-5, "twice"), (-5, "twice"), (-6, "long word " * 9000)]
    docs = docs.unionByName(spark.createDataFrame(odd_rows, "doc_id bigint, text string")).withColumns({"n_tokens": F.lit("clash"), "score": F.lit(0)})
    count = lambda text: len(other.encode("▁" + text.replace(" ", "▁"), add_special_tokens=False).ids) if text else 0
    found = Counter((r.doc_id, r.n_tokens) for r in token_counts.token_counts(docs).collect())
    assert found == Counter((r.doc_id, count(r.text)) for r in docs.collect())
    assert token_counts.token_counts(docs.limit(0)).count() == 0


def test_ties_go_to_the_piece_that_starts_first():
    from tokenizers import Tokenizer, models

    rnd = random.Random(5)
    for _ in range(150):
        pieces = {"".join(rnd.choice("abc▁") for _ in range(rnd.randint(1, 4))): -float(rnd.randint(0, 3)) for _ in range(rnd.randint(2, 12))}
        other = Tokenizer(models.Unigram([("<unk>", 0.0), *[(f"<0x{i:02X}>", 0.0) for i in range(256)], *pieces.items()], 0, True))
        counter = token_counts.UnigramCounter(list(pieces.items()))
        counter.unknown = min(0.0, *pieces.values()) - token_counts.UNKNOWN_PENALTY
        for _ in range(8):
            text = "".join(rnd.choice("abcd  é") for _ in range(rnd.randint(1, 20)))
            assert next(counter.all([text]))[0] == len(other.encode("▁" + text.replace(" ", "▁"), add_special_tokens=False).ids)


def _check_packing(docs, found, capacity):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    ids = {r.doc_id: np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, packing.END_ID], dtype="<u4") for r in docs.collect()}
    covered, sequences = Counter(), defaultdict(list)
    for r in found:
        assert r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        covered[r.doc_id] += r.length
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(sequences) == list(range(len(sequences)))
    return ids, covered, sequences


def test_packing_is_a_round_trip_with_little_padding(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ids, covered, sequences = _check_packing(docs, packing.pack(docs).collect(), packing.CAPACITY)
    assert covered == {i: len(x) for i, x in ids.items()}
    assert len(sequences) <= -(-sum(covered.values()) // packing.CAPACITY) + 1
    padded = {r.sequence_id: list(r.ids) for r in packing.packed_sequences(docs.limit(40)).collect()}
    assert all(len(x) == packing.CAPACITY or len(x) & (len(x) - 1) == 0 for x in padded.values())


def test_fill_finds_the_best_multiset():
    rnd = random.Random(3)
    for _ in range(200):
        counts = {rnd.randint(1, 30): rnd.randint(1, 3) for _ in range(rnd.randint(1, 5))}
        room, reachable = rnd.randint(0, 40), {0}
        for length, n in counts.items():
            reachable = {s + k * length for s in reachable for k in range(n + 1)}
        chosen = packing.fill(counts, room)
        assert sum(k * n for k, n in chosen.items()) == max(s for s in reachable if s <= room)
        assert all(n <= counts[k] for k, n in chosen.items())


def test_word_ids_are_the_tokenizer_s():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    ids, rnd = packing.WordIds(packing.tokenizer_path()), random.Random(11)
    longer = [chr(c) for c in range(0x250) if len(chr(c).lower()) > 1] + ["\u01c5", "\ufb01", "\u1e9e", "\u00df"]
    parts = [*"aBzÄéñß12", *longer, *".,;:!?'-_()", " ", "\n", "\t", "\x00", "\x1c", "\x85", "\xa0", "\u2028", "\u0301", "你", "🙂", "</w>", "<unk>", "[CLS]", "don't", "Word"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12))) for _ in range(6000)] + ["İ!", "İ", "aİ?."]
    for at in range(0, len(texts), 500):
        some = texts[at : at + 500]
        for text, found in zip(some, ids(some), strict=True):
            assert np.frombuffer(found, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_special_tokens_are_found_before_letters_are_made_small():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    texts = ["<|ENDOFTEXT|>", "A<|endoftext|>.", "<|EndOfText|>, B", "Ä <|startoftext|>!"]
    for text, found in zip(texts, packing.WordIds(packing.tokenizer_path())(texts), strict=True):
        assert np.frombuffer(found, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_known_words_take_little_memory_and_are_encoded_once():
    import tracemalloc

    ids, letters = packing.WordIds(packing.tokenizer_path()), "abcdefghij"
    texts = [" ".join(f"{a}{b}{c}{d}{e}z" for c in letters for d in letters for e in letters) for a in letters for b in letters]
    tracemalloc.start()
    try:
        before = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes()
        first = list(map(zlib.crc32, ids(texts)))
        assert tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before < 75 * 100_000
    finally:
        tracemalloc.stop()
    ids.tokenizer = None
    assert list(map(zlib.crc32, ids(texts))) == first


def test_a_full_store_of_words_keeps_its_bound_and_the_ids(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "CACHED_BYTES", 2000)
    tokenizer, rnd = Tokenizer.from_file(packing.tokenizer_path()), random.Random(5)
    ids = packing.WordIds(packing.tokenizer_path())
    for size in [3, 20, 1, 40, 0, 5, 1500, 2]:
        texts = ["".join(rnd.choice("abcé,. ") for _ in range(rnd.randint(0, 30))) for _ in range(size)] + ["x" * size * 2]
        for text, found in zip(texts, ids(texts), strict=True):
            assert np.frombuffer(found, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text
        assert ids.words.nbytes + ids.ids.nbytes <= packing.CACHED_BYTES


def test_packing_of_odd_rows(spark):
    found = packing.pack(odd(spark).filter("doc_id IS NOT NULL").drop("n")).collect()
    assert sum(r.length for r in found if r.doc_id == 3) == 1
    assert len([r for r in found if r.doc_id == 6]) == 2
    assert packing.pack(odd(spark).limit(0)).count() == 0
    assert packing.pack(odd(spark)).filter("doc_id IS NULL").count() == 1
