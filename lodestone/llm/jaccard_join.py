"""Near duplicates: an exact Jaccard join of word shingles, filtered under several global token orders."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from lodestone.llm.common import durable, salted_lookup, table
from lodestone.llm.components import components
from lodestone.llm.packing import text_batches

#: Words in a shingle and hundredths of similarity from which two documents link.
WORDS, PERCENT = 4, 85
#: Token orders; the first makes the candidates, the others must agree.
ORDERS = 3
#: Orders after the first put tokens of so many documents (a power of two) last.
FREQUENT = 32
#: Sets of one batch from which a token is sent once, with their number, instead of once for each of them.
OFTEN = 16
#: Tokens that one task counts.
GATHERED = 2_000_000
#: Bytes of text that are taken for one token when ranges are laid out.
BYTES_PER_TOKEN = 6
#: Sets from which a token's pairs are not written out.
LARGE = 64
#: Sets and tokens that one task compares, and the leaders that every block of a large component is compared with.
BLOCK, BLOCK_TOKENS, LEADERS = 2048, 1_000_000, 32
#: Bits of the table of wanted documents: a fixed size; a wrong hit costs work, not results.
BITS = 1 << 24

_MIX = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]

_SPREAD = "range int, batch long, tokens binary, places binary, often binary, times binary, ids array<long>, marks array<long>, sizes array<long>, keys array<binary>, blocks int"
_COUNTED = _SPREAD + ", levels binary"
_FOUND = "kind int, doc_id long, mark long, n long, key binary, node long, token long, others array<array<long>>"


def _mixed(x: np.ndarray, seed: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31)) ^ _MIX[seed % 4]) * _MIX[(seed + 1) % 4]
    return (x ^ (x >> np.uint64(29))) * _MIX[seed % 4]


def _chained(hashes: list[np.ndarray], width: int) -> np.ndarray:
    out = np.full(len(hashes[0]), width, dtype=np.uint64)
    for k, h in enumerate(hashes):
        out = (out ^ (out >> np.uint64(29))) * _MIX[k % 4] + h
    return _mixed(out, 3)


def shingle_sets(texts: list[str | None], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The size of each text's set, and the sorted distinct 64-bit tokens of the sets, one set after the other.

    A set has a text's shingles; with fewer words, one for all of them; without words, none. Words are what
    ASCII white space parts, A-Z in small letters.
    """
    split = [(t or "").encode("utf-8", "surrogatepass").lower().split() for t in texts]
    lengths = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
    hashes = np.fromiter(map(xxh3_64_intdigest, chain.from_iterable(split)), dtype=np.uint64, count=int(lengths.sum()))
    ends = np.cumsum(lengths)
    counts = np.where(lengths >= words, lengths - words + 1, np.minimum(lengths, 1))
    stops = np.cumsum(counts)
    tokens = np.empty(int(counts.sum()), dtype=np.uint64)
    if len(hashes) >= words:
        whole = np.ones(len(hashes), dtype=bool)  # where a shingle of `words` words begins
        for k in range(1, words):
            at = ends - k
            whole[at[lengths >= k]] = False
        is_long = np.repeat(lengths >= words, counts)
        tokens[is_long] = _chained([hashes[k : len(hashes) - words + 1 + k] for k in range(words)], words)[whole[: len(hashes) - words + 1]]
    for i in np.flatnonzero((lengths > 0) & (lengths < words)):
        own = hashes[ends[i] - lengths[i] : ends[i]]
        tokens[stops[i] - 1] = _chained([own[k : k + 1] for k in range(len(own))], len(own))[0]
    for start, stop in zip((stops - counts).tolist(), stops.tolist(), strict=True):
        tokens[start:stop].sort()
    fresh = np.ones(len(tokens), dtype=bool)
    fresh[1:] = tokens[1:] != tokens[:-1]
    fresh[(stops - counts)[counts > 0]] = True
    if not fresh.all():
        of = np.repeat(np.arange(len(split)), counts)
        counts = np.bincount(of[fresh], minlength=len(split))
        tokens = tokens[fresh]
    return counts, tokens


def _key(tokens: np.ndarray) -> bytes:
    return blake2b(tokens.tobytes(), digest_size=16).digest()


def _node(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


def _cut(counts: np.ndarray, tokens: np.ndarray) -> list[np.ndarray]:
    return np.split(tokens, np.cumsum(counts)[:-1]) if len(counts) else []


def _distinct(keys: list[bytes | None]) -> list[int]:
    """Where each key stands first."""
    first: dict[bytes, int] = {}
    for i, key in enumerate(keys):
        if key is not None:
            first.setdefault(key, i)
    return list(first.values())


def _steps(places: np.ndarray) -> bytes:
    """Ascending numbers as differences: a byte each if that is enough, else four."""
    steps = np.diff(places, prepend=0)
    return steps.astype(np.uint8 if not len(steps) or steps.max() < 256 else "<u4").tobytes()


def _places(steps: bytes, count: int) -> np.ndarray:
    return np.cumsum(np.frombuffer(steps, dtype=np.uint8 if len(steps) == count else "<u4"), dtype=np.int64)


def _named(tokens: np.ndarray, part: np.ndarray) -> np.ndarray:
    """What a token is called from here on: its range and the low half of its hash."""
    return (tokens & np.uint64(0xFFFFFFFF)) | (part.astype(np.uint64) << np.uint64(32))


def _spread(docs: DataFrame, ranges: int, words: int) -> DataFrame:
    """The distinct sets of each batch of documents, cut by ranges of the tokens' hash.

    A row has the low 32 bits of a batch's tokens in one range, and which set of the batch each belongs to. Tokens of
    OFTEN sets of the batch or more are sent but once, as `often`, with the number of their sets as `times`, so that a
    token of a third of all documents is few numbers for each batch. One more row for each batch has its documents and
    says how many rows of tokens it has; its tokens, places and times are the names, sets and numbers of sets of those
    sent once.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _SPREAD.split(", ")]
        types = [pa.int32(), pa.int64(), *[pa.binary()] * 4, *[pa.list_(pa.int64())] * 3, pa.list_(pa.binary()), pa.int32()]
        for number, batch in enumerate(text_batches(batches)):
            counts, tokens = shingle_sets(batch.column(1).to_pylist(), words)
            keys = [_key(s) if len(s) else None for s in _cut(counts, tokens)]
            ids, marks = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            own = _distinct(keys)
            taken = np.zeros(len(counts), dtype=bool)
            taken[own] = True
            tokens = tokens[np.repeat(taken, counts)]
            of = np.repeat(np.arange(len(own)), counts[taken])
            part = ((tokens >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
            # by range, and in it by token: sets stay in order within a token
            order = np.argsort(tokens, kind="stable")
            in_order, first = tokens[order], np.ones(len(tokens), dtype=bool)
            first[1:] = in_order[1:] != in_order[:-1]
            starts = np.flatnonzero(first)
            times = np.diff(np.r_[starts, len(tokens)])
            many = np.repeat(times >= OFTEN, times)
            often, often_times, often_of = in_order[many & first], times[times >= OFTEN], of[order][many]
            often_part = part[order][many & first]
            single = np.zeros(len(tokens), dtype=bool)
            single[order[~many]] = True
            tokens, of, part = tokens[single], of[single], part[single]
            order = np.argsort(part.astype(np.uint16 if ranges <= 1 << 16 else np.uint32), kind="stable")
            low, of, part = tokens.astype("<u4")[order], of[order], part[order]
            there = np.union1d(part, often_part)
            ends = [(np.searchsorted(p, there), np.searchsorted(p, there, side="right")) for p in (part, often_part)]
            # the same rows in the same partition get the same name, should the task run again
            name = xxh3_64_intdigest(repr((TaskContext.get().partitionId(), number, ids)).encode() + b"".join(k or b"" for k in keys)) - (1 << 63)
            low_often, times_often = often.astype("<u4"), often_times.astype("<u4")
            rows = [(int(r), name, low[a:b].tobytes(), _steps(of[a:b]), low_often[c:d].tobytes(), times_often[c:d].tobytes(), None, None, None, None, None) for r, a, b, c, d in zip(there, *ends[0], *ends[1], strict=True)]
            called = _named(often, often_part)
            rows.append((name % ranges, name, called.tobytes(), often_of.astype("<u4").tobytes(), None, times_often.tobytes(), ids, marks, counts.tolist(), keys, len(rows)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    return docs.select("doc_id", "text", F.xxhash64("text").alias("mark")).mapInArrow(spread, _SPREAD)


def _counted(part: pa.Table) -> pa.Table:
    """Of the tokens of one range, those in two sets or more, with the logarithm of the number of sets."""
    rows = part.to_pylist()
    held = [r for r in rows if r["ids"] is None]
    single = np.frombuffer(b"".join(r["tokens"] for r in held), dtype="<u4")
    often = np.frombuffer(b"".join(r["often"] for r in held), dtype="<u4")
    times = np.concatenate([np.ones(len(single), dtype=np.int64), np.frombuffer(b"".join(r["times"] for r in held), dtype="<u4")])
    tokens = np.concatenate([single, often])
    order = np.argsort(tokens)
    in_order = tokens[order]
    starts = np.flatnonzero(np.r_[True, in_order[1:] != in_order[:-1]][: len(tokens)])
    sizes = np.diff(np.r_[starts, len(tokens)])
    levels = np.empty(len(tokens), dtype=np.uint8)
    if len(tokens):
        levels[order] = np.repeat(np.log2(np.add.reduceat(times[order], starts)).astype(np.uint8), sizes)
    at, at_often = 0, len(single)
    for r in held:
        count, count_often = len(r["tokens"]) // 4, len(r["often"]) // 4
        own, level = tokens[at : at + count], levels[at : at + count]
        kept = level > 0
        r["places"] = _steps(_places(r["places"], count)[kept])
        r["tokens"], r["levels"] = own[kept].tobytes(), level[kept].tobytes() + levels[at_often : at_often + count_often].tobytes()
        at, at_often = at + count, at_often + count_often
    types = [*part.schema.types, pa.binary()]
    names = [*part.schema.names, "levels"]
    return pa.table([pa.array([r.get(n) for r in rows], t) for n, t in zip(names, types, strict=True)], names=names)


def _ranks(tokens: np.ndarray, levels: np.ndarray, order: int) -> np.ndarray:
    """An order of all tokens: by frequency, then by a hash; after the first, frequency counts only from FREQUENT on."""
    if order == 1:
        return (levels.astype(np.uint64) << np.uint64(56)) | (_mixed(tokens, order) >> np.uint64(8))
    return ((levels >= np.log2(FREQUENT)).astype(np.uint64) << np.uint64(63)) | (_mixed(tokens, order) >> np.uint64(1))


def _prefixes(part: pa.Table, percent: int) -> pa.Table:
    """The documents of a batch (kind 0), and the prefixes of its sets: under the first order as rows of a token and a
    node (kind 1), under the others as lists (kind 2).

    Every order puts tokens of one set alone first. They are not here, but their number is known; where they fill a
    set's prefix, the set can link with no other.
    """
    rows = part.to_pylist()
    (batch,) = [r for r in rows if r["ids"] is not None]
    held = [r for r in rows if r["ids"] is None]
    if len(held) != batch["blocks"]:
        raise RuntimeError("a batch has come apart: its documents were not read in the same order twice")
    out = [(0, i, m, n, k, None if k is None else _node(k), None, None) for i, m, n, k in zip(batch["ids"], batch["marks"], batch["sizes"], batch["keys"], strict=True)]
    own = _distinct(batch["keys"])
    if own and held:
        n = np.array([batch["sizes"][i] for i in own], dtype=np.int64)
        low = [np.frombuffer(r["tokens"], dtype="<u4") for r in held]
        often = [np.frombuffer(r["often"], dtype="<u4") for r in held]
        found = [np.frombuffer(r["levels"], dtype=np.uint8) for r in held]
        named = lambda parts: np.concatenate([_named(x.astype(np.uint64), np.full(len(x), r["range"])) for x, r in zip(parts, held, strict=True)])
        called, known = named(often), np.concatenate([x[len(own_low) :] for x, own_low in zip(found, low, strict=True)])
        order = np.argsort(called)
        once, times = np.frombuffer(batch["tokens"], dtype=np.uint64), np.frombuffer(batch["times"], dtype="<u4")
        of_once = known[order][np.searchsorted(called[order], once)] if len(once) else known
        tokens = np.concatenate([named(low), np.repeat(once, times)])
        of = np.concatenate([*[_places(r["places"], len(x)) for x, r in zip(low, held, strict=True)], np.frombuffer(batch["places"], dtype="<u4").astype(np.int64)])
        levels = np.concatenate([*[x[: len(own_low)] for x, own_low in zip(found, low, strict=True)], np.repeat(of_once, times)])
        need = n - -(-percent * n // 100) + 1 - (n - np.bincount(of, minlength=len(n)))
        need[100 * n < percent * (n + 1)] = 0  # no other set is close enough in size
        some = need[of] > 0
        tokens, of, levels = tokens[some], of[some], levels[some]
        prefixes: list[list[np.ndarray]] = []
        sets = np.unique(of)
        for order in range(1, ORDERS + 1):
            at = np.lexsort((_ranks(tokens, levels, order), of))
            starts = np.searchsorted(of[at], sets)
            within = np.arange(len(at)) - np.repeat(starts, np.diff(np.r_[starts, len(at)]))
            at = at[within < need[of[at]]]
            prefixes.append(np.split(tokens[at].astype(np.int64), np.searchsorted(of[at], sets[1:])) if len(sets) else [])
        for k, i in enumerate(sets.tolist()):
            node = _node(batch["keys"][own[i]])
            out += [(1, None, None, int(n[i]), None, node, t, None) for t in prefixes[0][k].tolist()]
            out.append((2, None, None, int(n[i]), None, node, None, [p[k].tolist() for p in prefixes[1:]]))
    names = [c.split()[0] for c in _FOUND.split(", ")]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64()))]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)


def documents_and_prefixes(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """What `_prefixes` gives of all documents (doc_id and text).

    Every token of every set is counted. Tokens travel to ranges of the hash, as many as the data need, and those of
    more than one set come back to the batch of documents that sent them: no table of frequencies is held anywhere. A
    token that many sets of a batch have travels once for the batch, so a frequent one is no one task's work.
    Equal sets in several batches count several times, which changes orders, not results.
    """
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    ranges = max(1, size // (BYTES_PER_TOKEN * GATHERED))
    counted = _spread(docs, ranges, words).groupBy("range").applyInArrow(_counted, _COUNTED)
    return counted.groupBy("batch").applyInArrow(lambda part: _prefixes(part, percent), _FOUND)


def candidates(entries: DataFrame, prefixes: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Pairs of nodes (a, b) that share a prefix token under every order, and for tokens of more than LARGE sets
    the rows (token, node, least): the least node of those that have it.

    `entries` has token, node and n under the first order, `prefixes` node and the lists under the others. Pairs whose
    sizes forbid a link are left out.
    """
    entries = entries.distinct()
    tokens = entries.groupBy("token").agg(F.count(F.lit(1)).alias("sets"), F.min("node").alias("least")).filter("sets > 1")
    tokens = durable(tokens)
    total = tokens.agg(F.coalesce(F.sum("sets"), F.lit(0))).first()[0]
    shared = durable(salted_lookup(entries, tokens, ["token"], "sets", total, ["node"]))
    lists = shared.filter(F.col("sets") <= LARGE).groupBy("token").agg(F.collect_list(F.struct("node", "n")).alias("x"))
    pairs = lists.select(F.explode("x").alias("l"), "x").select("l", F.explode("x").alias("r")).filter("l.node < r.node").filter((F.least("l.n", "r.n") * 100) >= F.greatest("l.n", "r.n") * percent)
    pairs = pairs.select(F.col("l.node").alias("a"), F.col("r.node").alias("b")).distinct()
    lists = prefixes.groupBy("node").agg(F.first("others").alias("others"))
    both = pairs.join(lists.select(F.col("node").alias("a"), F.col("others").alias("x")), "a").join(lists.select(F.col("node").alias("b"), F.col("others").alias("y")), "b")
    agree = [F.arrays_overlap(F.col("x")[k], F.col("y")[k]) for k in range(ORDERS - 1)]
    for condition in agree:
        both = both.filter(condition)
    return durable(both.select("a", "b")), shared.filter(F.col("sets") > LARGE).select("token", "node", "least")


def _bitmap(rows: DataFrame) -> np.ndarray:
    """Bits at `position`, below BITS, as 32-bit words; at most BITS / 32 rows reach the driver."""
    words = rows.groupBy(F.floor(F.col("position") / 32).cast("long").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(position % 32 AS int))")).alias("bits")).toPandas()
    out = np.zeros(BITS // 32, dtype=np.uint32)
    out[words["word"].to_numpy(dtype=np.int64)] = words["bits"].to_numpy(dtype=np.int64).astype(np.uint32)
    return out


def _gathered(docs: DataFrame, places: DataFrame) -> DataFrame:
    """For each `place` the list x of the sets that stand there: node, doc_id and text, each once.

    `places` has place, node and doc_id. A bitmap of fixed size lets most other documents stay where they are.
    """
    position = F.pmod(F.xxhash64("doc_id"), F.lit(BITS))
    bitmap = _bitmap(places.select(position.alias("position")))

    @F.pandas_udf("boolean")
    def wanted(positions: pd.Series) -> pd.Series:
        at = positions.to_numpy()
        return pd.Series((bitmap[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1)

    texts = docs.filter("doc_id IS NOT NULL").filter(wanted(position)).join(places, "doc_id")
    return texts.groupBy("place").agg(F.collect_set(F.struct("node", "doc_id", "text")).alias("x"))


def _linked(overlap, a, b, percent: int):
    return 100 * overlap >= percent * (a + b - overlap)


def _overlaps(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each of x with each of y.

    Tokens that few pairs share are counted pair by pair, the others by products of 0/1 matrices.
    """
    rows = [np.repeat(np.arange(len(side)), [len(s) for s in side]) for side in (x, y)]
    tokens, ids = np.unique(np.concatenate([*x, *y]), return_inverse=True)
    ids = [ids[: len(rows[0])], ids[len(rows[0]) :]]
    counts = [np.bincount(i, minlength=len(tokens)) for i in ids]
    shared = counts[0] * counts[1]
    out = np.zeros(len(x) * len(y), dtype=np.int64)
    few = (shared > 0) & (shared <= 64)
    at = [few[i] for i in ids]
    order = np.argsort(ids[1][at[1]], kind="stable")
    held, starts = rows[1][at[1]][order], np.cumsum(np.where(few, counts[1], 0)) - np.where(few, counts[1], 0)
    own, times = ids[0][at[0]], counts[1][ids[0][at[0]]]
    within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    out += np.bincount(np.repeat(rows[0][at[0]], times) * len(y) + held[np.repeat(starts[own], times) + within], minlength=len(out))
    many = np.flatnonzero(shared > 64)
    place = np.full(len(tokens), -1)
    for k in range(0, len(many), 4096):
        some = many[k : k + 4096]
        place[:] = -1
        place[some] = np.arange(len(some))
        sides = []
        for side, i, r in zip((x, y), ids, rows, strict=True):
            column = place[i]
            sides.append(np.zeros((len(side), len(some)), dtype=np.float32))
            sides[-1][r[column >= 0], column[column >= 0]] = 1
        out += (sides[0] @ sides[1].T).astype(np.int64).ravel()
    return out.reshape(len(x), len(y))


def _stars(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Links that join the same nodes as the pairs do: each node with the least of those it is joined with."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    for x, y in zip(a, b, strict=True):
        p, q = root(x), root(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
    joined = [x for x in parent if root(x) != x]
    return joined, [root(x) for x in joined]


def _sets_of(rows: list[dict], words: int) -> tuple[list[int], list[np.ndarray]]:
    """The nodes and sets of gathered rows; a text that only shares its id with the wanted one is left out."""
    nodes, sets, seen = [], [], set()
    for row, tokens in zip(rows, _cut(*shingle_sets([r["text"] for r in rows], words)), strict=True):
        if len(tokens) and _node(_key(tokens)) == row["node"] and row["node"] not in seen:
            seen.add(row["node"])
            nodes.append(row["node"])
            sets.append(tokens)
    return nodes, sets


def _compared(blocks: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (u, v) of nodes among the sets of x, or between those of x and y: as many as join the same documents."""
    sides = len(blocks.columns)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                found = [_sets_of(batch.column(c)[k].as_py(), words) for c in range(sides)]
                (xi, xs), (yi, ys) = found[0], found[-1]
                left, right = [], []
                if xs and ys:
                    xn, yn = (np.array([len(s) for s in side]) for side in (xs, ys))
                    at, to = np.nonzero(_linked(_overlaps(xs, ys), xn[:, None], yn[None, :], percent))
                    left, right = _stars([xi[i] for i in at.tolist()], [yi[i] for i in to.tolist()])
                yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["u", "v"])

    return blocks.mapInArrow(compare, "u long, v long")


def _across(placed: DataFrame, pairs: DataFrame, frequent: DataFrame) -> DataFrame:
    """Pairs of blocks (i, j) that may still hold a link between different `label`s.

    `placed` has node, block and label. A frequent token asks for the blocks of sets that are not in its most common
    label, against all its blocks; within one label nothing is asked.
    """
    side = lambda of, to: placed.select(F.col("node").alias(of), F.col("block").alias(to), F.col("label").alias(f"label_{to}"))
    by_pair = pairs.join(side("a", "i"), "a").join(side("b", "j"), "b").filter("label_i != label_j").select("i", "j")
    held = durable(frequent.join(placed, "node").groupBy("token", "block", "label").agg(F.count(F.lit(1)).alias("sets")))
    labels = held.groupBy("token", "label").agg(F.sum("sets").alias("sets")).groupBy("token").agg(F.max_by("label", "sets").alias("main"), F.count(F.lit(1)).alias("labels")).filter("labels > 1")
    held = held.join(labels, "token").drop("sets", "labels")
    rest = held.filter("label != main").select("token", F.col("block").alias("i"), F.col("label").alias("label_i"))
    by_token = rest.join(held.select("token", F.col("block").alias("j"), F.col("label").alias("label_j")), "token").filter("label_i != label_j").select("i", "j")
    asked = by_pair.unionByName(by_token).filter("i != j")
    return asked.select(F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j")).distinct()


def verified_links(docs: DataFrame, classes: DataFrame, pairs: DataFrame, frequent: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Links (u, v) of nodes, on whole sets, for candidate `pairs` (a, b) and `frequent` (token, node, least).

    Candidates are gathered by the components of their graph, so that a text travels once, not once for each pair. A
    component too large for one task is cut into blocks; each block is compared in itself and with the same few
    leaders, which joins most of a large group of copies. Between blocks only candidates are left that these links have
    not joined yet.
    """
    found = components(pairs.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(frequent.select(F.col("node").alias("u"), F.col("least").alias("v"))))
    found = durable(found.join(classes.select("node", "n", F.col("first").alias("doc_id")), "node"))
    sizes = durable(found.groupBy("component").agg(F.count(F.lit(1)).alias("sets"), F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") / BLOCK_TOKENS)).alias("parts")))
    placed = durable(salted_lookup(found, sizes, ["component"], "sets", found.count(), ["node"]))
    few = placed.filter("parts <= 1").select("doc_id", "node", F.col("component").alias("place"))
    links = durable(_compared(_gathered(docs, few).select("x"), words, percent))
    many = placed.filter("parts > 1")
    if not many.limit(1).count():
        return links
    named = lambda part: F.concat_ws(":", "component", part)
    many = durable(many.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts"))).withColumn("block", named("part")))
    leaders = many.withColumn("_r", F.row_number().over(Window.partitionBy("component").orderBy("node"))).filter(F.col("_r") <= LEADERS)
    leaders = leaders.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).withColumn("block", named("part"))
    own = many.select("doc_id", "node", F.col("block").alias("place")).unionByName(leaders.select("doc_id", "node", F.col("block").alias("place"))).distinct()
    inside = durable(_compared(_gathered(docs, own).select("x"), words, percent))
    labels = components(inside).withColumnRenamed("component", "label")
    labelled = durable(many.join(labels, "node", "left").select("node", "doc_id", "block", F.coalesce("label", "node").alias("label")))
    asked = durable(_across(labelled, pairs, frequent))
    blocks = asked.select(F.explode(F.array("i", "j")).alias("block")).distinct()
    rest = durable(_gathered(docs, labelled.join(blocks, "block", "left_semi").select("doc_id", "node", F.col("block").alias("place"))))
    x, y = rest.withColumnRenamed("place", "i"), rest.select(F.col("place").alias("j"), F.col("x").alias("y"))
    return links.unionByName(inside).unionByName(_compared(asked.join(x, "i").join(y, "j").select("x", "y"), words, percent))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of each row.

    Two documents link when 100 times the intersection of their shingle sets is at least `percent` times
    their union; a component has the smallest id that links reach. Equal sets are joined first and looked
    at once. Sets of which one could link with the other must share a token in their prefixes under every
    global order, all of which put rare tokens first; a pair that shares one under each of ORDERS orders is verified
    on the whole sets. A token that more than LARGE sets have in their prefixes makes no pairs: its sets are compared
    with leaders first, and in blocks only where these leave different components. Tokens are 64-bit hashes; sets are
    grouped by 128-bit digests and named by 64 bits of them. Only components are kept, not the number of links.

    Null and empty texts, and texts without words, have no shingles and are linked with nothing. Very long texts are
    read whole, each in one task. Null ids have a null component unless an equal text has an id. Rows that repeat an
    id and a text get the same values. An empty table gives an empty result. Other columns are not read. The rows of
    a partition must come in the same order when they are read again, as those of files do.
    """
    return _with_components(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), words, percent).drop("component", "mark")


def _with_components(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """As `near_duplicates`, with a node that names the component (null without shingles), and `mark`, a hash of the text."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = durable(documents_and_prefixes(docs, words, percent))
    rows = found.filter("kind = 0").select("doc_id", "mark", "n", "key", "node")
    classes = durable(rows.filter("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("first"), F.max("n").alias("n"), F.first("node").alias("node"), F.count(F.lit(1)).alias("copies")))
    pairs, frequent = candidates(found.filter("kind = 1").select("token", "node", "n"), found.filter("kind = 2").select("node", "others"), percent)
    links = verified_links(docs, classes.filter("first IS NOT NULL"), pairs, frequent, words, percent)
    joined = durable(classes.join(components(links), "node", "left").withColumn("component", F.coalesce("component", "node")))
    least = durable(joined.groupBy("component").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("sets")))
    joined = salted_lookup(joined.select("key", "copies", "node", "component"), least, ["component"], "sets", joined.count(), ["node"])
    with_set = salted_lookup(rows.filter("key IS NOT NULL").drop("node"), durable(joined.select("key", "copies", "component", "component_id")), ["key"], "copies", rows.count(), ["doc_id", "mark"])
    alone = rows.filter("key IS NULL").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("component"), "mark")
    return with_set.select("doc_id", F.col("n").alias("n_shingles"), "component_id", "component", "mark").unionByName(alone)


def without_near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of `docs` for each component, with all its columns: that with the smallest id.

    Of several texts with that id in a component one stays, and of rows that repeat both, too. Rows without an id are
    no one's near copies, so they stay, each text once, unless an equal text has an id. Rows without words stay, each
    id and text once. Columns may have any names.
    """
    found = _with_components(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), words, percent)
    best = found.filter("component IS NOT NULL").groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "mark")).alias("x"))
    staying = best.select("x.doc_id", "x.mark").unionByName(found.filter("component IS NULL").select("doc_id", "mark").distinct())
    key = lambda id_, mark: F.concat_ws(":", F.coalesce(id_.cast("string"), F.lit("-")), mark)
    rows = docs.select(F.struct("*").alias("row")).select("row", key(F.col("row")[id_col].cast("long"), F.xxhash64(F.col("row")[text_col])).alias("key"))
    return rows.dropDuplicates(["key"]).join(staying.select(key(F.col("doc_id"), F.col("mark")).alias("key")), "key", "left_semi").select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op3_jaccard_join": query}
ORACLES: dict[str, str] = {}
