"""Periodic runs of words: block convolution at dyadic scales finds distances, which are then extended to whole runs."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import table
from lodestone.llm.packing import text_batches

#: A run has at least so many periods and so many words.
PERIODS, LEAST_LENGTH = 4, 6
#: Primes 15 * 2**27 + 1 and 27 * 2**26 + 1, each with a generator of its units.
PRIMES = ((2013265921, 31), (1811939329, 13))
#: Numbers that one matrix of blocks holds, but for a single larger block.
MATRIX = 1 << 18

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


class Transform:
    """Number theoretic transforms of rows of 2**k numbers below a prime.

    `forward` leaves the frequencies in bit-reversed order, which `inverse` expects; products do not mind.
    """

    def __init__(self, prime: int, generator: int) -> None:
        self.prime, self.generator = np.uint64(prime), generator
        self.powers: dict[tuple[int, bool], np.ndarray] = {}

    def _roots(self, half: int, inverse: bool) -> np.ndarray:
        """The first `half` powers of a root of unity of order 2 * half."""
        if (half, inverse) not in self.powers:
            p = int(self.prime)
            root = pow(self.generator, (p - 1) // (2 * half), p)
            step, out = pow(root, -1, p) if inverse else root, np.ones(half, np.uint64)
            done = 1
            while done < half:
                out[done : 2 * done] = out[:done] * np.uint64(pow(step, done, p)) % self.prime
                done *= 2
            self.powers[half, inverse] = out
        return self.powers[half, inverse]

    def forward(self, a: np.ndarray) -> np.ndarray:
        half = a.shape[1] // 2
        while half:
            pairs = a.reshape(len(a), -1, 2, half)
            low, high = pairs[:, :, 0], pairs[:, :, 1]
            difference = (low + (self.prime - high)) * self._roots(half, False) % self.prime
            pairs[:, :, 0] = (low + high) % self.prime
            pairs[:, :, 1] = difference
            half //= 2
        return a

    def inverse(self, a: np.ndarray) -> np.ndarray:
        half, width = 1, a.shape[1]
        while half < width:
            pairs = a.reshape(len(a), -1, 2, half)
            high = pairs[:, :, 1] * self._roots(half, True) % self.prime
            low = pairs[:, :, 0].copy()
            pairs[:, :, 0] = (low + high) % self.prime
            pairs[:, :, 1] = (low + (self.prime - high)) % self.prime
            half *= 2
        return a * np.uint64(pow(width, -1, int(self.prime))) % self.prime

    def squared_differences(self, blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
        """For rows of b and of 2b numbers: the sum over i of (block[i] - window[s + i])**2 for s < b, modulo the prime.

        It is the sum of both squares less twice a correlation, which is the convolution with the reversed block. The
        cyclic convolution of length 2b does not wrap for these s.
        """
        p, b = self.prime, blocks.shape[1]
        squares = np.zeros((len(windows), 2 * b + 1), np.uint64)
        np.cumsum(windows * windows % p, axis=1, out=squares[:, 1:])
        reversed_blocks = np.zeros_like(windows)
        reversed_blocks[:, 0] = blocks[:, 0]
        reversed_blocks[:, b + 1 :] = blocks[:, :0:-1]
        product = self.forward(reversed_blocks) * self.forward(windows.copy()) % p
        correlation = self.inverse(product)[:, :b]
        both = (blocks * blocks % p).sum(axis=1, keepdims=True) + squares[:, b : 2 * b] - squares[:, :b]
        return (both + np.uint64(2) * (p - correlation)) % p


_TRANSFORMS = [Transform(*x) for x in PRIMES]


def zero_mismatches(ids: np.ndarray, at: np.ndarray, b: int) -> np.ndarray:
    """Whether the block of b ids at each of `at` occurs again s + b further on, for s < b: a row for each block.

    `ids` must go on for 3b after each of `at`. A sum of squared differences is 0 exactly if it is 0 modulo primes whose
    product it is below: one prime for small ids and blocks, two for all others (up to ids of 2**20 and blocks of 2**21).
    """
    inside = np.arange(b)
    out = np.empty((len(at), b), bool)
    rows = max(1, MATRIX // (2 * b))
    for k in range(0, len(at), rows):
        some = at[k : k + rows]
        blocks = ids[some[:, None] + inside]
        windows = ids[(some + b)[:, None] + np.arange(2 * b)]
        largest = int(max(blocks.max(), windows.max()))
        zero = np.ones((len(some), b), bool)
        below = 1
        for transform in _TRANSFORMS:
            zero &= transform.squared_differences(blocks, windows) == 0
            below *= int(transform.prime)
            if b * largest * largest < below:
                break
        out[k : k + rows] = zero
    return out


def _first_difference(ids: np.ndarray, i: int, d: int, end: int) -> int:
    """The first position from i whose id is not that of the position d further on, which must be below `end`."""
    step = 64
    while i + d < end:
        k = min(step, end - d - i)
        differ = ids[i : i + k] != ids[i + d : i + d + k]
        if differ.any():
            return i + int(differ.argmax())
        i, step = i + k, step * 4
    return i


def _last_difference(ids: np.ndarray, i: int, d: int, start: int) -> int:
    """The first position of the stretch before i, not before `start`, in which all ids are those d further on."""
    step = 64
    while i > start:
        k = min(step, i - start)
        differ = ids[i - k : i] != ids[i - k + d : i + d]
        if differ.any():
            return i - int(differ[::-1].argmax())
        i, step = i - k, step * 4
    return i


def _stretches(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the longest stretches without 0 that have LEAST_LENGTH ids at least."""
    change = np.flatnonzero(np.diff(np.concatenate(([0], (ids != 0).astype(np.int8), [0]))))
    start, end = change[::2], change[1::2]
    keep = end - start >= LEAST_LENGTH
    return start[keep], end[keep]


def runs_of_ids(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, period) of every run, in which no 0 takes part: 0 separates texts and stands for words too rare.

    A run of smallest period p holds, for the power of two b with b <= p < 2b, two neighbouring blocks of b ids that start
    at multiples of b from its stretch's start and both occur again p further on. So the zero mismatches that two
    neighbours share are the seeds; each is extended both ways as far as ids repeat. A block that a run of a smaller
    period holds together with its occurrence belongs to no run of this distance. A stretch of both a smaller and a
    larger period is found with the smaller one first.
    """
    start, end = _stretches(ids)
    if not len(start):
        return []
    # an id that a stretch holds fewer times than a run has periods is in no run there
    ids = ids.astype(np.uint64)
    part = np.repeat(np.arange(len(start)), end - start)
    places = np.concatenate([np.arange(s, e) for s, e in zip(start.tolist(), end.tolist(), strict=True)])
    _, which, n = np.unique(part * (int(ids.max()) + 1) + ids[places].astype(np.int64), return_inverse=True, return_counts=True)
    ids[places[n[which] < PERIODS]] = 0
    start, end = _stretches(ids)
    longest = int((end - start).max(initial=0))
    ids = np.concatenate([ids, np.zeros(max(3 * longest, 1), np.uint64)])
    cover = np.zeros(len(ids), np.int64)
    found: dict[tuple[int, int], int] = {}
    b = 1
    while PERIODS * b <= longest:
        keep = end - start >= PERIODS * b
        start, end = start[keep], end[keep]
        count = (end - start) // b - 1
        of = np.repeat(np.arange(len(start)), count)
        at = start[of] + (np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)) * b
        fresh = cover[at] < at + 3 * b
        at, of = at[fresh], of[fresh]
        new = []
        passed: dict[tuple[int, int], int] = {}
        for k in range(0, len(at), piece := max(2, MATRIX // b)):
            # one block more than the piece, so that each but the very last has its neighbour
            a, o = at[k : k + piece + 1], of[k : k + piece + 1]
            zero = zero_mismatches(ids, a, b)
            neighbours = (a[1:] == a[:-1] + b) & (o[1:] == o[:-1])
            for row, s in np.argwhere(zero[:-1] & zero[1:] & neighbours[:, None]).tolist():
                x, d, stretch = int(a[row]), s + b, int(o[row])
                if x < passed.get((stretch, d), 0) or cover[x] >= x + d + b:
                    continue
                first = int(start[stretch])
                e = _first_difference(ids, x + b, d, int(end[stretch]))
                passed[stretch, d] = e
                f = _last_difference(ids, x, d, first)
                if e + d - f >= max(LEAST_LENGTH, PERIODS * d) and (f, e + d) not in found:
                    found[f, e + d] = d
                    new.append((f, e + d))
        for f, e in new:
            cover[f:e] = np.maximum(cover[f:e], e)
        b *= 2
    return sorted((f, e, d) for (f, e), d in found.items())


def runs_of_texts(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each list of words, by start and period.

    All texts of a batch are searched at once, so that transforms have many rows. A word that a text has fewer times than
    a run has periods is in no run of it.
    """
    starts, parts, at = [], [], 0
    for words in texts:
        starts.append(at)
        number = {w: 0 for w, n in Counter(words).items() if n >= PERIODS} if len(words) >= LEAST_LENGTH else {}
        if number:
            number = {w: k for k, w in enumerate(number, 1)}
            parts.append(np.fromiter(map(number.get, words, repeat(0)), np.int64, len(words)))
            parts.append(np.zeros(1, np.int64))
            at += len(words) + 1
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if parts:
        found = runs_of_ids(np.concatenate(parts))
        owner = np.searchsorted(starts, [f for f, _, _ in found], side="right") - 1
        for (f, e, d), k in zip(found, owner.tolist(), strict=True):
            out[k].append((f - starts[k], e - f, d))
    return out


def without_repeats(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words but for those that some run holds after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return [w for w, k in zip(words, keep.tolist(), strict=True) if k]


def periodic_runs(docs: DataFrame, edit: Callable[[int | None, list[bytes]], list[bytes]] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs and collapsed for each row: nothing is shuffled.

    Words are what ASCII white space separates. A run is a stretch with smallest period q of at least LEAST_LENGTH words
    and PERIODS * q, which no neighbouring word extends; runs are listed as start, length and period, by start and
    period. `collapsed` has the words that no run holds after its first period, joined by spaces. `edit` may change a
    document's words first.

    Null and empty texts have no words and no runs; a text of one word repeated is one run. Very long texts are held whole
    by one task, in memory proportional to their words. Null and repeated ids and repeated rows are kept as they are; an
    empty table gives an empty result. Other columns are not read.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in text_batches(batches):
            texts = [(x or b"").split() for x in batch.column(1).to_pylist()]
            if edit:
                texts = [edit(doc, words) for doc, words in zip(batch.column(0).to_pylist(), texts, strict=True)]
            runs = runs_of_texts(texts)
            collapsed = [b" ".join(without_repeats(words, own)) for words, own in zip(texts, runs, strict=True)]
            listed = [[{"start": s, "length": n, "period": q} for s, n, q in own] for own in runs]
            arrays = [batch.column(0), pa.array(map(len, texts), pa.int64()), pa.array(listed, run), pa.array(collapsed, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(search, f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def strongest(runs: Column) -> Column:
    """The run with the greatest length for its period, compared exactly; of equal ones the first in the list."""
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    better = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    return F.aggregate(runs, none, lambda best, r: F.when(better(best, r), r).otherwise(best))


def planted_repeats(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The contract's edit: the CRC-32 of the decimal id repeats the words of one document in ten from some word on.

    A null id leaves the words as they are.
    """
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns for all documents; ids, texts and rows as in `periodic_runs`."""
    found = periodic_runs(table(spark, sf_dir, "documents"), planted_repeats)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    digests = {"runs_sha256": F.sha2(F.array_join(lines, ""), 256), "collapsed_sha256": F.sha2("collapsed", 256)}
    rows = found.withColumn("best", strongest(F.col("runs"))).withColumns(digests)
    milli = F.expr("1000 * best.length div best.period").alias("exponent_milli")
    return rows.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", milli, *digests)


QUERIES = {"op12_periodic_runs": query}
ORACLES: dict[str, str] = {}
