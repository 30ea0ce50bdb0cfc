"""Packing token pieces into sequences with minimum bin slack."""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import bucket_bits, durable, hex_bucket, seeded, table, with_running_total

CAPACITY = 2048
END_ID = 1
SEED = 13
#: Texts of this many bytes are held by a Python worker at once; more where words are looked up, which costs a pass over the known ones.
BATCH_BYTES, LOOKUP_BYTES = 4_000_000, 8_000_000
#: Bytes of known words and their ids in a Python worker, and words that are encoded in one call.
CACHED_BYTES, TOGETHER = 40_000_000, 200
#: What may follow letters as a word of its own.
PUNCTUATION = ".,;:!?*$&%#"

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def tokenizer_path() -> str:
    """The production vocabulary; a path on every machine, not copied into the repository."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pack_ids(ids: list[int]) -> bytes:
    """Little-endian 32-bit numbers."""
    return np.asarray(ids, dtype="<u4").tobytes()


class LearnedIds:
    """Token ids of texts, as little-endian 32-bit bytes, with the ids of recent words at hand.

    Subclasses say where a text can be parted into words (`_parted`), and encode those that are new (`_encode`). Known
    words and their ids are two Arrow arrays: the words of a batch are numbered together with them, so that new ones are
    those with higher numbers and only these become Python's. When the arrays are larger than CACHED_BYTES, the half that
    was met last stays, if it is smaller than that.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        #: when each word was met last, in batches
        self.met, self.batches = np.zeros(0, np.int64), 0

    def _marked(self, chosen: Callable[[str], bool]) -> np.ndarray:
        """For each id, whether its token is chosen."""
        vocabulary = self.tokenizer.get_vocab()
        marks = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        marks[[i for token, i in vocabulary.items() if chosen(token)]] = True
        return marks

    def _parted(self, texts: list[str | None]) -> tuple[bytes, np.ndarray, np.ndarray]:
        """The bytes of all words one after the other, where each starts, and the words before each text's end."""
        raise NotImplementedError

    def _encode(self, words: list[str]) -> dict[str, bytes]:
        raise NotImplementedError

    def _each(self, words: list[str]) -> Iterator[bytes]:
        """The ids of words one by one."""
        for at in range(0, len(words), TOGETHER):
            for found in self.tokenizer.encode_batch_fast(words[at : at + TOGETHER], add_special_tokens=False):
                yield pack_ids(found.ids)

    def _joined(self, words: list[str], spelled: Callable[[list[str]], str], marks: np.ndarray, ends: bool) -> Iterator[bytes]:
        """The ids of words many at a time: in the text that `spelled` makes of them, a word's last id (or first, unless `ends`) is marked, and no other."""
        for at in range(0, len(words), TOGETHER):
            some = words[at : at + TOGETHER]
            ids = pack_ids(self.tokenizer.encode_batch_fast([spelled(some)], add_special_tokens=False)[0].ids)
            found = np.flatnonzero(marks[np.frombuffer(ids, "<u4")])
            if len(found) != len(some):
                yield from self._each([spelled([word]) for word in some])
                continue
            cuts = [0, *((found + 1) * 4).tolist()] if ends else [*(found * 4).tolist(), len(ids)]
            yield from (ids[a:b] for a, b in pairwise(cuts))

    def _held(self) -> int:
        return self.words.nbytes + self.ids.nbytes

    def _keep(self, numbers: np.ndarray) -> None:
        self.words, self.ids, self.met = self.words.take(pa.array(numbers)), self.ids.take(pa.array(numbers)), self.met[numbers]

    def __call__(self, texts: list[str | None]) -> Iterator[bytes]:
        data, starts, before = self._parted(texts)
        cuts = np.append(starts, len(data)).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(data)])
        n = len(self.words)
        numbered = pa.concat_arrays([self.words, words]).dictionary_encode()
        self.words, indices = numbered.dictionary, numbered.indices[n:]
        if new := self.words[n:].to_pylist():
            found = self._encode(new)
            self.ids = pa.concat_arrays([self.ids, pa.array([found[word] for word in new], pa.large_binary())])
        taken = self.ids.take(indices)
        self.batches += 1
        self.met = np.append(self.met, np.zeros(len(new), np.int64))
        self.met[indices.to_numpy()] = self.batches
        if self._held() > CACHED_BYTES:
            self._keep(np.sort(np.argsort(self.met, kind="stable")[len(self.met) // 2 :]))
            if self._held() > CACHED_BYTES:
                self._keep(np.zeros(0, np.int64))
        _, offsets, ids = taken.buffers()
        at = np.frombuffer(offsets, np.int64)[taken.offset : taken.offset + len(taken) + 1][before].tolist() if len(taken) else [0] * len(texts)
        view = memoryview(ids or b"")
        for a, b in pairwise([0, *at]):
            yield bytes(view[a:b])


def after_letters(data: np.ndarray, punctuation: str) -> np.ndarray:
    """Where a sign of `punctuation` follows a letter of ASCII or Latin-1: no tokenizer used here joins these."""
    signs = np.zeros(256, dtype=bool)
    signs[list(punctuation.encode())] = True
    at = np.flatnonzero(signs[data[1:]]) + 1
    last = data[at - 1]
    plain = (last | 32) - ord("a") < 26
    # U+00C0 to U+00FF are 0xC3 and one more byte; two of them are signs
    latin = (last >= 0x80) & (data[at - 2] == 0xC3) & (last != 0x97) & (last != 0xB7)
    return at[plain | latin]


def text_starts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Where texts that aren't empty start, and where each text ends, in all of them together."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    return (ends - sizes)[sizes > 0], ends


class WordIds(LearnedIds):
    """Token ids by the word-level vocabulary.

    The tokenizer never joins characters across ASCII white space, so the ids of a text are those of its
    words, one after the other; and it never joins letters with punctuation, so the ids of letters that
    punctuation follows are those of the letters and those of the punctuation. Texts of Latin-1 alone are
    put in small letters first, as the tokenizer does, unless they may hold a special token, which it
    finds before that.
    """

    def __init__(self, path: str) -> None:
        super().__init__(path)
        self.ends = self._marked(lambda token: token.endswith("</w>"))

    @staticmethod
    def _lowered(text: str | None) -> bytes:
        if not text:
            return b""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text.encode()
        return (text if "<|" in text else text.lower()).encode()

    def _parted(self, texts: list[str | None]) -> tuple[bytes, np.ndarray, np.ndarray]:
        lowered = [self._lowered(x) for x in texts]
        data = np.frombuffer(b"".join(lowered), np.uint8)
        first, ends = text_starts(lowered)
        solid = ~((data - 9 < 5) | (data == 32))
        starts = solid.copy()
        starts[1:] &= ~solid[:-1]
        starts[first] = solid[first]
        starts[after_letters(data, PUNCTUATION)] = True
        return data[solid].tobytes(), np.flatnonzero(starts[solid]), np.searchsorted(np.flatnonzero(starts), ends)

    def _encode(self, words: list[str]) -> dict[str, bytes]:
        letters, others = [], []
        for word in words:
            # small letters count: one of them may stand for a letter and a mark, which is no letter
            (letters if word.isalpha() and word.lower().isalpha() else others).append(word)
        # letters have one token that ends a word, their last
        found = dict(zip(letters, self._joined(letters, " ".join, self.ends, True), strict=True))
        found.update(zip(others, self._each(others), strict=True))
        return found


_LOADED: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One for each worker process and vocabulary."""
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]


def text_batches(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `size` bytes of text."""
    for batch in batches:
        sizes = batch.column(batch.schema.get_field_index(text)).nbytes
        rows = max(1, int(batch.num_rows * size / max(1, sizes)))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def token_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Tokenises each text (null: empty), ends it with `end_id`, and cuts it at multiples of `capacity`.

    doc_id, start, length, ids_crc32 and doc_tokens of each piece, and its ids if asked for.
    """
    path = path or tokenizer_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, end, width = word_ids(path), pack_ids([end_id]), 4 * capacity
        for batch in text_batches(batches, size=LOOKUP_BYTES):
            out: tuple[list, ...] = ([], [], [], [], [], [])
            for doc, ids in zip(batch.column(0).to_pylist(), ids_of(batch.column(1).to_pylist()), strict=True):
                ids += end
                for at in range(0, len(ids), width):
                    piece = ids[at : at + width]
                    for column, v in zip(out, (doc, at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4, piece), strict=True):
                        column.append(v)
            arrays = [pa.array(c, pa.int64()) for c in out[:5]]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                arrays.append(pa.array([np.frombuffer(x, "<u4").astype("i4") for x in out[5]], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)
            # Arrow would keep this for later batches, beside a JVM with a full heap
            pa.default_memory_pool().release_unused()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECES + ", ids array<int>" * with_ids)


def fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of available lengths whose sum comes closest to `room` without exceeding it.

    Bit s of `sums` says that s can be reached; the bits before each length are kept to find the way back.
    Long lengths are tried first, and the search ends as soon as `room` itself is reached.
    """
    sums, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted((x for x in counts if x <= room and counts[x]), reverse=True):
        steps.append((length, sums))
        for _ in range(min(counts[length], room // length)):
            wider = (sums | sums << length) & mask
            if wider == sums:
                break
            sums = wider
        if sums >> room & 1:
            break
    at, chosen = sums.bit_length() - 1, {}
    for length, before in reversed(steps):
        copies = 0
        while not before >> at & 1:
            at -= length
            copies += 1
        if copies:
            chosen[length] = copies
    return chosen


def bin_plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """(lengths with multiplicities, number of sequences filled so), until nothing is left.

    Each window starts with the longest remaining piece and is filled by `fill`; the same filling is
    repeated as long as it can be. Work and size are bounded by the number of different lengths, which
    is below `capacity`, not by the number of pieces.
    """
    left, plan = {k: v for k, v in counts.items() if v}, []
    while left:
        longest = max(left)
        rest = left | {longest: left[longest] - 1}
        chosen = fill(rest, capacity - longest)
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(left[k] // n for k, n in chosen.items())
        plan.append((chosen, times))
        for k, n in chosen.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
    return plan


def _places(plan: list[tuple[dict[int, int], int]], total: int) -> tuple[np.ndarray, ...]:
    """For each length and filling, sorted by length and first rank: key, first rank, first sequence, copies, offset."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for chosen, times in plan:
        offset = 0
        for length in sorted(chosen, reverse=True):
            rows.append((length, used.get(length, 0), sequence, chosen[length], offset))
            used[length] = used.get(length, 0) + chosen[length] * times
            offset += length * chosen[length]
        sequence += times
    length, rank, first, copies, offset = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5).T
    return length * (total + 1) + rank, rank, first, copies, offset


def packed(pieces: DataFrame, capacity: int = CAPACITY, seed: int = SEED) -> DataFrame:
    """Adds sequence_id and offset to `pieces` (doc_id, start, length and more), none longer than `capacity`.

    Only the number of pieces of each length reaches the driver, at most `capacity` numbers. The plan
    made from it says which ranks among the pieces of a length go where; ranks come from a distributed
    running count in a seeded order, so that a length that a third of all pieces share is no one task's
    work. Offsets are gapless from 0 in each sequence, sequence numbers from 0. Pieces that repeat an id
    and a start are pieces of their own. No pieces, no rows.
    """
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    total = sum(counts.values())
    if not total:
        return pieces.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    keys, first_ranks, firsts, copies, offsets = _places(bin_plan(counts, capacity), total)
    bits = bucket_bits(total)
    rows = pieces.withColumn("u", seeded(seed, "doc_id", "start")).withColumns({"bucket": hex_bucket("u", bits), "one": F.lit(1)})
    ranked = with_running_total(rows, rows, ["length"], "bucket", ["u", F.col("doc_id").asc_nulls_first(), "start", "ids_crc32"], "one", "rank", bits)

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        k = length.to_numpy()
        r = rank.to_numpy() - 1
        at = np.searchsorted(keys, k * (total + 1) + r, side="right") - 1
        j = r - first_ranks[at]
        return pd.DataFrame({"sequence_id": firsts[at] + j // copies[at], "offset": offsets[at] + j % copies[at] * k})

    return ranked.withColumn("place", place("length", "rank")).select(*pieces.columns, "place.sequence_id", "place.offset")


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, seed: int = SEED) -> DataFrame:
    """The pieces of all documents with their places.

    Null and empty texts are one piece of the end id alone; very long texts are cut into whole windows
    and a rest. Null ids are kept. Rows that repeat an id are documents of their own. An empty table
    gives an empty result. Columns other than doc_id and text are not read.
    """
    return packed(durable(token_pieces(docs, path, capacity)), capacity, seed)


def packed_sequences(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, seed: int = SEED, pad_id: int = 0) -> DataFrame:
    """sequence_id and ids: the sequences themselves, padded to `capacity` unless their length is a power of two."""
    pieces = packed(durable(token_pieces(docs, path, capacity, with_ids=True)), capacity, seed)
    whole = pieces.groupBy("sequence_id").agg(F.flatten(F.array_sort(F.collect_list(F.struct("offset", "ids"))).getField("ids")).alias("ids"))
    n = F.size("ids")
    pad = F.when(n.bitwiseAND(n - 1) == 0, 0).otherwise(F.lit(capacity) - n)
    return whole.select("sequence_id", F.concat("ids", F.array_repeat(F.lit(pad_id), pad)).alias("ids"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


QUERIES = {"op7_min_slack_packing": query}
ORACLES: dict[str, str] = {}
