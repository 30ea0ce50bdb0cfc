"""Token ids in files of canonical length-limited Huffman codes: independent blocks with checkpoints, decoded by table."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import table
from lodestone.llm.packing import LOOKUP_BYTES, LearnedIds, after_letters, pack_ids, text_batches, text_starts
from lodestone.tables import discard, shared_folder, written

END_ID = 2
#: No code is longer; 2**LONGEST is above the number of ids of any installed vocabulary.
LONGEST = 20
#: A block ends with the document that reaches so many ids; a checkpoint is set every so many ids.
BLOCK_IDS, CHECKPOINT = 1 << 18, 256
#: Bytes of ids in one partition of the sort.
PARTITION_BYTES = 48_000_000
#: What may follow letters as a piece of its own; an apostrophe may begin another one.
PUNCTUATION = ".,;:!?*$&%#|"


def tokenizer_path() -> str:
    """The production vocabulary; a path on every machine, not copied into the repository."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def after_white(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each place, whether the character before it is white space, or might be for some version of Unicode."""
    last, second, third = data[at - 1], data[at - 2], data[at - 3]
    white = (last == 32) | (last - 9 < 5) | (last - 28 < 4)
    wide = np.flatnonzero(last >= 0x80)
    a, b, c = third[wide], second[wide], last[wide]
    white[wide] = (
        ((b == 0xC2) & ((c == 0x85) | (c == 0xA0)))
        | ((a == 0xE1) & (((b == 0x9A) & (c == 0x80)) | ((b == 0xA0) & (c == 0x8E))))
        | ((a == 0xE2) & (((b == 0x80) & ((c <= 0x8B) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))) | ((b == 0x81) & (c == 0x9F))))
        | ((a == 0xE3) & (b == 0x80) & (c == 0x80))
    )
    return white


class SpacedIds(LearnedIds):
    """Token ids by a byte-level vocabulary.

    This tokenizer begins a new piece at white space after a character that isn't, so a text is parted at spaces and line
    feeds there; each word keeps the white space before it. It also parts letters from the punctuation after them. New
    words that one space or line feed begins are encoded many at a time: the ids that begin with these part them again.
    """

    def __init__(self, path: str) -> None:
        super().__init__(path)
        self.begins = self._marked(lambda token: token.startswith(("Ġ", "Ċ")))

    def _parted(self, texts: list[str | None]) -> tuple[bytes, np.ndarray, np.ndarray]:
        encoded = [x.encode() if x else b"" for x in texts]
        whole = b"".join(encoded)
        data = np.frombuffer(whole, np.uint8)
        first, ends = text_starts(encoded)
        starts = np.zeros(len(data), dtype=bool)
        spaces = np.flatnonzero((data[3:] == 32) | (data[3:] == 10)) + 3
        starts[spaces[~after_white(data, spaces)]] = True
        signs = after_letters(data, PUNCTUATION)
        # a special token may end so
        starts[signs[(data[signs] != ord("|")) | (data[np.minimum(signs + 1, len(data) - 1)] != ord(">"))]] = True
        starts[first] = True
        at = np.flatnonzero(starts)
        return whole, at, np.searchsorted(at, ends)

    def _encode(self, words: list[str]) -> dict[str, bytes]:
        spaced, others = [], []
        for word in words:
            # no other white space: neither inside nor where the next word would meet it
            (spaced if word[0] in " \n" and len(word) > 1 and len(word.split()) == 1 and not (word[1].isspace() or word[-1].isspace()) else others).append(word)
        found = dict(zip(spaced, self._joined(spaced, "".join, self.begins, False), strict=True))
        found.update(zip(others, self._each(others), strict=True))
        return found


_LOADED: dict[str, SpacedIds] = {}


def spaced_ids(path: str) -> SpacedIds:
    """One for each worker process and vocabulary."""
    if path not in _LOADED:
        _LOADED[path] = SpacedIds(path)
    return _LOADED[path]


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """The length of each id's code, 0 for counts of 0: least in total among prefix codes of at most `longest` bits.

    Package-merge: in each of `longest` rounds, pairs of the round before are merged with the single ids; the cheapest
    2n - 2 of the last round are then followed back, and an id gets one bit for each round in which it is among them.
    """
    used = np.flatnonzero(counts)
    order = used[np.argsort(counts[used], kind="stable")]
    n, lengths = len(order), np.zeros(len(counts), np.int64)
    if n > 1 << longest:
        raise ValueError(f"{n} ids have no codes of {longest} bits")
    if n < 2:
        lengths[order] = 1
        return lengths
    single, pairs, rounds = counts[order].astype(np.int64), np.zeros(0, np.int64), []
    for _ in range(longest):
        both = np.concatenate((single, pairs))
        by_weight = np.argsort(both, kind="stable")
        rounds.append(by_weight < n)
        both = both[by_weight]
        both = both[: len(both) // 2 * 2]
        pairs = both[::2] + both[1::2]
    needed = 2 * n - 2
    for is_single in reversed(rounds):
        singles = int(is_single[:needed].sum())
        lengths[order[:singles]] += 1
        needed = 2 * (needed - singles)
    return lengths


class Code:
    """The canonical code of given lengths: by length, then id, each code is the one before plus one."""

    def __init__(self, lengths: np.ndarray) -> None:
        self.lengths = lengths.astype(np.int64)
        used = np.flatnonzero(lengths)
        order = used[np.lexsort((used, lengths[used]))]
        self.width = int(lengths.max(initial=1))
        spans = np.int64(1) << (self.width - self.lengths[order])
        first = np.cumsum(spans) - spans
        self.codes = np.zeros(len(lengths), np.int64)
        self.codes[order] = first >> (self.width - self.lengths[order])
        #: for every `width` bits: 32 times the id whose code they begin with, and its length
        self.table = np.ones(1 << self.width, np.uint32)
        self.table[: spans.sum()] = np.repeat(order << 5 | self.lengths[order], spans)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bits of all codes, and the bit offset of every CHECKPOINT-th id."""
        if not len(ids):
            return b"", np.zeros(0, np.int64)
        # two codes of 20 bits at most are joined first, so that half as many are put in place
        odd = np.uint64(len(ids) & 1)
        even = ids if not odd else np.append(ids, ids[-1])
        second = self.lengths[even[1::2]].astype(np.uint64)
        codes = self.codes[even[::2]].astype(np.uint64) << second | self.codes[even[1::2]].astype(np.uint64)
        first = self.lengths[even[::2]].astype(np.uint64)
        ends = np.cumsum(first + second)
        at = ends - first - second
        if odd:
            codes[-1] >>= second[-1]
            ends[-1] -= second[-1]
        # in 64-bit words: each code is shifted to its last bit's place, and what that leaves out belongs to the word before
        word, room = ends - np.uint64(1) >> np.uint64(6), np.uint64(63) - (ends - np.uint64(1) & np.uint64(63))
        words = np.zeros(int(word[-1]) + 1, np.uint64)
        # codes share words but no bits, so their sum is their union; every word has a code's end, as codes are shorter
        words[:] = np.add.reduceat(codes << room, np.searchsorted(word, np.arange(len(words), dtype=np.uint64)))
        over = np.flatnonzero(at >> np.uint64(6) != word)
        words[word[over].astype(np.int64) - 1] += codes[over] >> np.uint64(64) - room[over]
        bits, step = words.astype(">u8").tobytes()[: int(ends[-1]) + 7 >> 3], CHECKPOINT // 2
        return bits, at[::step].astype(np.int64)

    def decode(self, data: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        """The n ids that the bits hold from the first checkpoint on; all stretches between checkpoints are decoded side by side."""
        padded = np.frombuffer(data + bytes(8), np.uint8).astype(np.uint32)
        words = padded[:-3] << 24 | padded[1:-2] << 16 | padded[2:-1] << 8 | padded[3:]
        out = np.zeros((CHECKPOINT, len(checkpoints)), np.uint32)
        at, shift, mask, last = checkpoints.astype(np.int64), 32 - self.width, (1 << self.width) - 1, len(words) - 1
        for k in range(min(CHECKPOINT, n)):
            found = self.table[words[at >> 3] >> (shift - (at & 7)) & mask]
            out[k] = found
            # the last stretch may be shorter than the others: it stays within the padding
            at = np.minimum(at + (found & 31), last * 8)
        return (out.T.ravel()[:n]) >> 5


BLOCKS = "part int, block int, before long, n_ids long, doc_ids array<bigint>, doc_lengths array<bigint>, checkpoints array<bigint>, bits binary, bits_crc32 long"


def id_type(path: str, end_id: int) -> str:
    """16 bits for an id where the vocabulary allows it."""
    return "<u2" if max(len(spaced_ids(path).begins), end_id + 1) <= 1 << 16 else "<u4"


def token_ids(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, n_tokens, ids_crc32 and ids (of `id_type`) of each text and its end; counts is null.

    The last row of each task has counts alone, if it had texts: how often each id below their number occurs there, as
    little-endian 64-bit numbers.
    """
    kind = id_type(path, end_id)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, end = spaced_ids(path), pack_ids([end_id])
        counts = np.zeros(max(len(ids_of.begins), end_id + 1), "<i8")

        def rows(*values: list) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], ["doc_id", "n_tokens", "ids_crc32", "ids", "counts"])

        for batch in text_batches(batches, size=LOOKUP_BYTES):
            found = [ids + end for ids in ids_of(batch.column(1).to_pylist())]
            whole = np.frombuffer(b"".join(found), "<u4")
            counts += np.bincount(whole, minlength=len(counts))
            ends = np.cumsum([len(x) // 4 for x in found]).tolist()
            packed, size = whole.astype(kind).tobytes(), int(kind[-1])
            ids = [packed[a * size : b * size] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
            yield rows(batch.column(0).to_pylist(), [len(x) // 4 for x in found], [zlib.crc32(x) for x in found], ids, [None] * len(ids))
        if counts.any():
            yield rows([None], [None], [None], [None], [counts.tobytes()])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(encode, "doc_id long, n_tokens long, ids_crc32 long, ids binary, counts binary")


def id_counts(rows: DataFrame, ids: int) -> np.ndarray:
    """How often each id below `ids` occurs in all: the sum of the counts of `token_ids`, which tasks sum first."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(ids, np.int64)
        for batch in batches:
            for counts in batch.column(0).to_pylist():
                total += np.frombuffer(counts, "<i8")
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["id", "n"])

    counts = np.zeros(ids, np.int64)
    # at most one row for each id of the vocabulary
    for r in rows.filter("counts IS NOT NULL").select("counts").mapInArrow(add, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[r["id"]] = r["n"]
    return counts


def write_token_files(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID) -> None:
    """Writes the ids of all documents by ascending doc_id: `folder`/blocks has their blocks, `folder`/code the code.

    The code has each id's length, from the counts of all ids; the lengths say all of a canonical code. A row of `blocks`
    is one block: the number of its file and its place there, the ids before it in this file, its documents and their
    lengths, the checkpoints and the bits with their CRC-32. Documents are not cut, so one longer than BLOCK_IDS makes a
    longer block. Documents that share an id, or have none (they come first), are put in order by the CRC of their ids
    and then by row, so that no id's documents need to fit into one task. Null and empty texts are their end alone. An
    empty table makes files without blocks. Other columns are not read.
    """
    path = path or tokenizer_path()
    spark = docs.sparkSession
    rows = written(token_ids(docs, path, end_id).withColumn("number", F.monotonically_increasing_id()), "zstd")
    kind = id_type(path, end_id)
    counts = id_counts(rows, max(len(spaced_ids(path).begins), end_id + 1))
    lengths = code_lengths(counts)
    used = np.flatnonzero(lengths).tolist()
    spark.createDataFrame([(i, int(lengths[i])) for i in used], "id long, bits int").coalesce(1).write.parquet(f"{folder}/code")
    code = Code(lengths)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, before = TaskContext.get().partitionId(), 0, 0
        docs, sizes, held, n = [], [], [], 0

        def row() -> pa.RecordBatch:
            bits, checkpoints = code.encode(np.concatenate(held))
            values = (part, block, before, n, docs, sizes, checkpoints.tolist(), bits, zlib.crc32(bits))
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names)

        for batch in batches:
            for doc, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(np.frombuffer(ids, kind))
                docs.append(doc)
                sizes.append(len(held[-1]))
                n += sizes[-1]
                if n >= BLOCK_IDS:
                    yield row()
                    block, before, docs, sizes, held, n = block + 1, before + n, [], [], [], 0
        if docs:
            yield row()

    names = [x.split()[0] for x in BLOCKS.split(", ")]
    longs = pa.list_(pa.int64())
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), longs, longs, longs, pa.binary(), pa.int64()]
    order = [F.col("doc_id").asc_nulls_first(), "ids_crc32", "number"]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(counts.sum()) * 2 // PARTITION_BYTES)
    sorted_rows = rows.filter("ids IS NOT NULL").select("doc_id", "ids", "ids_crc32", "number").repartitionByRange(parts, *order).sortWithinPartitions(*order)
    sorted_rows.select("doc_id", "ids").mapInArrow(encode, BLOCKS).write.option("compression", "none").parquet(f"{folder}/blocks")
    discard(rows)


def read_code(spark: SparkSession, folder: str) -> Code:
    """The code of written files; it has at most one row for each id of the vocabulary."""
    rows = spark.read.parquet(f"{folder}/code").collect()
    lengths = np.zeros(max((r["id"] for r in rows), default=0) + 1, np.int64)
    for r in rows:
        lengths[r["id"]] = r["bits"]
    return Code(lengths)


def file_starts(spark: SparkSession, folder: str) -> dict[int, int]:
    """The ids before each file: one number for each file, whose bits aren't read."""
    totals = spark.read.parquet(f"{folder}/blocks").groupBy("part").agg(F.sum("n_ids").alias("n")).collect()
    starts, at = {}, 0
    for part, n in sorted((r["part"], r["n"]) for r in totals):
        starts[part] = at
        at += n
    return starts


def read_documents(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids, if asked for) of all documents of written files, by decoding each block by itself.

    Damaged bits are an error.
    """
    code, starts = read_code(spark, folder), file_starts(spark, folder)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):
                if zlib.crc32(r["bits"]) != r["bits_crc32"]:
                    raise ValueError(f"block {r['block']} of file {r['part']} is damaged")
                ids = code.decode(r["bits"], np.array(r["checkpoints"]), r["n_ids"]).astype("<u4")
                sizes = np.array(r["doc_lengths"])
                ends = np.cumsum(sizes)
                found = [ids[e - n : e] for n, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
                columns = [pa.array(r["doc_ids"], pa.int64()), pa.array(starts[r["part"]] + r["before"] + ends - sizes, pa.int64()), pa.array(sizes, pa.int64()), pa.array([zlib.crc32(x) for x in found], pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns, names = [*columns, pa.array([x.astype("i4") for x in found], pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return spark.read.parquet(f"{folder}/blocks").mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)


def read_span(spark: SparkSession, folder: str, first: int, last: int) -> DataFrame:
    """start and ids: the ids from number `first` to before `last`, in pieces; blocks beside these are not read, and of the others only the stretches between the checkpoints around them are decoded."""
    code, starts = read_code(spark, folder), file_starts(spark, folder)
    within = F.lit(False)
    for part, start in starts.items():
        within |= (F.col("part") == part) & (F.col("before") + F.col("n_ids") > first - start) & (F.col("before") < last - start)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):
                start = starts[r["part"]] + r["before"]
                low, high = max(first - start, 0), min(last - start, r["n_ids"])
                point = low // CHECKPOINT
                some = np.array(r["checkpoints"])[point : -(-high // CHECKPOINT)]
                ids = code.decode(r["bits"], some, high - point * CHECKPOINT)[low - point * CHECKPOINT :]
                yield pa.RecordBatch.from_arrays([pa.array([start + low], pa.int64()), pa.array([ids.astype("i4")], pa.list_(pa.int32()))], ["start", "ids"])

    wanted = spark.read.parquet(f"{folder}/blocks").filter(within).select("part", "before", "n_ids", "checkpoints", "bits")
    return wanted.mapInArrow(decode, "start long, ids array<int>")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the files of all documents to the shared folder and reads them back; ids, texts and rows as in `write_token_files`."""
    folder = f"{shared_folder(spark)}/token-files-{uuid.uuid4().hex}"
    write_token_files(table(spark, sf_dir, "documents"), folder)
    return read_documents(spark, folder)


QUERIES = {"op13_huffman_files": query}
ORACLES: dict[str, str] = {}
