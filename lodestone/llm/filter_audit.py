"""How filters interact: what each removes after the others in every order, with copies found in tries of whole texts."""

from __future__ import annotations

import os
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from itertools import groupby, permutations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import table
from lodestone.llm.packing import text_batches

#: One letter for each filter; filter k has bit 2**k in a mask. The last one is the filter of copies.
FILTERS = "ABCDE"
COPY = 1 << (len(FILTERS) - 1)
LEAST_WORDS, LEAST_DISTINCT_PERCENT, MOST_CAPITALS_PERCENT = 200, 50, 3
SYMBOLS = b"#$%&*|"
#: Bytes of text in one range, and in a trie that is emptied before its task ends.
RANGE_BYTES, LOCAL_BYTES = 32_000_000, 64_000_000
#: Prefixes are chosen from a sample of so many rows and bytes; it only balances the ranges. Longer ones are read in turn.
SAMPLE_ROWS, SAMPLE_BYTES, SAMPLE_PREFIXES, SAMPLE_SEED = 1 << 15, 32_000_000, (1 << 9, 1 << 12, 1 << 15, 1 << 18, 1 << 21), 29

_SYMBOL = re.compile(b"[" + SYMBOLS + b"]")
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
#: UTF-8 bytes that go on with a character.
_CONTINUED = bytes(range(0x80, 0xC0))

ROWS = "doc_id long, part string, mask int, n long"
PIECES = f"range int, text binary, {ROWS}"


def text_mask(text: bytes) -> int:
    """The bits of the filters that a text fails by itself: few words, few distinct words, many capitals, symbols."""
    words = text.split()
    few = len(words) < LEAST_WORDS
    repeated = 100 * len(set(words)) < LEAST_DISTINCT_PERCENT * len(words)
    capitals = 100 * (len(text) - len(text.translate(None, _CAPITALS))) > MOST_CAPITALS_PERCENT * len(text.translate(None, _CONTINUED))
    return few | repeated << 1 | capitals << 2 | bool(_SYMBOL.search(text)) << 3


class Node:
    """The end of a label in a compressed trie; `held` is there where a text ends."""

    __slots__ = ("label", "below", "held")

    def __init__(self, label: bytes) -> None:
        self.label, self.below, self.held = label, {}, None


class Held:
    """A text's least id, its mask, and the number of rows with this id in each part."""

    __slots__ = ("least", "mask", "parts")

    def __init__(self, least: int, mask: int) -> None:
        self.least, self.mask, self.parts = least, mask, {}


class Trie:
    """A compressed trie of texts; each terminal keeps the rows with the least id, and tells which others are copies."""

    def __init__(self) -> None:
        self.root, self.size = Node(b""), 0

    def terminal(self, text: bytes) -> Node:
        """The node at which the text ends, made if it isn't there."""
        node, at = self.root, 0
        while at < len(text):
            child = node.below.get(text[at])
            if child is None:
                child = node.below[text[at]] = Node(text[at:])
                self.size += len(text) - at
                return child
            if text.startswith(child.label, at):
                node, at = child, at + len(child.label)
                continue
            shared = len(os.path.commonprefix((child.label, text[at : at + len(child.label)])))
            above = node.below[text[at]] = Node(child.label[:shared])
            child.label = child.label[shared:]
            above.below[child.label[0]] = child
            node, at = above, at + shared
        return node

    def insert(self, text: bytes, doc_id: int, part: str, mask: int, n: int) -> list[tuple[int, str, int, int]]:
        """Adds n rows; returns (id, part, mask, n) of the rows that are known to be copies now: these, or those held before."""
        node = self.terminal(text)
        if node.held is None:
            node.held = Held(doc_id, mask)
        held, copies = node.held, []
        if doc_id > held.least:
            return [(doc_id, part, mask | COPY, n)]
        if doc_id < held.least:
            copies = [(held.least, p, held.mask | COPY, k) for p, k in held.parts.items()]
            held.least, held.parts = doc_id, {}
        held.parts[part] = held.parts.get(part, 0) + n
        return copies

    def terminals(self) -> Iterator[tuple[bytes, Held]]:
        """Every text with what its terminal holds, each label's bytes before those below it."""
        left = [(b"", self.root)]
        while left:
            before, node = left.pop()
            text = before + node.label
            if node.held is not None:
                yield text, node.held
            left.extend((text, child) for child in node.below.values())


def _cuts(texts: list[tuple[bytes, int]], room: float, read: int) -> tuple[list[bytes], list[bytes]]:
    """Prefixes that cut sorted (first `read` bytes, weight) into ranges of about `room`, and beginnings that weigh more but can't be cut in the bytes read.

    Between two neighbours, the prefix is that of the second as far as it differs from the first.
    """
    cuts, heavy, weight, last = [], [], 0.0, None
    for text, rows in groupby(texts, lambda x: x[0]):
        own = sum(w for _, w in rows)
        if own > room and len(text) == read:
            heavy.append(text)
        if last is not None and weight + own > room:
            cuts.append(text[: len(os.path.commonprefix((last, text))) + 1])
            weight = 0.0
        last, weight = text, weight + own
    return cuts, heavy


def adaptive_prefixes(docs: DataFrame, ranges: int | None = None) -> list[bytes]:
    """Sorted prefixes between which texts (column text, in bytes) fall into ranges of about RANGE_BYTES, or so many ranges.

    They are as long as the texts that they part require: where many texts begin alike, more of these is read. A sample
    of bounded size is enough, since ranges only share out the work. Copies of one text can't be parted; they are merged
    before they are sent.
    """
    rows = docs.select(F.octet_length("text").alias("n"), "text")
    total, weight = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("n") + 64), F.lit(0))).first()
    if not total:
        return []
    ranges = ranges or max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), weight // RANGE_BYTES)
    room, share, cuts, wanted = weight / ranges, 1.0, [], None
    for read in SAMPLE_PREFIXES:
        some, before = rows, SAMPLE_PREFIXES[max(0, SAMPLE_PREFIXES.index(read) - 1)]
        if wanted is not None:
            some = rows.filter(F.substring("text", 1, before).isin([F.lit(x) for x in wanted]))
        fraction = min(1.0, min(SAMPLE_ROWS, SAMPLE_BYTES / read) / max(1.0, total * share))
        found = sorted((bytes(r[0]), (r[1] + 64) / fraction) for r in some.sample(fraction, SAMPLE_SEED).select(F.substring("text", 1, read), "n").collect())
        new, heavy = _cuts(found, room, read)
        cuts += new
        if not heavy:
            break
        wanted, at_hand = heavy, set(heavy)
        share = sum(w for x, w in found if x in at_hand) / weight
    return sorted(set(cuts))


def masks(docs: DataFrame, ranges: int | None = None, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """doc_id, part and mask of all rows, and n, the number of such rows: what sums to one row for each row of `docs`.

    Each task puts its texts into a trie first, so that a text leaves it once with the rows of its least id there; rows
    with larger ids are copies for certain. Texts are dealt by ranges of adaptive prefixes to the tries that decide. A
    trie that holds LOCAL_BYTES is sent on and begun anew.

    A copy is a row with the same bytes as a row of smaller id. Rows that share their text and id aren't copies of each
    other; null ids are neither smaller nor larger than others, so their rows neither are nor make copies. Null texts are
    empty, null parts are empty strings. Very long texts are held whole. An empty table gives an empty result. Other
    columns are not read.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
    )
    prefixes = adaptive_prefixes(rows, ranges)
    parts = len(prefixes) + 1

    def sent(pieces: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int32(), pa.binary(), pa.int64(), pa.string(), pa.int32(), pa.int64())
        columns = zip(*pieces, strict=True) if pieces else [[]] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["range", "text", "doc_id", "part", "mask", "n"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emptied() -> Iterator[pa.RecordBatch]:
            pieces, size = [], 0
            for text, held in trie.terminals():
                place = bisect_right(prefixes, text)
                pieces += [(place, text, held.least, part, held.mask, n) for part, n in held.parts.items()]
                size += len(text)
                if size > RANGE_BYTES // 4:
                    yield sent(pieces)
                    pieces, size = [], 0
            yield sent(pieces)

        trie = Trie()
        for batch in text_batches(batches):
            settled: dict[tuple, int] = defaultdict(int)
            for doc, text, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                mask = text_mask(text)
                for key in [(doc, part, mask, 1)] if doc is None else trie.insert(text, doc, part, mask, 1):
                    settled[key[:3]] += key[3]
            yield sent([(hash(doc) % parts, None, doc, part, mask, n) for (doc, part, mask), n in settled.items()])
            if trie.size > LOCAL_BYTES:
                yield from emptied()
                trie = Trie()
        yield from emptied()

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie()
        for batch in batches:
            known = []
            for _, text, doc, part, mask, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                known += [(doc, part, mask, n)] if text is None else trie.insert(text, doc, part, mask, n)
            yield sent([(0, None, *x) for x in known]).select(["doc_id", "part", "mask", "n"])
        firsts = [(0, None, held.least, part, held.mask, n) for _, held in trie.terminals() for part, n in held.parts.items()]
        yield sent(firsts).select(["doc_id", "part", "mask", "n"])

    return rows.select("doc_id", "text", "part").mapInArrow(gather, PIECES).repartitionById(parts, "range").mapInArrow(decide, ROWS)


def interactions(counts: DataFrame) -> DataFrame:
    """The audit of all orders from counts: part, mask, n (rows), good and toxic (of these), one row for each part and mask.

    A row of each part, order of FILTERS and step: kept after it, removed in it, redundant (failing its filter, but removed
    before), unique_fails (failing no other filter), good_lost and toxic_lost (of those removed), and shapley: what its
    filter removes, over all orders, which is the same share of all orders for each filter that a row fails.
    """
    orders = ["".join(p) for p in permutations(FILTERS)]
    steps = len(FILTERS)
    rows = counts.withColumn("filter_order", F.explode(F.array(*map(F.lit, orders))))
    rows = rows.withColumn("bits", F.expr(f"transform(sequence(1, {steps}), k -> shiftleft(1, instr('{FILTERS}', substr(filter_order, k, 1)) - 1))"))
    rows = rows.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(steps))))
    rows = rows.withColumn("bit", F.col("bits")[F.col("step") - 1]).withColumn("earlier", F.expr("aggregate(slice(bits, 1, step - 1), 0, (a, b) -> a | b)"))
    fails, gone = F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("mask").bitwiseAND(F.col("earlier")) != 0
    total = lambda what, n="n": F.sum(F.when(what, F.col(n)).otherwise(0)).cast("long")
    first_of = F.floor(F.lit(len(orders)) / F.bit_count("mask"))
    return rows.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone).alias("kept"),
        total(fails & ~gone).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(fails & ~gone, "good").alias("good_lost"),
        total(fails & ~gone, "toxic").alias("toxic_lost"),
        F.sum(F.when(fails, F.col("n") * first_of).otherwise(0)).cast("long").alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame, ranges: int | None = None) -> DataFrame:
    """`interactions` of the filters of FILTERS on the documents, by lang.

    Labels are joined by doc_id to rows that are summed by id, part and mask before; an id with several labels counts once
    for each mark that any of them sets. Documents without labels or ids are neither good nor toxic. The rest is as in
    `masks`.
    """
    marks = masks(docs, ranges).groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))
    marked = lambda name: F.max(F.coalesce(F.col(name) == 1, F.lit(False)).cast("long")).alias(name)
    flags = labels.filter("quality = 1 or toxic = 1").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(marked("quality"), marked("toxic"))
    of = lambda name: F.sum(F.col("n") * F.coalesce(F.col(name), F.lit(0)))
    counts = marks.join(flags, "doc_id", "left").groupBy("part", "mask").agg(F.sum("n").alias("n"), of("quality").alias("good"), of("toxic").alias("toxic"))
    return interactions(counts)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op11_filter_audit": query}
ORACLES = {
    "op11_filter_audit": r"""
with texts as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as body from documents),
worded as (select *, regexp_extract_all(body, '[^\x20\x09-\x0D]+') as words from texts),
failed as (
  select doc_id, part,
    len(words) < 200 as a,
    100 * len(list_distinct(words)) < 50 * len(words) as b,
    100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 3 * length(body) as c,
    regexp_matches(body, '[#$%&*|]') as d,
    coalesce(min(doc_id) over (partition by body) < doc_id, false) as e
  from worded),
flags as (select doc_id, max((coalesce(quality, 0) = 1)::int) as good, max((coalesce(toxic, 0) = 1)::int) as toxic from labels group by doc_id),
rows as (select f.*, coalesce(l.good, 0) as good, coalesce(l.toxic, 0) as toxic from failed f left join flags l using (doc_id)),
fails as (
  select part, row_number() over () as r, good, toxic,
    case when a then 'A' else '' end || case when b then 'B' else '' end || case when c then 'C' else '' end || case when d then 'D' else '' end || case when e then 'E' else '' end as set
  from rows),
counts as (select part, set, count(*) as n, sum(good) as good, sum(toxic) as toxic from fails group by part, set),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders as (
  select p.x || q.x || r.x || s.x || t.x as o from letters p, letters q, letters r, letters s, letters t
  where len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
steps as (select o, k, substr(o, k, 1) as x, substr(o, 1, k - 1) as earlier from orders, range(1, 6) as ks(k)),
met as (
  select c.*, s.o, s.k, s.x, contains(c.set, s.x) as hit,
    len(list_intersect(string_split(c.set, ''), string_split(s.earlier, ''))) > 0 and s.earlier <> '' and c.set <> '' as gone
  from counts c, steps s),
audit as (
  select part, o as filter_order, k as step, x,
    sum(case when not hit and not gone then n else 0 end) as kept,
    sum(case when hit and not gone then n else 0 end) as removed,
    sum(case when hit and gone then n else 0 end) as redundant,
    sum(case when set = x then n else 0 end) as unique_fails,
    sum(case when hit and not gone then good else 0 end) as good_lost,
    sum(case when hit and not gone then toxic else 0 end) as toxic_lost
  from met group by part, o, k, x)
select part, filter_order, step::int as step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
  unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
  (sum(removed) over (partition by part, x))::bigint as shapley
from audit"""
}
