"""Token counts of a unigram tokenizer without its tokens: best score and piece count by dynamic programming."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import table
from lodestone.llm.packing import text_batches

#: How much worse than the worst piece an unknown character is.
UNKNOWN_PENALTY = 10.0
#: Words whose counts a Python worker holds at once.
CACHED_WORDS = 400_000
SPACE = "▁"


def vocabulary_path() -> str:
    """The production vocabulary: a file of pieces with scores, used here as a unigram model."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """Its ordinary pieces and their scores; bytes and control symbols are not matched in texts."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    return [(model.id_to_piece(i), model.get_score(i)) for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]


class Matches:
    """An Aho-Corasick automaton over the pieces; `found` lists those that end at a state, longest first."""

    def __init__(self, pieces: dict[str, float]) -> None:
        self.next: list[dict[str, int]] = [{}]
        ends: list[float | None] = [None]
        for piece, score in pieces.items():
            state = 0
            for c in piece:
                state = self.next[state].setdefault(c, len(ends))
                if state == len(ends):
                    self.next.append({})
                    ends.append(None)
            ends[state] = score
        self.fail, self.found = [0] * len(ends), [()] * len(ends)
        level, depth = [0], 0
        while level:
            below = []
            for state in level:
                own = () if ends[state] is None else ((depth, ends[state]),)
                self.found[state] = own + (self.found[self.fail[state]] if state else ())
                for c, child in self.next[state].items():
                    self.fail[child] = self.step(self.fail[state], c) if state else 0
                    below.append(child)
            level, depth = below, depth + 1
        self.known: list[dict[str, int]] = [{} for _ in ends]

    def step(self, state: int, c: str) -> int:
        while (to := self.next[state].get(c)) is None and state:
            state = self.fail[state]
        return to or 0


class UnigramCounter:
    """(pieces, score) of the best segmentation of a text.

    Scores are summed in double precision from left to right. Of equally good segmentations that end at a
    character, the one whose last piece starts first stays. A character that is no piece by itself may be
    passed as unknown, UNKNOWN_PENALTY below the worst score; it counts as its UTF-8 bytes. A space is
    written as U+2581, and one is put before the text. Where no piece goes on after a word's end, texts are
    counted word by word, which gives the same result, and the counts of recent words are kept. New words
    are taken in order, so that each goes on from the prefix that it shares with the one before.
    """

    def __init__(self, vocabulary: list[tuple[str, float]]) -> None:
        self.matches = Matches(dict(vocabulary))
        self.single = {p for p, _ in vocabulary if len(p) == 1}
        self.unknown = min(s for _, s in vocabulary) - UNKNOWN_PENALTY
        self.by_word = not any(SPACE in p.lstrip(SPACE) or "\n" in p for p, _ in vocabulary)
        self.counts: dict[str, int] = {}
        self.scores: dict[str, float] = {}

    def best(self, texts: list[str]) -> Iterator[tuple[str, int, float]]:
        """Text, pieces and score for each of `texts`, sorted, in which spaces are already U+2581."""
        found, known, step, single, unknown = self.matches.found, self.matches.known, self.matches.step, self.single, self.unknown
        scores, counts, states, last = [0.0], [0], [0], ""
        for text in texts:
            start, most = 0, min(len(last), len(text))
            while start < most and last[start] == text[start]:
                start += 1
            del scores[start + 1 :], counts[start + 1 :], states[start + 1 :]
            state = states[start]
            for end in range(start + 1, len(text) + 1):
                c = text[end - 1]
                to = known[state].get(c)
                if to is None:
                    to = known[state][c] = step(state, c)
                state, best, count = to, None, 0
                for length, score in found[state]:
                    score += scores[end - length]
                    if best is None or score > best:
                        best, count = score, counts[end - length] + 1
                if c not in single:
                    score = unknown + scores[end - 1]
                    if best is None or score > best:
                        best, count = score, counts[end - 1] + len(c.encode("utf-8", "surrogatepass"))
                scores.append(best)
                counts.append(count)
                states.append(state)
            last = text
            yield text, counts[-1], scores[-1]

    def _learn(self, words: set[str]) -> None:
        for word, count, score in self.best(sorted(words)):
            self.counts[word], self.scores[word] = count, score

    def all(self, texts: list[str | None]) -> Iterator[tuple[int, float]]:
        """For each text; null and empty ones have no pieces."""
        marked = [SPACE + x.replace(" ", SPACE) if x else "" for x in texts]
        if not self.by_word:
            for x in marked:
                yield from (y[1:] for y in self.best([x]))
            return
        if len(self.counts) > CACHED_WORDS:
            self.counts.clear()
            self.scores.clear()
        split = [_SEGMENT.findall(x) for x in marked]
        new: set[str] = set()
        for words in split:
            new.update(words)
        self._learn(new - self.counts.keys())
        for words in split:
            yield sum(map(self.counts.__getitem__, words)), sum(map(self.scores.__getitem__, words))

_SEGMENT = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")

_LOADED: dict[str, UnigramCounter] = {}


def _counter(path: str) -> UnigramCounter:
    """One for each worker process and vocabulary."""
    if path not in _LOADED:
        _LOADED[path] = UnigramCounter(read_vocabulary(path))
    return _LOADED[path]


def token_counts(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens and score for each row, in the order of the rows; nothing is shuffled.

    Null and empty texts have 0 tokens and score 0; very long texts are counted whole, in memory proportional to their
    length; ties are as in `UnigramCounter`. Null ids and repeated rows are kept as they are. An
    empty table gives an empty result. Other columns are not read.
    """
    path = path or vocabulary_path()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch in text_batches(batches):
            found = list(counter.all(batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([c for c, _ in found], pa.int64()), pa.array([float(s) for _, s in found], pa.float64())], ["doc_id", "n_tokens", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(count, "doc_id long, n_tokens long, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


QUERIES = {"op6_token_counts": query}
ORACLES: dict[str, str] = {}
