"""Toxicity by a weighted finite-state pattern grammar over clauses."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Container, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import durable, seeded, table
from lodestone.llm.logistic import fit_logistic, predict

#: Labelled rows that the model is fitted on, at most: those first in a seeded order.
TRAIN_ROWS = 8000
#: Parts of these rows, each of which is read with stems from the others when weights are learned.
FOLDS = 5
SEED = 17
#: A text is rejected from this score on.
THRESHOLD = 0.7
#: Lengths of the word beginnings that may become insult stems.
STEM = (3, 8)
#: Documents of the mean toxic share that are added to those of a stem, and the log-odds that it must then have.
SMOOTHING, LEAST_ODDS = 10.0, 1.3
#: The same for the weights of the stems that are taken.
WEIGHT_SMOOTHING = 0.5
#: Stems whose counts one task holds before it passes them on.
HELD_STEMS = 200_000
CACHED_WORDS = 600_000

# The closed classes of the grammar, in English, German, French and Spanish.
#: Whom a text speaks to, and others that it speaks of.
SECOND = frozenset("you yourself yourselves you'll du ihr tu toi vous usted ustedes vosotros".split())
PERSONS = frozenset("your yours he him her she they them people everyone sie er il elle ils eux ellos ella".split())
#: Pronouns that are objects wherever they stand, so also before a verb.
OBJECTS = frozenset("dich euch ihn te os".split())
POINTERS = frozenset("this that these those their".split())
#: Verbs that mean killing and little else, as they are used of what is to come, and as they are used of what is.
KILLING = frozenset("kill murder stab strangle töten töte umbringen ermorden erschießen erwürgen tuer tuerai assassiner étrangler matar mataré asesinar estrangular".split())
KILLS = frozenset("kills killing murders murdering stabs stabbing strangles strangling tötet ermordet erschießt tue tuons assassine étrangle mato mata matando asesina".split())
#: Verbs of harm with many harmless uses.
HARM = frozenset(
    "hurt destroy burn shoot beat hang crush smash punish break hurting destroying burning shooting beating hanging crushing smashing punishing verletzen schlagen schlage verbrennen zerstören"
    " blesser frapper frapperai brûler détruire herir golpear quemar destruir destrozar".split()
)
#: What says that something is to come.
FUTURE = frozenset("will gonna going shall i'll we'll he'll she'll they'll werde werden wird vais va vas allons voy va vamos van quiero want".split())
#: German verbs that threaten together with a particle at the end.
PARTED = frozenset("bringe bringt bringen bring mache macht machen mach schlage schlägt schlagt stech steche steckt".split())
PARTICLES = frozenset("um kalt fertig tot ab nieder kaputt".split())
NEGATIONS = frozenset("not no never nor without isn't aren't wasn't weren't don't doesn't didn't won't nicht kein keine nie ne pas jamais nunca jamás tampoco".split())
REPORTS = frozenset("said says say called calls wrote writes quoted quotes claimed claims reported reports alleged according sagte sagt schrieb dit disait écrit dijo dice escribió".split())
CLOSED = {"particle": PARTICLES, "parted": PARTED, "future": FUTURE, "harm": HARM, "kills": KILLS, "killing": KILLING, "second": SECOND, "person": PERSONS, "object": OBJECTS, "pointer": POINTERS, "negation": NEGATIONS, "report": REPORTS}
SYMBOL_OF = {word: symbol for symbol, words in CLOSED.items() for word in words}
#: The symbols that may begin a threat.
VERBS = ("parted", "harm", "kills", "killing")
THREATS = frozenset(word for word, symbol in SYMBOL_OF.items() if symbol in VERBS)
#: Tokens that a negation reaches, within which a verb's object follows it, and within which a verb follows an object.
NEGATION_REACH, VERB_REACH, OBJECT_REACH = 4, 2, 3
#: What a threat weighs: one that says it outright, and one that its context makes likely.
MENACES = {"menace": 1.0, "likely": 0.8}

WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
CLAUSE = re.compile(r"[.!?;:\n]+")
#: What the grammar reports of a document, in this order, and the weights that labels start from.
FEATURES = {"insults": 0.5, "targeted": 0.5, "threats": 8.0, "negated": -0.5, "reported": -0.5, "strongest": 0.5, "words": 0.0}

#: The tape that a clause is read as: a symbol for each word, then the end.
SYMBOLS = ("other", "insult", *CLOSED, "end")
Arcs = dict[tuple[int, str], tuple[int, str]]


def negation() -> Arcs:
    """A negation turns insults within its reach into denied ones, and threats into nothing."""
    arcs = {}
    for state in range(NEGATION_REACH + 1):
        for symbol in SYMBOLS:
            out = ({"insult": "denied"} | dict.fromkeys(VERBS, "other")).get(symbol, symbol) if state else symbol
            arcs[state, symbol] = (NEGATION_REACH if symbol == "negation" else max(0, state - 1), out)
    return arcs


def reported_speech() -> Arcs:
    """After a verb of speech, insults are reported ones, and threats nothing."""
    after = {"insult": "told", "denied": "told"} | dict.fromkeys(VERBS, "other")
    arcs = {(0, symbol): (int(symbol == "report"), symbol) for symbol in (*SYMBOLS, "denied")}
    return arcs | {(1, symbol): (1, after.get(symbol, symbol)) for symbol in (*SYMBOLS, "denied")}


def parted_threat() -> Arcs:
    """A parted verb, then an object, then a particle that makes it a threat: the particle comes out as a menace."""
    arcs = {}
    for state in (0, 1, 2):
        for symbol in (*SYMBOLS, "denied", "told"):
            ahead = 1 if symbol == "parted" else 2 if state == 1 and symbol in ("object", "second") else state
            arcs[state, symbol] = (0, "menace") if state == 2 and symbol == "particle" else (ahead, symbol)
    return arcs


def threat() -> Arcs:
    """A verb of harm close before a person, or close after an object, gives a threat in the place of the later word.

    Verbs of killing threaten any person; as they are used of what is, only the person spoken to. Other verbs of harm
    threaten only where something said before is to come. A state is the last verb and how far it still reaches, how far the
    last object does, and whether something is to come.
    """
    symbols = (*SYMBOLS, "denied", "told", "menace")
    start = (None, 0, 0, False)
    names, at, arcs = {start: 0}, [start], {}
    for verb, reach, thing, coming in at:
        for symbol in symbols:
            out, soon = symbol, coming or symbol == "future"
            now = (verb, reach - 1) if reach > 1 else (None, 0)
            ahead = (*now, max(0, thing - 1), soon)
            spoken_to = symbol in ("second", "object")
            if reach and verb == "killing" and (spoken_to or symbol == "person"):
                out = "menace" if spoken_to or coming else "likely"
            elif reach and verb == "kills" and spoken_to:
                out = "menace"
            elif reach and verb == "harm" and coming and (spoken_to or symbol == "person"):
                out = "likely"
            elif thing and (symbol in ("killing", "kills") or (symbol == "harm" and coming)):
                out = "menace" if symbol != "harm" else "likely"
            elif symbol in ("killing", "kills", "harm"):
                ahead = (symbol, VERB_REACH, max(0, thing - 1), soon)
            elif symbol == "object":
                ahead = (*now, OBJECT_REACH, soon)
            if out in MENACES and out != symbol:
                ahead = (None, 0, 0, soon)
            if ahead not in names:
                names[ahead] = len(at)
                at.append(ahead)
            arcs[names[verb, reach, thing, coming], symbol] = (names[ahead], out)
    return arcs


def target() -> Arcs:
    """The end of a clause says whether anyone was addressed in it."""
    addressed = ("second", "person", "object", "pointer", *MENACES)
    symbols = (*SYMBOLS, "denied", "told", *MENACES)
    return {(state, symbol): (int(state or symbol in addressed), "addressed" if state and symbol == "end" else symbol) for state in (0, 1) for symbol in symbols}


def composed(*machines: Arcs) -> list[dict[str, tuple[int, str]]]:
    """The one transducer that reads as these would, each reading what the one before it writes: arcs of each state.

    States are those tuples of states that can be reached from all zeros, which is the first.
    """
    start = (0,) * len(machines)
    names, table, at = {start: 0}, [], [start]
    for states in at:
        row = {}
        for symbol in SYMBOLS:
            ahead, out = [], symbol
            for machine, state in zip(machines, states, strict=True):
                state, out = machine[state, out]
                ahead.append(state)
            if tuple(ahead) not in names:
                names[tuple(ahead)] = len(at)
                at.append(tuple(ahead))
            row[symbol] = (names[tuple(ahead)], out)
        table.append(row)
    return table


#: Negation and reported speech change what the machines after them read.
CLAUSES = composed(negation(), reported_speech(), parted_threat(), threat(), target())


@dataclass
class Grammar:
    """The composed transducer CLAUSES with its weights: insult stems learned from labels, and a weight for each feature.

    A clause is read once, from left to right. Insults carry the weight of their stem, and come out as denied, as told,
    or as they are; the end of the clause says whether the latter were targeted. Threats come out with the weights of MENACES.
    """

    stems: dict[str, float]
    weights: list[float] = field(default_factory=list)
    #: Weights of stems that a text has once; a stem that is not here weighs the same as if it came often.
    single: dict[str, float] = field(default_factory=dict)
    #: What recent chunks of text and words were found to be.
    _chunks: dict[str, tuple[str, ...]] = field(default_factory=dict, repr=False)
    _words: dict[str, tuple[str, str | None]] = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return {"stems": self.stems, "weights": self.weights, "single": self.single, "_chunks": {}, "_words": {}}

    def _stem(self, word: str) -> str | None:
        stems = self.stems
        for n in range(STEM[0], min(STEM[1], len(word)) + 1):
            if word[:n] in stems:
                return word[:n]
        return None

    def symbol(self, word: str) -> tuple[str, str | None]:
        """The symbol of a lower-case word, and the insult stem that it begins with."""
        if (found := self._words.get(word)) is None:
            symbol = SYMBOL_OF.get(word)
            stem = self._stem(word) if symbol is None else None
            found = self._words[word] = symbol or ("other" if stem is None else "insult"), stem
        return found

    def _triggers(self, chunk: str) -> tuple[str, ...]:
        """The words of a chunk of text that may begin a match."""
        return tuple([w for w in WORD.findall(chunk) if w in THREATS or w not in SYMBOL_OF and self._stem(w)])

    def read(self, clause: list[str], once: Container[str] = ()) -> list[tuple[str, float]]:
        """Runs the transducer over the words of a clause; kinds and weights of what it matches."""
        state, found = 0, []
        for word in clause:
            symbol, stem = self.symbol(word)
            state, out = CLAUSES[state][symbol]
            if out in MENACES:
                found.append((out, MENACES[out]))
            elif out in ("insult", "denied", "told"):
                found.append((out, 1.0 if stem is None else self.single.get(stem, self.stems[stem]) if stem in once else self.stems[stem]))
        addressed = CLAUSES[state]["end"][1] == "addressed"
        kinds = {"insult": "targeted" if addressed else "insults", "denied": "negated", "told": "reported", **dict.fromkeys(MENACES, "threats")}
        return [(kinds[out], weight) for out, weight in found]

    def features(self, text: str | None) -> list[float]:
        """FEATURES of a whole text; zeros if no clause matches."""
        out = dict.fromkeys(FEATURES, 0.0)
        text = (text or "").lower()
        known = self._chunks
        if len(known) > CACHED_WORDS:
            known.clear()
            self._words.clear()
        chunks = set(text.split())
        for chunk in [c for c in chunks if c not in known]:
            known[chunk] = self._triggers(chunk)
        if triggers := set(chain.from_iterable(map(known.__getitem__, chunks))):
            clauses = [WORD.findall(c) for c in CLAUSE.split(text) if any(t in c for t in triggers)]
            times = Counter(stem for clause in clauses for word in clause if (stem := self.symbol(word)[1]))
            once = {stem for stem, n in times.items() if n == 1}
            out["words"] = len(text.split())
            for clause in clauses:
                if found := self.read(clause, once):
                    for kind, weight in found:
                        out[kind] += weight
                    out["strongest"] = max(out["strongest"], sum(w for kind, w in found if kind in ("insults", "targeted", "threats")))
        return [math.log1p(out[k]) for k in FEATURES]

    def scores(self, texts: pd.Series) -> np.ndarray:
        x = np.array([self.features(t) for t in texts], dtype=float).reshape(-1, len(FEATURES))
        return predict(np.asarray(self.weights), x)


def _held_out(doc_id: str) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, seed: int = SEED) -> DataFrame:
    """text, toxic (0 or 1) and fold (below FOLDS) of at most `rows` labelled documents that are not held out."""
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~_held_out("doc_id")).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = usable.orderBy(seeded(seed, "doc_id"), "doc_id").limit(rows)  # bounded, so it may be broadcast
    fold = F.crc32(seeded(seed + 1, "doc_id").cast("binary")) % FOLDS
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", F.col("toxic").cast("double").alias("toxic"), fold.cast("int").alias("fold"))


def stem_counts(train: DataFrame) -> DataFrame:
    """fold, stem, and of the documents with it one time (once) and more times (more): toxic ones and all.

    Words of the closed classes have no stems.
    """
    closed = frozenset().union(*CLOSED.values())
    low, high = STEM

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["fold", "stem", "once_toxic", "once", "more_toxic", "more"]
        held: dict[tuple[int, str], list[float]] = {}
        for batch in batches:
            for text, toxic, fold in zip(batch["text"], batch["toxic"], batch["fold"], strict=True):
                times: Counter[str] = Counter()
                for word, n in Counter(WORD.findall((text or "").lower())).items():
                    if word not in closed:
                        for k in range(low, min(high, len(word)) + 1):
                            times[word[:k]] += n
                for stem, n in times.items():
                    row = held.setdefault((fold, stem), [0.0] * 4)
                    at = 2 if n > 1 else 0
                    row[at] += toxic
                    row[at + 1] += 1
                if len(held) > HELD_STEMS:
                    yield pd.DataFrame([(*k, *row) for k, row in held.items()], columns=columns)
                    held.clear()
        yield pd.DataFrame([(*k, *row) for k, row in held.items()], columns=columns)

    counts = train.mapInPandas(count, "fold int, stem string, once_toxic double, once double, more_toxic double, more double")
    return counts.groupBy("fold", "stem").agg(*[F.sum(c).alias(c) for c in counts.columns[2:]])


def chosen_stems(counts: DataFrame, toxic: float, rows: int) -> tuple[dict[str, float], dict[str, float]]:
    """Stems by their counts among `rows` documents of which `toxic` are toxic, as `learn_stems` has them."""
    if not 0 < toxic < rows:
        return {}, {}
    share = toxic / rows

    def odds(a, n, smoothing=SMOOTHING):
        p = (a + smoothing * share) / (n + smoothing)
        return F.log(p / (1 - p)) - math.log(share / (1 - share))

    a1, n1, a2, n2 = (F.col(c) for c in ("once_toxic", "once", "more_toxic", "more"))
    found = counts.select("stem", F.greatest(odds(a1 + a2, n1 + n2), odds(a2, n2)).alias("odds"), odds(a1, n1, WEIGHT_SMOOTHING).alias("single"), odds(a2, n2, WEIGHT_SMOOTHING).alias("often"))
    found = found.filter(F.col("odds") >= LEAST_ODDS).collect()  # bounded by the training rows
    often: dict[str, float] = {}
    single: dict[str, float] = {}
    shorter: set[str] = set()
    for r in sorted(found, key=lambda r: (-round(r["odds"], 6), -len(r["stem"]), r["stem"])):
        beginnings = [r["stem"][:k] for k in range(STEM[0], len(r["stem"]))]
        if r["stem"] not in shorter and not any(b in often for b in beginnings):
            single[r["stem"]] = max(0.0, r["single"])
            often[r["stem"]] = max(single[r["stem"]], r["often"])
            shorter.update(beginnings)
    return often, single


def learn_stems(train: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    """Beginnings of words that come with toxic documents: their weights in texts that have them often, and once.

    Weights are smoothed log-odds against the mean. With SMOOTHING, a stem is taken if it reaches LEAST_ODDS where
    it occurs, or where it occurs more than once. Of nested stems the one with the
    highest odds is taken, and the longest of those, so a family of words is not split.
    """
    toxic, rows = train.agg(F.coalesce(F.sum("toxic"), F.lit(0.0)), F.count(F.lit(1))).first()
    return chosen_stems(stem_counts(train.select("text", "toxic", F.lit(0).alias("fold"))), toxic, rows)


def train_grammar(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, seed: int = SEED) -> Grammar:
    """Learns the stems from bounded rows, and the weights of FEATURES from the same rows, read with other stems.

    Rows are in FOLDS folds; for the weights, each is read with stems learned from the others alone. A weight starts
    from its value in FEATURES, so what the labels never show keeps that. Without usable labels, or with one class
    only, no stems are found, and every text without a threat gets the share of toxic labels, or 0.5 without any.
    """
    train = durable(training_rows(docs, labels, rows, seed))
    counts = durable(stem_counts(train))
    sums = {r["fold"]: (r["toxic"], r["n"]) for r in train.groupBy("fold").agg(F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("n")).collect()}
    toxic, n = (sum(s[i] for s in sums.values()) for i in (0, 1))

    def stems_without(fold: int | None) -> Grammar:
        a, rows = sums.get(fold, (0.0, 0))
        kept = counts if fold is None else counts.filter(F.col("fold") != fold)
        often, single = chosen_stems(kept.groupBy("stem").agg(*[F.sum(c).alias(c) for c in counts.columns[2:]]), toxic - a, n - rows)
        return Grammar(often, single=single)

    grammar, others = stems_without(None), [stems_without(fold) for fold in range(FOLDS)]

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"x": [others[f].features(t) for t, f in zip(batch["text"], batch["fold"], strict=True)], "y": batch["toxic"]})

    found = train.mapInPandas(features, "x array<double>, y double").collect()  # at most `rows`
    x = np.array([r["x"] for r in found], dtype=float).reshape(-1, len(FEATURES))
    y = np.array([r["y"] for r in found], dtype=float)
    grammar.weights = fit_logistic(x, y, prior=np.array(list(FEATURES.values()))).tolist()
    return grammar


def toxicity(grammar: Grammar):
    """A column function: the score of a text, from 0 to 1."""

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(grammar.scores(batch))

    return score


def toxicity_scores(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, seed: int = SEED, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of each row, learned from labels that are not held out.

    Only the text makes a score; very long texts are read whole. Null, empty and unmatched texts get the score of a text without any match. Null
    ids count as held out: never. Repeated rows are kept. An empty table gives an empty result. Columns other than
    doc_id and text are not read.
    """
    score = toxicity(train_grammar(docs, labels, rows, seed))
    scored = docs.select("doc_id", F.coalesce(_held_out("doc_id"), F.lit(False)).alias("held_out"), score("text").alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def without_toxic(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, seed: int = SEED, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` below the threshold, with all their columns; nothing is shuffled but the training rows.

    Null and empty texts and null ids are as in `toxicity_scores`; an empty table gives an empty result.
    """
    return docs.filter(toxicity(train_grammar(docs, labels, rows, seed))("text") < threshold)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op8_toxicity": query}
ORACLES: dict[str, str] = {}
