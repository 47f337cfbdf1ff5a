"""Toxicity by a weighted finite-state pattern grammar.

A text is read as clauses of word classes: insult (I), threat (H), target (T),
negation (N), report of speech (R) and other (o). Small transducers rewrite the
classes, some of their moves with a weight, and are composed into one machine
(weights multiply): negation turns an insult or threat that it precedes closely into
a denied one (i, h), and reported speech turns those that follow it into quoted ones
(q, k). The insult transducer reads on over the ends of clauses: a text's first plain
insult is lone (u), and one that follows another is piled up on it, with a weight that
falls from 1 in the same clause to ``FAR`` ``PASSAGE`` clauses later. The target transducer
tells at the end of a clause whether it names a person or group and gives an insult
after the name ``DIRECT`` times its weight; the threat transducer lets a threat count
only in a clause with a target.

What scores is a matched clause: one with a piled insult, one with any insult and a
target, or one with a plain threat and a target. Each scores its insults' weights
times those of the moves. A lone insult without a target scores nothing, so a text
with no more than that has the score of an empty one. The clause scores of a text
become a probability by a logistic model.

The insult classes' lexicon is learned: words and word beginnings of 3 to 8
letters that mark toxic rows among at most ``MOST_ROWS`` labelled training rows
(documented bound; chosen by hash of doc_id), with their log odds as weights. The
words' counts come from a distributed sum; lexicon (at most ``MOST_ENTRIES``) and
model are small. A training row is used for the lexicon or for the model, not
for both. Labels, language, source and doc_id are no inputs of a score.

Null or empty text: scored like a text without a match. Null doc_id: scored, held
out false (its hash is undefined), never trained on. Repeated rows: each is
scored. Labels without a document, null labels: ignored; of several labels of one
doc_id the highest counts. Without training rows of both kinds the score is 0.
Very long texts: whole, in one step of the task. Empty table: no rows. Extra columns
are ignored."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmart.llm.common import WORD, strings_at, text_slices, word_spans

MOST_ROWS = 20_000
MOST_ENTRIES = 20_000
LEAST_TOXIC = 3
LEAST_WEIGHT = 1.0
THRESHOLD = 0.3
PREFIXES = range(3, 9)
MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”‘’„…–—¿¡"

#: Word classes of the grammar (fixed values).
TARGETS = frozenset("you your yours yourself he him his she her they them their people everyone du dich dir dein deine ihr euch euer sie ihnen tu toi te ton ta vous votre ils elles "
                    "tú ti tus vosotros usted ustedes ellos ellas".split())
THREATS = frozenset("kill hurt destroy burn punch stab shoot hang beat töten umbringen schlagen verbrennen tuer frapper brûler détruire matar golpear quemar destruir".split())
NEGATIONS = frozenset("not never isn't aren't don't nobody nicht kein keine niemals ne jamais aucun nunca jamás ningún".split())
REPORTS = frozenset("said says say told called quoted wrote reported claimed sagte sagt nannte schrieb zitierte dit disait appelé cité dijo dice llamó escribió citó".split())
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, END = "oIHTNR|"
#: Words from a negation to what it denies.
REACH = 3
#: Clauses after which an insult piled up on another has its least weight, and that weight.
PASSAGE = 16
FAR = 0.5
#: The weight of an insult's move after a target in its clause.
DIRECT = 1.5
#: The words of a text, as :func:`word_spans` finds them.
WORDS = re.compile(WORD).findall


@dataclass(frozen=True)
class Transducer:
    """A weighted Mealy machine: moves from (state, symbol), where ``*`` is any other
    symbol, to the next state, the symbol written ("": the same) and the weight."""
    start: int
    moves: dict

    def step(self, state: int, symbol: str) -> tuple[int, str, float]:
        move = self.moves.get((state, symbol)) or self.moves.get((state, "*")) or (state, "", 1.0)
        return move[0], move[1] or symbol, move[2]

    def compose(self, other: Transducer, symbols: str) -> Transducer:
        """This machine followed by the other, as one machine over ``symbols``."""
        names, todo, moves = {(self.start, other.start): 0}, [(self.start, other.start)], {}
        while todo:
            pair = todo.pop()
            for symbol in symbols:
                a, middle, first = self.step(pair[0], symbol)
                b, out, then = other.step(pair[1], middle)
                if (a, b) not in names:
                    names[a, b] = len(names)
                    todo.append((a, b))
                moves[names[pair], symbol] = (names[a, b], out, first * then)
        return Transducer(0, moves)


def negation() -> Transducer:
    """A negation denies an insult or threat at most REACH words after it."""
    moves = {}
    for left in range(REACH + 1):
        moves[left, NEGATION], moves[left, END] = (REACH, "", 1.0), (0, "", 1.0)
        if left:
            moves[left, "*"] = (left - 1, "", 1.0)
            moves[left, INSULT], moves[left, THREAT] = (left - 1, "i", 1.0), (left - 1, "h", 1.0)
    return Transducer(0, moves)


def reported_speech() -> Transducer:
    """What follows a report in its clause is quoted."""
    moves = {(0, REPORT): (1, "", 1.0), (1, END): (0, "", 1.0)}
    moves |= {(1, s): (1, "q", 1.0) for s in (INSULT, "i")} | {(1, s): (1, "k", 1.0) for s in (THREAT, "h")}
    return Transducer(0, moves)


def insult() -> Transducer:
    """A text's first insult is lone (u), the others are piled up. The state falls with
    each clause that ends from PASSAGE + 1 to 1, the weight from 1 to FAR."""
    moves = {(0, INSULT): (PASSAGE + 1, "u", 1.0)}
    for near in range(PASSAGE + 1):
        moves[near + 1, INSULT], moves[near + 1, END] = (PASSAGE + 1, "", FAR + (1 - FAR) * near / PASSAGE), (max(near, 1), "", 1.0)
    return Transducer(0, moves)


def target() -> Transducer:
    """The end of a clause with a target is written as ! instead of |."""
    direct = {(1, s): (1, "", DIRECT) for s in (INSULT, "u", "i", "q")}
    return Transducer(0, {(0, TARGET): (1, "", 1.0), (1, END): (0, "!", 1.0)} | direct)


def threat() -> Transducer:
    """The end of a clause with a target and a plain threat is written as X."""
    return Transducer(0, {(0, THREAT): (1, "", 1.0), (1, "!"): (0, "X", 1.0), (1, END): (0, "", 1.0)})


def grammar() -> Transducer:
    symbols = OTHER + INSULT + THREAT + TARGET + NEGATION + REPORT + END
    out = negation()
    for part in (reported_speech(), insult(), target(), threat()):
        out = out.compose(part, symbols)
    return out


FEATURES = ("piled", "targeted", "denied", "quoted", "strongest", "threats", "matched", "density")


def clause_features(clauses: list[tuple[int, list[tuple[str, float]]]], machine: Transducer, n_words: int) -> list[float]:
    """Scores of a text's matched clauses. A clause is its number in the text and its
    (class, weight) pairs; clauses left out hold no insult and no threat."""
    piled = targeted = denied = quoted = strongest = total = 0.0
    threats = matched = 0
    state, before = machine.start, -1
    for number, clause in clauses:
        for _ in range(min(number - before - 1, PASSAGE + 1)):  # the ends of the clauses left out
            state, *_ = machine.step(state, END)
        before = number
        here: dict[str, list[float]] = {"I": [], "u": [], "i": [], "q": []}
        for symbol, weight in clause:
            state, out, times = machine.step(state, symbol)
            if out in here:
                here[out].append(weight * times)
        state, end, _ = machine.step(state, END)
        named = end != END
        counted = here["I"] + here["u"] if named else here["I"]
        piled += sum(here["I"])
        if named:
            targeted, denied, quoted = targeted + sum(counted), denied + sum(here["i"]), quoted + sum(here["q"])
        total, strongest = total + sum(counted), max([strongest, *counted])
        threats += end == "X"
        matched += bool(counted) or end == "X"
    return [math.log1p(piled), math.log1p(targeted), math.log1p(denied), math.log1p(quoted), strongest, float(threats), float(matched > 0),
            total / math.sqrt(max(n_words, 1))]


def bare(word: str) -> str:
    return word.lower().strip(MARKS)


def beginnings(word: str) -> list[str]:
    """The features of a word: itself (marked with $) and its beginnings."""
    return [word + "$", *[word[:k] for k in PREFIXES if len(word) >= k]] if len(word) >= PREFIXES[0] else []


def classed(word: str, lexicon: dict[str, float]) -> tuple[str, float]:
    """Class and weight of a bare word."""
    weight = max((lexicon.get(f, 0.0) for f in beginnings(word)), default=0.0)
    if weight > 0:
        return INSULT, weight
    for names, symbol in ((THREATS, THREAT), (TARGETS, TARGET), (NEGATIONS, NEGATION), (REPORTS, REPORT)):
        if word in names:
            return symbol, 0.0
    return OTHER, 0.0


def features(data: np.ndarray, offsets: np.ndarray, lexicon: dict[str, float], machine: Transducer) -> np.ndarray:
    """FEATURES of each text. Distinct words are classed once; only clauses with
    an insult or threat go through the machine, and the ends of those between."""
    starts, ends, first = word_spans(data, offsets)
    out = np.zeros((len(offsets) - 1, len(FEATURES)))
    if not len(starts):
        return out
    coded = strings_at(data, starts, ends).dictionary_encode()
    distinct = [w.decode() for w in coded.dictionary.to_pylist()]
    kinds = [classed(bare(w), lexicon) for w in distinct]
    code = coded.indices.to_numpy()
    matched = np.array([k[0] in (INSULT, THREAT) for k in kinds])[code]
    closes = np.array([w[-1] in ".,;:!?" for w in distinct])[code]
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    breaks = np.concatenate([[True], closes[:-1] | (doc[1:] != doc[:-1])])  # first words of clauses
    clause = np.cumsum(breaks) - 1
    begin = np.append(np.flatnonzero(breaks), len(doc))
    by_doc: dict[int, list] = {}
    for c in np.unique(clause[matched]).tolist():
        a, b = begin[c], begin[c + 1]
        by_doc.setdefault(int(doc[a]), []).append((c, [kinds[i] for i in code[a:b].tolist()]))
    sizes = np.diff(first)
    for d, clauses in by_doc.items():
        out[d] = clause_features(clauses, machine, int(sizes[d]))
    return out


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")), F.lit(4)) == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, most: int = MOST_ROWS) -> DataFrame:
    """(text, toxic, fold) of at most ``most`` labelled rows that aren't held
    out. The drawn ids, a bounded table, are broadcast."""
    drawn = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
             .withColumn("_hash", F.xxhash64("doc_id", F.lit("training"))).orderBy("_hash", "doc_id").limit(most))
    drawn = drawn.select(F.col("doc_id").alias("_id"), (F.col("toxic") > 0).cast("int").alias("toxic"), F.pmod("_hash", F.lit(10)).cast("int").alias("fold"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.join(F.broadcast(drawn), F.col("doc_id") == F.col("_id")).select("text", "toxic", "fold")


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """Weights of words and beginnings from the rows' texts (column toxic)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                seen[toxic].update({f for w in {bare(w) for w in WORDS(text)} for f in beginnings(w)})
                seen[toxic][""] += 1
        names = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *[pa.array([s[n] for n in names], pa.int64()) for s in seen]], names=["feature", "clean", "toxic"])

    counts = (rows.mapInArrow(count, "feature string, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
              .where((F.col("toxic") >= LEAST_TOXIC) & (F.col("toxic") * 2 > F.col("clean")) | (F.col("feature") == ""))
              .orderBy((F.col("feature") == "").desc(), (F.col("toxic") / (F.col("clean") + 1)).desc(), "feature").limit(MOST_ENTRIES).collect())
    total = next((c for c in counts if not c["feature"]), None)
    if total is None or not total["clean"] or not total["toxic"]:
        return {}
    out = {}
    for c in counts:
        if c["feature"]:
            weight = math.log((c["toxic"] + 0.1) / (total["toxic"] + 0.2)) - math.log((c["clean"] + 0.5) / (total["clean"] + 1.0))
            # a beginning seen in few rows may be chance
            weight -= 2.0 / math.sqrt(c["toxic"])
            if weight >= LEAST_WEIGHT:
                out[c["feature"]] = weight
    return out


def newton(x: np.ndarray, y: np.ndarray, ridge: float, turns: int) -> np.ndarray:
    """Weights (the last is the intercept) by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(turns):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, x.T @ (p - y) + penalty @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, turns: int = 30) -> np.ndarray:
    """Weights, the last the intercept, none but it below 0: a matched clause never
    lowers a score. The feature of the lowest weight below 0 goes and the rest is
    fitted again."""
    left = list(range(x.shape[1]))
    while True:
        w = newton(x[:, left], y, ridge, turns)
        if not left or w[:-1].min() >= 0:
            break
        del left[int(w[:-1].argmin())]
    out = np.zeros(x.shape[1] + 1)
    out[left + [x.shape[1]]] = w
    return out


@dataclass
class Model:
    lexicon: dict[str, float]
    weights: np.ndarray | None


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_ROWS) -> Model:
    """Lexicon from seven tenths of the training rows, logistic model from the rest."""
    rows = training_rows(docs, labels, most)
    lexicon, machine = learn_lexicon(rows.where("fold < 7")), grammar()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text_slices(batches):
            x = features(data, offsets, lexicon, machine)
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(x.tolist(), pa.list_(pa.float64()))], names=["toxic", "x"])

    seen = rows.where("fold >= 7").mapInArrow(measure, "toxic int, x array<double>").collect()  # at most `most` short rows
    y = np.array([r["toxic"] for r in seen], float)
    if not lexicon or not len(y) or y.min() == y.max():
        return Model(lexicon, None)
    return Model(lexicon, fit_logistic(np.array([r["x"] for r in seen]), y))


def probabilities(batches: Iterator[pa.RecordBatch], model: Model, machine: Transducer) -> Iterator[np.ndarray]:
    for batch, data, offsets in text_slices(batches):
        if model.weights is None:
            yield np.zeros(batch.num_rows)
        else:
            yield 1 / (1 + np.exp(-np.clip(features(data, offsets, model.lexicon, machine) @ model.weights[:-1] + model.weights[-1], -30, 30)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out and score of every row of ``docs``."""
    machine = grammar()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = list(probabilities(iter([batch]), model, machine))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(p) if p else np.zeros(0))], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double").select("doc_id", held_out().alias("held_out"), "score")


def toxicity(docs: DataFrame, labels: DataFrame, most: int = MOST_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``."""
    return score(docs, fit(docs, labels, most)).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, most: int = MOST_ROWS) -> DataFrame:
    """``docs`` (text a string column) without the rows predicted toxic."""
    model, machine = fit(docs, labels, most), grammar()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = list(probabilities(iter([batch]), model, machine))
            yield batch.filter(pa.array(np.concatenate(p) < THRESHOLD)) if p else batch

    return docs.mapInArrow(run, docs.schema)
