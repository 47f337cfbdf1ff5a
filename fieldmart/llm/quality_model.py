"""Quality classifier: naive Bayes support vectors.

Indicators of a text's byte n-grams (``LENGTHS``, hashed to places) and of n-grams of
one repeated word, whatever the word, are scaled by the log ratio of their smoothed class counts, the scaled row is brought
to length one, and a linear hinge-loss model is fitted by dual coordinate descent:
each row's multiplier moves to its one-dimensional optimum inside [0, C of its class]
while the weight vector follows. Weights are mixed with their mean magnitude
(``BLEND``), as naive Bayes support vectors do. A logistic curve through the margins
of rows kept out of the fit turns a margin into a score.

The model is fitted on at most ``MOST_ROWS`` labelled training rows (documented
bound; chosen by hash of doc_id), and of these on as many in hash order as hold
``MOST_PLACES`` indicators in all, so the driver's memory is bounded; it collects
their place lists only. Every row is scored, in the tasks that read it; no shuffle.
Labels, language, source and doc_id are no inputs of a score.

Null or empty text: no indicators, scored by the intercept. Null doc_id: scored, held
out false (its hash is undefined), never trained on. Repeated rows: each is scored.
Labels without a document, null labels: ignored; of several labels of one doc_id the
highest counts. Without training rows of both kinds every score is the share of label
1 among them (0 without any). Very long texts: whole, in one step of the task. Empty
table: no rows. Extra columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmart.llm.common import strings_at, text_slices, word_spans

MOST_ROWS = 12_000
MOST_PLACES = 24_000_000
LENGTHS = (1, 2, 3)
DIMENSIONS = 1 << 18
#: Longest n-gram of a repeated word that has a place of its own.
ECHOES = 4
THRESHOLD = 0.3
SMOOTH = 1.0
BLEND = 0.25
COST = 1.0
TURNS = 40
#: Text bytes of one step: small, so that sorting its n-grams stays in the processor's cache.
STEP_BYTES = 1 << 18
#: One of so many training rows is kept for the logistic curve.
FOLDS = 5


def echoes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Keys (text * DIMENSIONS + place) of n-grams of equal words: each word that
    follows itself 1 to ``ECHOES`` times in a row has the last places."""
    starts, ends, first = word_spans(data, offsets)
    if len(starts) < 2:
        return np.zeros(0, np.int64)
    code = strings_at(data, starts, ends).dictionary_encode().indices.to_numpy()
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    same = np.concatenate([[False], (code[1:] == code[:-1]) & (text[1:] == text[:-1])])
    at = np.arange(len(code))
    run = at - np.maximum.accumulate(np.where(same, -1, at))
    hit = run > 0
    return text[hit] * DIMENSIONS + DIMENSIONS - np.minimum(run[hit], ECHOES)


def places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, ends): each text's distinct n-gram places, one text after the other."""
    n_texts = len(offsets) - 1
    text = np.repeat(np.arange(n_texts), np.diff(offsets))
    keys, code = [], np.zeros(len(data), np.uint64)
    for k in range(1, max(LENGTHS) + 1):
        n = max(0, len(data) - k + 1)
        code = code[:n] << np.uint64(8) | data[k - 1:].astype(np.uint64)[:n]
        if k in LENGTHS and n:
            inside = text[:n] == text[k - 1:]
            mixed = (code[inside] | np.uint64(k << 56)) * np.uint64(0x9E3779B97F4A7C15)
            keys.append(text[:n][inside] * DIMENSIONS + (mixed >> np.uint64(40)).astype(np.int64) % (DIMENSIONS - ECHOES))
    key = np.unique(np.concatenate([*keys, echoes(data, offsets)]))
    return key % DIMENSIONS, np.searchsorted(key, np.arange(1, n_texts + 1) * DIMENSIONS)


@dataclass
class Model:
    """weights: for each place its model weight times its ratio; scales: the squared
    ratio, of which a row's length is made. ``constant`` is the score without a model."""
    weights: np.ndarray | None
    scales: np.ndarray | None
    intercept: float
    slope: float
    offset: float
    constant: float


def segment_sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values)])
    return np.diff(total[np.concatenate([[0], ends])])


def margins(model: Model, at: np.ndarray, ends: np.ndarray) -> np.ndarray:
    length = np.sqrt(segment_sums(model.scales[at], ends))
    return segment_sums(model.weights[at], ends) / np.where(length > 0, length, 1.0) + model.intercept


def scores(model: Model, at: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if model.weights is None:
        return np.full(len(ends), model.constant)
    return 1 / (1 + np.exp(-np.clip(model.slope * margins(model, at, ends) + model.offset, -30, 30)))


def log_count_ratios(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """log of (share of the place in class 1) / (share in class 0), smoothed."""
    counts = [np.bincount(np.concatenate([r for r, c in zip(rows, y) if c == side]), minlength=DIMENSIONS) + SMOOTH for side in (1, 0)]
    return np.log(counts[0] / counts[0].sum()) - np.log(counts[1] / counts[1].sum())


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, cost: np.ndarray, turns: int = TURNS,
                            tolerance: float = 1e-3) -> tuple[np.ndarray, float]:
    """(weights, intercept) of min |w|^2 / 2 + sum cost_i max(0, 1 - y_i (w x_i + b)),
    the intercept as a weight of a constant feature. ``y`` is -1 or 1, rows have length
    one. Rows are visited in an order drawn anew each turn from a fixed seed."""
    w, b, alpha = np.zeros(DIMENSIONS), 0.0, np.zeros(len(rows))
    q = np.array([float(v @ v) + 1.0 for v in values])
    draw = np.random.default_rng(42)
    for _ in range(turns):
        worst = 0.0
        for i in draw.permutation(len(rows)):
            at, x = rows[i], values[i]
            gradient = y[i] * (w[at] @ x + b) - 1.0
            new = min(max(alpha[i] - gradient / q[i], 0.0), cost[i])
            step = (new - alpha[i]) * y[i]
            if step:
                worst = max(worst, abs(step))
                w[at] += step * x
                b += step
                alpha[i] = new
        if worst < tolerance:
            break
    return w, b


def logistic_curve(x: np.ndarray, y: np.ndarray, turns: int = 100) -> tuple[float, float]:
    """(slope, offset) of the likeliest logistic curve with a rising slope; the
    targets are drawn in by the class sizes, so separable margins stay finite."""
    n1, n0 = int(y.sum()), int((1 - y).sum())
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    v = np.array([1.0, 0.0])
    z = np.stack([x, np.ones(len(x))], 1)
    for _ in range(turns):
        p = 1 / (1 + np.exp(-np.clip(z @ v, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + 1e-6 * np.eye(2), z.T @ (p - t) + 1e-6 * v)
        v -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return max(float(v[0]), 1e-3), float(v[1])


def held_out() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")), F.lit(5)) == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, most: int = MOST_ROWS) -> DataFrame:
    """(text, quality, turn) of at most ``most`` labelled doc_ids that aren't held out.
    The drawn ids, a bounded table, are broadcast."""
    drawn = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
             .groupBy(F.col("doc_id").cast("long").alias("_id")).agg((F.max("quality") > 0).cast("int").alias("_quality"))
             .withColumn("_turn", F.xxhash64("_id", F.lit("quality"))).orderBy("_turn", "_id").limit(most))
    rows = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.join(F.broadcast(drawn), F.col("doc_id") == F.col("_id")).select("text", F.col("_quality").alias("quality"), F.col("_turn").alias("turn"))


def measured(rows: DataFrame) -> DataFrame:
    """``rows`` with their places as bytes instead of the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text_slices(batches, STEP_BYTES):
            at, ends = places(data, offsets)
            flat = at.astype(np.int32).tobytes()
            starts = np.concatenate([[0], ends[:-1]])
            lists = pa.array([flat[4 * a:4 * b] for a, b in zip(starts.tolist(), ends.tolist())], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("quality"), batch.column("turn"), pa.array(ends - starts), lists], names=["quality", "turn", "n", "places"])

    return rows.mapInArrow(run, "quality int, turn long, n long, places binary")


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_ROWS, most_places: int = MOST_PLACES) -> Model:
    found = measured(training_rows(docs, labels, most))
    # ids may repeat among the documents: as many rows in hash order as the bounds allow
    seen, held = [], 0
    for r in found.orderBy("turn", "n", "places").limit(most).toLocalIterator():
        held += r["n"]
        if seen and held > most_places:
            break
        seen.append(r)
    y = np.array([r["quality"] for r in seen], np.int64)
    if not len(y) or y.min() == y.max():
        return Model(None, None, 0.0, 1.0, 0.0, float(y.mean()) if len(y) else 0.0)
    at = [np.frombuffer(r["places"], np.int32) for r in seen]
    # every fifth row of each class is kept for the curve
    rank = np.zeros(len(y), np.int64)
    for side in (0, 1):
        rank[y == side] = np.arange((y == side).sum())
    curve = rank % FOLDS == FOLDS - 1
    train = np.flatnonzero(~curve)
    ratios = log_count_ratios([at[i] for i in train], y[train])
    values = {}
    for i in train:
        v = ratios[at[i]]
        values[i] = v / max(np.sqrt(v @ v), 1e-12)
    share = np.bincount(y[train], minlength=2)
    cost = COST * len(train) / (2.0 * share[y[train]])
    w, b = dual_coordinate_descent([at[i] for i in train], [values[i] for i in train], 2.0 * y[train] - 1.0, cost)
    used = np.bincount(np.concatenate([at[i] for i in train]), minlength=DIMENSIONS) > 0
    w = ((1 - BLEND) * np.abs(w[used]).mean() + BLEND * w) * used
    model = Model(w * ratios, ratios * ratios, b, 1.0, 0.0, 0.0)
    check = np.flatnonzero(curve) if len(set(y[curve])) == 2 else train
    x = margins(model, np.concatenate([at[i] for i in check]), np.cumsum([len(at[i]) for i in check]))
    model.slope, model.offset = logistic_curve(x, y[check])
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out and score of every row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text_slices(batches, STEP_BYTES):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores(model, *places(data, offsets)))], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double").select("doc_id", held_out().alias("held_out"), "score")


def quality_scores(docs: DataFrame, labels: DataFrame, most: int = MOST_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``."""
    return score(docs, fit(docs, labels, most)).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
