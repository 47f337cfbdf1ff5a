"""The model's parts against plain Python, and accuracy on rows it never saw."""

import math
import zlib

import numpy as np
import pytest

from fieldmart.llm import quality_model as qm
from fieldmart.llm.common import table

LABELLED = "/root/testdata/sf0.1"


def as_data(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])


def slow_places(text):
    raw, out = text.encode(), set()
    for k in qm.LENGTHS:
        for i in range(len(raw) - k + 1):
            code = int.from_bytes(raw[i:i + k], "big") | k << 56
            out.add((code * 0x9E3779B97F4A7C15 % 2 ** 64 >> 40) % (qm.DIMENSIONS - qm.ECHOES))
    words, run = text.split(), 0
    for a, b in zip(words, words[1:]):
        run = run + 1 if a == b else 0
        if run:
            out.add(qm.DIMENSIONS - min(run, qm.ECHOES))
    return sorted(out)


def test_places_match_plain_python():
    texts = ["", "a", "ab", "aaa aaa", "x x x x x x x", "x x", "The the", "Größe über é", "a|b | c!!", "", "the end"]
    at, ends = qm.places(*as_data(texts))
    got = [part.tolist() for part in np.split(at, ends)[:-1]]
    assert got == [slow_places(t) for t in texts]


def test_ratios_and_margins():
    rows = [np.array([1, 2]), np.array([2, 3]), np.array([3])]
    r = qm.log_count_ratios(rows, np.array([1, 1, 0]))
    ones, zeros = {1: 1, 2: 2, 3: 1}, {3: 1}
    total = [qm.SMOOTH * qm.DIMENSIONS + sum(c.values()) for c in (ones, zeros)]
    for place in (1, 2, 3, 4):
        assert r[place] == pytest.approx(math.log((ones.get(place, 0) + qm.SMOOTH) / total[0]) - math.log((zeros.get(place, 0) + qm.SMOOTH) / total[1]))
    model = qm.Model(np.arange(qm.DIMENSIONS, dtype=float), np.ones(qm.DIMENSIONS), 0.5, 1.0, 0.0, 0.0)
    assert qm.margins(model, np.array([3, 5]), np.array([2, 2])).tolist() == pytest.approx([8 / math.sqrt(2) + 0.5, 0.5])


def test_dual_coordinate_descent_reaches_the_optimum():
    """No gap is left between the hinge-loss objective and its dual."""
    draw = np.random.default_rng(1)
    rows = [np.sort(draw.choice(40, 6, replace=False)) for _ in range(80)]
    values = [draw.normal(size=6) for _ in rows]
    y = np.where(draw.random(80) < 0.3, 1.0, -1.0)
    cost = np.where(y > 0, 2.0, 0.7)
    w, b = qm.dual_coordinate_descent(rows, values, y, cost, turns=4000, tolerance=1e-9)
    hinge = np.array([max(0.0, 1 - s * (w[r] @ v + b)) for r, v, s in zip(rows, values, y)])
    primal = (w @ w + b * b) / 2 + cost @ hinge
    # alpha from the optimality of w: w = sum alpha y x, found again by least squares inside the box
    x = np.zeros((80, 41))
    for i, (r, v) in enumerate(zip(rows, values)):
        x[i, r], x[i, 40] = v, 1.0
    z = y[:, None] * x
    alpha = np.zeros(80)
    for _ in range(3000):
        for i in range(80):
            alpha[i] = min(max(alpha[i] - (z[i] @ (z.T @ alpha) - 1) / (z[i] @ z[i]), 0), cost[i])
    dual = alpha.sum() - np.sum((z.T @ alpha) ** 2) / 2
    assert primal == pytest.approx(dual, rel=1e-6)


def test_held_out_rows_and_accuracy(spark):
    docs, labels = table(spark, LABELLED, "documents"), table(spark, LABELLED, "labels")
    got = {r["doc_id"]: r for r in qm.quality_scores(docs, labels).collect()}
    assert len(got) == docs.count()
    seen = [(got[r["doc_id"]], r["quality"]) for r in labels.collect() if r["doc_id"] in got]
    for row in got.values():
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0)
        assert 0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.3)
    unseen = [(r, q) for r, q in seen if r["held_out"]]
    assert np.mean([r["predicted"] == q for r, q in unseen]) > 0.98
    assert np.mean([r["predicted"] for r, q in unseen if q == 1]) > 0.97


def test_labels_of_held_out_rows_are_not_read(spark, docs_of):
    """Turning all labels of held-out rows round changes no score."""
    rows = [(i, ("good words here " if i % 3 else "bad ### $$$ ") * (1 + i % 4)) for i in range(90)]
    docs = docs_of(rows)
    out = []
    for turned in (False, True):
        labels = [(i, int(i % 3 != 0) if zlib.crc32(str(i).encode()) % 5 or not turned else int(i % 3 == 0)) for i, _ in rows]
        out.append(sorted((r["doc_id"], r["score"]) for r in qm.quality_scores(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()))
    assert out[0] == out[1]
    assert all((s >= 0.3) == bool(i % 3) for i, s in out[0])


def test_odd_rows_and_missing_labels(spark, docs_of, odd_rows):
    docs = docs_of(odd_rows, extra=["quality", "turn", "_id", "_quality", "places", "score", "held_out"])
    labels = spark.createDataFrame([(r[0], k % 2, 0) for k, r in enumerate(odd_rows)] + [(None, 1, 0), (9999, 1, 1), (odd_rows[3][0], None, None)], "doc_id long, quality int, toxic int")
    got = qm.quality_scores(docs, labels).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in odd_rows)
    assert all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in got)
    same = {}
    for r, (_, t, *_) in zip(sorted(got, key=lambda r: str(r["doc_id"])), sorted(odd_rows, key=lambda r: str(r[0]))):
        same.setdefault(t, []).append(r["score"]) if t in (None, "") else None
    assert len({s for v in same.values() for s in v}) <= 1
    none = qm.quality_scores(docs, labels.where("false")).collect()
    assert {r["score"] for r in none} == {0.0}
    one = qm.quality_scores(docs, labels.where("quality = 1")).collect()
    assert {r["score"] for r in one} == {1.0}
    assert qm.quality_scores(docs.where("false"), labels).collect() == []


def test_bounds_of_the_sample(spark, docs_of):
    docs = docs_of([(i, f"word{i} more") for i in range(60)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    assert qm.training_rows(docs, labels, most=7).count() == 7
    model = qm.fit(docs, labels, most=50, most_places=100)   # a handful of rows
    assert model.weights is None or np.isfinite(model.weights).all()
