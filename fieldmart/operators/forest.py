"""Random-forest classifier on cells.

A forest with bins reads a row's features only through their bins (at most ``MAX_BINS``
a feature, as in Spark ML), and rows of one cell -- the same bins, label and weight --
go the same way in every tree. Here the rows are counted by cell once, which is the only
pass over them; then each task grows whole trees on the cells, so the time for growing
depends on the cells and not on the rows. A cell of ``n`` rows is drawn Poisson(``n``)
times for a tree, which is how often all of its rows together are drawn where each is
drawn Poisson(1) times, as Spark ML does.

Each node looks at ``ceil(sqrt(features))`` random features and takes the split with the
largest gain (weighted Gini) that leaves ``min_leaf`` drawn rows on both sides; siblings
that predict one class are merged, as in Spark ML. The trees are written in the format of
Spark ML's own saved forests and read as its model. Cells are sorted and every tree has a
seed of its own, so with the same bins the forest doesn't depend on the number of tasks
(the bins' quantiles do, within their rank error, as Spark ML's sampled ones do)."""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmart.session import materialize, scratch_path

MAX_BINS = 32
#: Cells that a task (some 60 bytes each) and, once, the driver hold at most. Where the
#: rows fall into more of them, callers leave the forest to Spark ML.
MOST_CELLS = 1 << 22
#: Nodes of a level, and cells, whose bins are added up at once.
BLOCK, CHUNK = 1 << 13, 1 << 18
#: A gain or an impurity below this is rounding.
TINY = 1e-12

NODE = ("treeID int, id int, prediction double, impurity double, impurityStats array<double>, rawCount long, gain double, "
        "leftChild int, rightChild int, feature int, threshold double")


def thresholds(df: DataFrame, features: Sequence[str]) -> list[list[float]]:
    """The bins' lower ends, but for the first bin's, for each feature: every value of a
    feature that has at most ``MAX_BINS``, else quantiles (rank error 0.001)."""
    values = df.select(*[F.col(c).cast("double").alias(c) for c in features])
    few = values.agg(*[F.approx_count_distinct(c).alias(c) for c in features]).first()
    out = {}
    for c in features:
        own = [r[0] for r in values.select(c).where(F.col(c).isNotNull()).distinct().collect()] if few[c] <= 2 * MAX_BINS else []
        if 0 < len(own) <= MAX_BINS:
            out[c] = sorted(own)[1:]
    many = [c for c in dict.fromkeys(features) if c not in out]
    found = values.approxQuantile(many, [i / MAX_BINS for i in range(1, MAX_BINS)], 0.001) if many else []
    out |= {c: sorted(set(ends)) for c, ends in zip(many, found, strict=True)}
    return [out[c] for c in features]


def bucketizer(df: DataFrame, features: Sequence[str]) -> Bucketizer:
    """Numbers the bins of the features (``_bin0``, ...); NaN is an error."""
    ends = [[-math.inf, *[x for x in t if math.isfinite(x)], math.inf] for t in thresholds(df, features)]
    ends = [[e[0], 0.0, e[-1]] if len(e) < 3 else e for e in ends]     # a bucketizer wants two buckets
    return Bucketizer(inputCols=list(features), outputCols=[f"_bin{i}" for i in range(len(features))], splitsArray=ends, handleInvalid="error")


def count_cells(df: DataFrame, buckets: Bucketizer, label: str, weight: str | None) -> DataFrame:
    """The cells of the rows with the number of their rows, as a written table."""
    rows = buckets.transform(df.select(*[F.col(c).cast("double").alias(c) for c in buckets.getInputCols()], F.col(label).cast("double").alias("_label"),
                                       (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("_weight")))
    bins = [F.col(c).cast("byte").alias(c) for c in buckets.getOutputCols()]
    return materialize(rows.groupBy(*bins, "_label", "_weight").agg(F.count(F.lit(1)).alias("_rows")), "forest-cells")


def gathered(cells: DataFrame, buckets: Bucketizer) -> dict[str, np.ndarray]:
    """The cells in one order, whatever tasks they came from. A missing feature, label or
    weight is an error, as in Spark ML."""
    names = [*buckets.getOutputCols(), "_label", "_weight", "_rows"]
    table = cells.select(*names).toArrow()
    columns = [table.column(c).combine_chunks() for c in names]
    if any(c.null_count for c in columns):
        raise ValueError("a feature, label or weight is missing")
    *bins, label, weight, rows = [c.to_numpy(zero_copy_only=False) for c in columns]
    if not (np.isfinite(weight).all() and (weight >= 0).all()):
        raise ValueError("weights must be finite and not negative")
    if not ((label >= 0) & (label == np.floor(label)) & (label < 100)).all():
        raise ValueError("labels must be whole numbers from 0 to 99")
    order = np.lexsort((weight, label, *bins[::-1]))
    return {"bins": np.stack(bins, axis=1).astype(np.uint8)[order], "label": label.astype(np.uint8)[order], "weight": weight[order], "rows": rows[order]}


def gini(stats: np.ndarray) -> np.ndarray:
    """Of weights by class, along the last axis; 0 where there are none."""
    total = stats.sum(axis=-1)
    return np.where(total > 0, 1 - np.square(stats).sum(axis=-1) / np.square(np.where(total > 0, total, 1)), 0.0)


def best_splits(bins: np.ndarray, node: np.ndarray, label: np.ndarray, weight: np.ndarray, drawn: np.ndarray, stats: np.ndarray, raw: np.ndarray,
                own: np.ndarray, n_bins: int, min_leaf: int) -> tuple[np.ndarray, ...]:
    """For each node (``stats``: weight by class, ``raw``: drawn rows, ``own``: its
    features) the best split's gain, feature, last left bin, and the left side's weight by
    class and drawn rows. The first five arguments are the cells."""
    nodes, classes = stats.shape
    gains = np.full(nodes, -1.0)
    feature, bin_, left_stats, left_raw = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64), np.zeros_like(stats), np.zeros(nodes)
    whole, impurity = stats.sum(axis=1), gini(stats)
    for j in range(own.shape[1]):
        left, count = np.zeros(nodes * n_bins * classes), np.zeros(nodes * n_bins)
        for a in range(0, len(node), CHUNK):
            c = slice(a, a + CHUNK)
            key = node[c] * n_bins + np.take_along_axis(bins[c], own[node[c], j, None], axis=1)[:, 0]
            left += np.bincount(key * classes + label[c], weights=weight[c], minlength=len(left))
            count += np.bincount(key, weights=drawn[c], minlength=len(count))
        left, count = left.reshape(nodes, n_bins, classes).cumsum(axis=1)[:, :-1], count.reshape(nodes, n_bins).cumsum(axis=1)[:, :-1]
        right = np.maximum(stats[:, None, :] - left, 0.0)
        share = left.sum(axis=2) / whole[:, None]
        gain = impurity[:, None] - share * gini(left) - (1 - share) * gini(right)
        gain[(count < min_leaf) | (raw[:, None] - count < min_leaf)] = -1.0
        s = gain.argmax(axis=1)
        every = np.arange(nodes)
        better = gain[every, s] > gains
        pick = every[better], s[better]
        gains[better], feature[better], bin_[better], left_stats[better], left_raw[better] = gain[pick], own[better, j], s[better], left[pick], count[pick]
    return gains, feature, bin_, left_stats, left_raw


def grow(cells: dict[str, np.ndarray], seed: Sequence[int], classes: int, n_bins: int, min_leaf: int, max_depth: int) -> dict[str, np.ndarray]:
    """One tree: a row for every node, parents before children, the root first."""
    rng = np.random.default_rng(seed)
    drawn = rng.poisson(cells["rows"])
    kept = np.flatnonzero(drawn)
    bins, label, drawn = cells["bins"][kept], cells["label"][kept], drawn[kept]
    weight = drawn * cells["weight"][kept]
    features = bins.shape[1]
    some = min(features, math.ceil(math.sqrt(features)))
    stats, raw = np.bincount(label, weights=weight, minlength=classes)[None, :], np.array([float(drawn.sum())])
    levels, first = [], 0
    node = np.zeros(len(kept), np.int64)    # of each cell, its node among those of the level
    for depth in range(max_depth + 1):
        n = len(stats)
        level = {"stats": stats, "raw": raw, "gain": np.full(n, -1.0), "left": np.full(n, -1), "feature": np.full(n, -1), "bin": np.zeros(n, np.int64)}
        levels.append(level)
        open_ = (gini(stats) > TINY) & (raw >= 2 * min_leaf) & (depth < max_depth)
        if not open_.any():
            break
        # cells of open nodes, in the order of their nodes
        place = np.where(open_, np.cumsum(open_) - 1, -1)
        node = place[node]
        order = np.argsort(node, kind="stable")
        order = order[np.searchsorted(node[order], 0):]
        node, bins, label, weight, drawn = node[order], bins[order], label[order], weight[order], drawn[order]
        which = np.flatnonzero(open_)
        own = rng.random((len(which), features)).argsort(axis=1)[:, :some]
        found = []
        for lo in range(0, len(which), BLOCK):
            hi = min(lo + BLOCK, len(which))
            a, b = np.searchsorted(node, [lo, hi])
            found.append(best_splits(bins[a:b], node[a:b] - lo, label[a:b], weight[a:b], drawn[a:b],
                                     stats[which[lo:hi]], raw[which[lo:hi]], own[lo:hi], n_bins, min_leaf))
        gain, feature, bin_, left_stats, left_raw = (np.concatenate(x) for x in zip(*found, strict=True))
        split = gain > TINY
        if not split.any():
            break
        done = which[split]
        level["gain"][done], level["feature"][done], level["bin"][done] = gain[split], feature[split], bin_[split]
        level["left"][done] = first + n + 2 * np.arange(len(done))
        child = np.where(split, 2 * (np.cumsum(split) - 1), -1)
        stay = split[node]
        node, bins, label, weight, drawn = node[stay], bins[stay], label[stay], weight[stay], drawn[stay]
        node = child[node] + (np.take_along_axis(bins, feature[node, None], axis=1)[:, 0] > bin_[node])
        stats = np.stack([left_stats[split], np.maximum(stats[done] - left_stats[split], 0.0)], axis=1).reshape(-1, classes)
        raw = np.stack([left_raw[split], raw[done] - left_raw[split]], axis=1).reshape(-1)
        first += n
    return pruned({k: np.concatenate([x[k] for x in levels]) for k in levels[0]}, np.cumsum([0, *[len(x["raw"]) for x in levels]]))


def pruned(tree: dict[str, np.ndarray], starts: np.ndarray) -> dict[str, np.ndarray]:
    """Two leaves of one parent that predict the same class become one, from the bottom
    up; the nodes that stay are numbered anew. ``starts``: the levels' first nodes."""
    left, told = tree["left"].copy(), tree["stats"].argmax(axis=1)
    for a, b in list(zip(starts, starts[1:]))[::-1]:
        inner = a + np.flatnonzero(left[a:b] >= 0)
        l = left[inner]
        left[inner[(left[l] < 0) & (left[l + 1] < 0) & (told[l] == told[l + 1])]] = -1
    seen = np.zeros(len(left), bool)
    seen[0] = True
    for a, b in zip(starts, starts[1:]):
        inner = a + np.flatnonzero(seen[a:b] & (left[a:b] >= 0))
        seen[left[inner]] = seen[left[inner] + 1] = True
    number = np.cumsum(seen) - 1
    leaf = (left < 0)[seen]
    out = {k: tree[k][seen] for k in ("stats", "raw", "gain", "feature", "bin")}
    new = np.where(leaf, -1, number[np.where(left < 0, 0, left)][seen])
    return out | {"told": told[seen], "left": new, "right": np.where(leaf, -1, new + 1), "gain": np.where(leaf, -1.0, out["gain"]), "feature": np.where(leaf, -1, out["feature"])}


def node_rows(t: int, tree: dict[str, np.ndarray]) -> pa.RecordBatch:
    n, classes = tree["stats"].shape
    whole = pa.array(np.arange(n + 1) * classes, pa.int32())
    columns = {"treeID": np.full(n, t, np.int32), "id": np.arange(n, dtype=np.int32), "prediction": tree["told"].astype(float), "impurity": gini(tree["stats"]),
               "impurityStats": pa.ListArray.from_arrays(whole, pa.array(tree["stats"].ravel())), "rawCount": np.round(tree["raw"]).astype(np.int64),
               "gain": tree["gain"], "leftChild": tree["left"].astype(np.int32), "rightChild": tree["right"].astype(np.int32),
               "feature": tree["feature"].astype(np.int32), "threshold": tree["bin"] + 0.5}
    return pa.RecordBatch.from_pydict({k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in columns.items()})


def fit(cells: DataFrame, buckets: Bucketizer, rf: RandomForestClassifier) -> RandomForestClassificationModel:
    """The forest that ``rf`` describes, of counted cells; its features are the bins."""
    spark = cells.sparkSession
    held = gathered(cells, buckets)
    classes, n_bins = max(2, int(held["label"].max()) + 1), max(2, int(held["bins"].max()) + 1)
    trees, seed, min_leaf, max_depth = rf.getNumTrees(), rf.getSeed(), rf.getMinInstancesPerNode(), rf.getMaxDepth()
    cloudpickle.register_pickle_by_value(__import__(__name__, fromlist=["fit"]))     # executors need no copy of this package
    shared = spark.sparkContext.broadcast(held)

    def grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in batch.column(0).to_pylist():
                yield node_rows(t, grow(shared.value, [seed, t], classes, n_bins, min_leaf, max_depth))

    nodes = spark.range(0, trees, 1, trees).mapInArrow(grown, NODE)
    threshold = F.when(F.col("feature") >= 0, F.array("threshold")).otherwise(F.array().cast("array<double>"))
    split = F.struct(F.col("feature").alias("featureIndex"), threshold.alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories"))
    data = nodes.select("treeID", F.struct("id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", split.alias("split")).alias("nodeData"))
    path = scratch_path(spark, "tables", spark.sparkContext.applicationId, f"forest-{uuid.uuid4().hex}")
    data.write.parquet(f"{path}/data")
    shared.destroy()
    about = {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "paramMap": {p.name: v for p, v in rf._paramMap.items()},
             "defaultParamMap": {p.name: v for p, v in rf._defaultParamMap.items()}}
    tree = about | {"class": "org.apache.spark.ml.classification.DecisionTreeClassificationModel", "uid": f"dtc_{uuid.uuid4().hex[:12]}", "paramMap": {}, "defaultParamMap": {}}
    spark.range(0, trees, 1, 1).select(F.col("id").cast("int").alias("_1"), F.lit(json.dumps(tree)).alias("_2"), F.lit(1.0).alias("_3")).write.parquet(f"{path}/treesMetadata")
    forest = about | {"class": "org.apache.spark.ml.classification.RandomForestClassificationModel", "uid": rf.uid,
                      "numFeatures": held["bins"].shape[1], "numClasses": classes, "numTrees": trees}
    spark.range(0, 1, 1, 1).select(F.lit(json.dumps(forest)).alias("value")).write.text(f"{path}/metadata")
    return RandomForestClassificationModel.load(path)
