"""Approximate nearest neighbours by balanced posting lists.

Vectors are lifted for inner-product search: a vector x of length at most M gets
the further component sqrt(M*M - x.x), a query gets zero, and the nearest lifted
vector in Euclidean distance is the one with the largest inner product.

* Centroids are fitted on a bounded sample (``SAMPLE`` vectors by hash of the
  vector; a documented bound): clusters of the sample are halved by 2-means until
  each holds at most its share, which balances the lists.
* Every distinct vector is indexed. One near a boundary goes to several lists:
  all whose centroid is at most ``1 + BORDER`` times as far as the nearest, up to
  ``COPIES``; it always is in its nearest list.
* Centroids are found by an in-memory graph: each centroid links to its nearest
  ones in both directions, and a best-first walk finds those near a vector
  without comparing all.
* A query reads the lists whose centroid distance is at most ``1 + PROBE`` times
  its nearest one's (distance-ratio pruning): few where lists lie clearly apart,
  many where they don't, and always as many as hold k answers.

``SHELF`` neighbouring lists stand on one shelf, where a query meets all its lists of
the shelf at once and gives at most k + 1 rows. Shelves are read in rounds, the
nearest first, each round ``GROW`` times as many entries as those before; the
(k + 1)-th score so far goes with the query, and only entries that reach it come
back. So a query gives some k * GROW rows a round, and there are as many rounds as
the logarithm of its entries. Nothing true is lost by that.

Shelves are stored in chunks of about ``CHUNK`` entries, as many as a shelf's own size
asks for, dealt by hash, so one that outgrew its share is read by several tasks. Equal vectors are one
entry with their smallest ids (k + 1 of them, enough for any answer: equal
vectors tie, ties go to smaller ids, and a query leaves out itself only). Equal
queries are searched once. Scores are exact inner products in double precision.

Null, zero and non-finite vectors, vectors with a null component, and vectors of
another length than the most frequent one (ties: the smaller) take no part. Null
ids take no part. Rows that repeat an id: each is a candidate for other ids; the
id is queried once, with its first vector. Empty table: no rows. Extra columns
are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldmart.llm.common import written

SAMPLE = 20_000
LIST_SIZE = 200
MOST_LISTS = 16_384
BORDER, COPIES = 0.06, 2
PROBE = 0.13
EXPANDED, LINKS = 12, 24
SHELF, GROW = 16, 8
CHUNK = 20_000


def rows_of(column: pa.Array, width: int) -> np.ndarray:
    """An Arrow list column of equal lengths as a matrix of doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def clusters(x: np.ndarray, most: int, seed: int = 1, turns: int = 8) -> np.ndarray:
    """Centroids of x, halved by 2-means until a cluster has at most ``most`` rows."""
    rng, todo, out = np.random.default_rng(seed), [np.arange(len(x))], []
    while todo:
        own = todo.pop()
        if len(own) <= most:
            out.append(x[own].mean(axis=0))
            continue
        a, b = x[rng.choice(own, 2, replace=False)]
        for _ in range(turns):
            nearer = ((x[own] - a) ** 2).sum(axis=1) <= ((x[own] - b) ** 2).sum(axis=1)
            if nearer.all() or not nearer.any():
                break
            a, b = x[own[nearer]].mean(axis=0), x[own[~nearer]].mean(axis=0)
        if min(nearer.sum(), (~nearer).sum()) < len(own) // 8:  # keep halves balanced: cut at the median of the line between
            along = x[own] @ (a - b)
            nearer = np.zeros(len(own), bool)
            nearer[np.argsort(-along, kind="stable")[:len(own) // 2]] = True
        todo += [own[nearer], own[~nearer]]
    return np.array(out)


class CentroidGraph:
    """Links between near centroids, and a walk over them."""

    def __init__(self, centroids: np.ndarray, links: int = LINKS):
        self.c = centroids
        self.norms = (centroids ** 2).sum(axis=1)
        n = len(centroids)
        near = []
        for at in range(0, n, 1024):
            d = self.norms[None, :] - 2 * centroids[at:at + 1024] @ centroids.T
            d[np.arange(len(d)), np.arange(at, at + len(d))] = np.inf
            k = min(links, n - 1)
            near.append(np.argpartition(d, k - 1, axis=1)[:, :k] if k else np.zeros((len(d), 0), int))
        near = np.concatenate(near)
        # links in both directions, and a ring in random order that keeps the graph in one piece
        pairs = np.stack([np.repeat(np.arange(n), near.shape[1]), near.ravel()], axis=1)
        ring = np.random.default_rng(2).permutation(n)
        pairs = np.concatenate([pairs, pairs[:, ::-1], np.stack([ring, np.roll(ring, 1)], axis=1)])
        pairs = np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0)
        degree = np.bincount(pairs[:, 0], minlength=n)
        self.links = np.full((n, max(1, degree.max())), -1)
        self.links[pairs[:, 0], np.arange(len(pairs)) - np.repeat(np.cumsum(degree) - degree, degree)] = pairs[:, 1]
        step = max(1, n // 32)
        self.entries = np.arange(0, n, step)  # walks begin at the nearest of some thirty centroids

    def search(self, x: np.ndarray, ratio: float) -> np.ndarray:
        """Squared distances from the rows of x to the centroids that the walk
        met, inf elsewhere. A walk always goes on from the nearest centroid not
        yet expanded, at least ``EXPANDED`` times, and until that one is farther
        than 1 + ``ratio`` times the nearest."""
        own, rows = (x ** 2).sum(axis=1), np.arange(len(x))
        met = np.full((len(x), len(self.c)), np.inf)
        met[:, self.entries] = np.maximum(own[:, None] + self.norms[self.entries][None, :] - 2 * x @ self.c[self.entries].T, 0)
        todo = met.copy()  # distances of the met ones that aren't expanded
        best = met.min(axis=1)
        for turn in range(len(self.c)):
            at = np.argmin(todo[rows], axis=1)
            near = todo[rows, at]
            go = np.isfinite(near) & ((turn < EXPANDED) | (near <= (1 + ratio) ** 2 * best[rows]))
            rows, at = rows[go], at[go]
            if not len(rows):
                break
            todo[rows, at] = np.inf
            new = self.links[at]
            r, c = np.nonzero((new >= 0) & np.isinf(met[rows[:, None], new]))
            who, which = rows[r], new[r, c]
            d = np.maximum(own[who] + self.norms[which] - 2 * np.einsum("rd,rd->r", x[who], self.c[which]), 0)
            met[who, which] = todo[who, which] = d
            np.minimum.at(best, who, d)
        return met


def lists_near(graph: CentroidGraph, x: np.ndarray, ratio: float, most: int | None = None, sizes: np.ndarray | None = None, need: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(row, list): the lists, ``most`` at most, within 1 + ``ratio`` times the
    nearest one's distance, and as many nearest ones as hold ``need`` entries."""
    met = graph.search(x, ratio)
    if most and most < met.shape[1]:
        met[met > np.partition(met, most - 1, axis=1)[:, most - 1:most]] = np.inf
    near = met <= (1 + ratio) ** 2 * met.min(axis=1)[:, None] + 1e-12
    short = np.flatnonzero(near @ sizes < need) if need else []
    if len(short):
        d = (x[short] ** 2).sum(axis=1)[:, None] + graph.norms[None, :] - 2 * x[short] @ graph.c.T
        order = np.argsort(d, axis=1)
        before = np.cumsum(sizes[order], axis=1) - sizes[order]
        np.put_along_axis(d, order, before < need, axis=1)
        near[short] |= d > 0
    return np.nonzero(near)


def rounds_of(group: np.ndarray, distance: np.ndarray, size: np.ndarray, need: int) -> np.ndarray:
    """For rows of (query, shelf distance, shelf entries) the round in which the query
    reads the shelf: 0 until ``need`` entries are met, then each round GROW times all
    before it."""
    order = np.lexsort((distance, group))
    total = np.cumsum(size[order]) - size[order]
    first = np.concatenate([[True], group[order][1:] != group[order][:-1]])[:len(order)]
    before = total - np.maximum.accumulate(np.where(first, total, 0))
    out = np.zeros(len(order), np.int64)
    later = before >= max(need, 1)
    out[order[later]] = 1 + np.floor(np.log(before[later] / max(need, 1)) / np.log(GROW)).astype(np.int64)
    return out


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(id, v: array<double>) of the vectors that take part, and their length."""
    v = F.col(vector_col)
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    rows = vectors.where(F.col(id_col).isNotNull() & v.isNotNull()).where(ok).select(F.col(id_col).cast("long").alias("id"), v.cast("array<double>").alias("v"))
    width = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.col("count").desc(), "n").first()
    return (rows.where(F.size("v") == width["n"]), width["n"]) if width else (rows, 0)


def search(vectors: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
           list_size: int = LIST_SIZE, probe: float = PROBE) -> DataFrame:
    """(query_id, rank, id, score): for each row of ``vectors`` that ``queries``
    (a condition on column id) selects, the k nearest other rows found."""
    spark = vectors.sparkSession
    rows, width = usable(vectors, id_col, vector_col)
    if not width:
        return spark.createDataFrame([], f"query_id long, rank int, {id_col} long, score double")
    key = F.xxhash64("v")
    distinct = written(smallest_ids(rows.withColumn("h", key), k + 1), "vectors")
    stats = distinct.agg(F.count(F.lit(1)).alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("m")).first()
    top = float(stats["m"])
    sample = rows_of(distinct.orderBy("h").limit(SAMPLE).select("v").toArrow().column("v").combine_chunks(), width)
    n_lists = int(min(MOST_LISTS, max(1, stats["n"] // list_size)))
    lifted = np.hstack([sample, np.sqrt(np.maximum(top - (sample ** 2).sum(axis=1), 0))[:, None]])
    graph = CentroidGraph(clusters(lifted, max(1, -(-len(sample) // n_lists))))
    step = max(16, (4 << 20) // len(graph.c))  # rows walked at once

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                x = rows_of(part.column("v"), width)
                lift = np.hstack([x, np.sqrt(np.maximum(top - (x ** 2).sum(axis=1), 0))[:, None]])
                row, in_list = lists_near(graph, lift, BORDER, COPIES)
                own = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(in_list, pa.int32()), own.column("h"), own.column("ids"), own.column("v")], names=["list", "h", "ids", "v"])

    stored = written(distinct.mapInArrow(assign, "list int, h long, ids array<bigint>, v array<double>"), "posting-lists")
    sizes = np.zeros(len(graph.c))
    for r in stored.groupBy("list").count().collect():  # at most MOST_LISTS rows
        sizes[r["list"]] = r["count"]
    shelf_sizes = np.bincount(np.arange(len(sizes)) // SHELF, weights=sizes)
    chunks = np.maximum(1, -(-shelf_sizes // CHUNK)).astype(np.int64)
    need = COPIES * (k + 1)  # an entry stands in at most COPIES lists, so these hold k + 1 different ones

    def probe_shelves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                x = np.hstack([rows_of(part.column("v"), width), np.zeros((part.num_rows, 1))])
                row, in_list = lists_near(graph, x, probe, sizes=sizes, need=need)
                far = graph.norms[in_list] - 2 * (x[row] * graph.c[in_list]).sum(axis=1)
                both, which = np.unique(row * len(shelf_sizes) + in_list // SHELF, return_inverse=True)
                query, shelf = np.divmod(both, len(shelf_sizes))
                nearest_list, entries = np.full(len(both), np.inf), np.bincount(which, weights=sizes[in_list], minlength=len(both))
                np.minimum.at(nearest_list, which, far)
                turn = rounds_of(query, nearest_list, entries, need)
                by = np.argsort(which, kind="stable")
                ends = np.concatenate([[0], np.cumsum(np.bincount(which, minlength=len(both)))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(in_list[by], pa.int32()))
                each = np.repeat(np.arange(len(both)), chunks[shelf])
                chunk = np.arange(len(each)) - np.repeat(np.cumsum(chunks[shelf]) - chunks[shelf], chunks[shelf])
                yield pa.RecordBatch.from_arrays([part.column("qid").take(pa.array(query[each])), pa.array(shelf[each], pa.int32()), pa.array(chunk, pa.int32()),
                                                  pa.array(turn[each], pa.int32()), lists.take(pa.array(each))], names=["qid", "shelf", "chunk", "turn", "lists"])

    asked = written(rows.where(queries).withColumn("h", key).groupBy("id").agg(F.min(F.struct("h", "v")).alias("x")).select("id", "x.h", "x.v"), "vector-queries")
    # equal queries are searched once, under their smallest id
    once = written(asked.groupBy("h", "v").agg(F.min("id").alias("qid")), "distinct-queries")
    probes = written(once.select("qid", "v").mapInArrow(probe_shelves, "qid long, shelf int, chunk int, turn int, lists array<int>"), "probes")
    turns = [r["turn"] for r in probes.select("turn").distinct().orderBy("turn").collect()]  # the logarithm of the largest number of entries
    empty = pa.schema([("qid", pa.int64()), ("h", pa.int64()), ("ids", pa.list_(pa.int64())), ("score", pa.float64())]).empty_table()

    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return empty
        have, q = (rows_of(t.column("v").combine_chunks(), width) for t in (left, right))
        of_list, reach = left.column("list").to_numpy(), right.column("reach").to_numpy()
        wanted = np.zeros((len(q), SHELF), bool)
        lists = right.column("lists").combine_chunks()
        wanted[np.repeat(np.arange(len(q)), lists.value_lengths().to_numpy()), lists.flatten().to_numpy() % SHELF] = True
        asked_at, found_at, scores = [], [], []
        for at in range(0, len(q), 256):
            s = np.where(wanted[at:at + 256][:, of_list % SHELF], q[at:at + 256] @ have.T, -np.inf)
            n = min(COPIES * (k + 1), s.shape[1])   # an entry may stand in COPIES lists of the shelf
            cut = np.maximum(-np.partition(-s, n - 1, axis=1)[:, n - 1:n], reach[at:at + 256, None])
            row, col = np.nonzero((s >= cut - 1e-12) & np.isfinite(s))  # with the ties of the last place
            # one sum for each pair, so that a vector has the same score in every list
            asked_at.append(at + row), found_at.append(col), scores.append((q[at + row] * have[col]).sum(axis=1))
        asked_at, found_at, scores = (np.concatenate(x) for x in (asked_at, found_at, scores))
        h = left.column("h").to_numpy()[found_at]
        _, one = np.unique(np.stack([asked_at, h]), axis=1, return_index=True)   # an entry once a shelf
        return pa.Table.from_arrays([right.column("qid").combine_chunks().take(pa.array(asked_at[one])), pa.array(h[one]),
                                     left.column("ids").combine_chunks().take(pa.array(found_at[one])), pa.array(scores[one])], schema=empty.schema)

    counts = spark.createDataFrame([(i, int(n)) for i, n in enumerate(chunks)], "shelf int, n_chunks int")   # at most MOST_LISTS / SHELF rows
    shelved = stored.withColumn("shelf", F.floor(F.col("list") / SHELF).cast("int")).join(F.broadcast(counts), "shelf")
    shelved = shelved.withColumn("chunk", F.pmod(F.col("h"), "n_chunks").cast("int")).select("shelf", "chunk", "list", "h", "ids", "v")
    by_score = Window.partitionBy("qid").orderBy(F.desc("score"), "h")
    best = None
    for turn in turns:
        now = probes.where(F.col("turn") == turn).drop("turn").join(once.select("qid", "v"), "qid")
        if best is None:
            now = now.withColumn("reach", F.lit(float("-inf")))
        else:  # the score of a query's (k + 1)-th entry so far
            last = best.withColumn("nth", F.row_number().over(by_score)).where(F.col("nth") == k + 1).select("qid", F.col("score").alias("reach"))
            now = now.join(last, "qid", "left").withColumn("reach", F.coalesce("reach", F.lit(float("-inf"))))
        more = shelved.groupBy("shelf", "chunk").cogroup(now.groupBy("shelf", "chunk")).applyInArrow(nearest, "qid long, h long, ids array<bigint>, score double")
        both = more if best is None else best.unionByName(more)
        each = both.groupBy("qid", "h").agg(F.max("score").alias("score"), F.max("ids").alias("ids"))
        # entries as good as the (k + 1)-th stay with it
        ranked = each.withColumn("nth", F.rank().over(Window.partitionBy("qid").orderBy(F.desc("score")))).where(F.col("nth") <= k + 1).drop("nth")
        best = written(ranked, "nearest-so-far")
    found = best
    # k + 1 entries are enough, each with its own ids
    each = found.withColumn("first", F.element_at("ids", 1))
    top_entries = (each.withColumn("nth", F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "first"))).where(F.col("nth") <= k + 1)
                   .select("qid", "score", F.explode("ids").alias("found_id")))
    top_entries = (top_entries.withColumn("nth", F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "found_id"))).where(F.col("nth") <= k + 1).drop("nth"))
    answers = top_entries.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), "found_id"))).alias("best"))
    members = asked.select("id", "h", "v").join(once.select("qid", F.col("h").alias("h2"), F.col("v").alias("v2")), (F.col("h") == F.col("h2")) & (F.col("v") == F.col("v2"))).select("id", "qid")
    listed = members.join(answers, "qid").select(F.col("id").alias("query_id"), F.posexplode(F.slice(F.filter("best", lambda b: b["found_id"] != F.col("id")), 1, k)).alias("pos", "b"))
    return listed.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("b.found_id").alias(id_col), (-F.col("b.minus")).alias("score"))


def smallest_ids(rows: DataFrame, most: int) -> DataFrame:
    """(h, v, ids): each distinct vector with its ``most`` smallest ids. Ids are
    ranked in parts dealt by hash first, so a frequent vector spreads."""
    parts = F.pmod(F.xxhash64("id"), F.lit(64))
    in_part = rows.select("id", "v", "h", parts.alias("p")).withColumn("nth", F.row_number().over(Window.partitionBy("h", "p").orderBy("id")))
    few = in_part.where(F.col("nth") <= most).select("id", "v", "h")
    return few.groupBy("h", "v").agg(F.slice(F.sort_array(F.collect_set("id")), 1, most).alias("ids"))
