"""SimHash near-duplicates: byte-position inverted index with count filtering.

Two 64-bit fingerprints that differ in at most ``k`` bits agree in at least
``8 - k`` of their 8 bytes, position by position. The index posts every
fingerprint under each choice of ``8 - k`` byte positions with the bytes found
there, so a pair that reaches the guaranteed count meets in some posting. For
each pair met the shared positional bytes are tallied; the pair is kept at the
first choice of positions that it shares (once in the whole index) if the tally
reaches the minimum, and then the differing bits are counted.

Equal fingerprints are one node, so a group of copies costs one entry. Postings
travel as packed arrays (8 bytes an entry). A posting longer than
``PAIRS_LIMIT`` is not compared pairwise: its members are marked, and all marked
fingerprints are linked exactly through midpoints. Postings that a sample of at
most about ``SAMPLE`` fingerprints shows to be long (:func:`hot_postings`) are
never gathered at all: their members are marked where they are read, so a large
group of near copies spreads over all tasks. Two fingerprints differ in at
most ``k`` bits if and only if some value lies within ``k - k//2`` bits of one
and ``k//2`` of the other; each marked one lists all values that near, equal
values are joined by their smallest lister, and no pair is ever written.
Components come from alternating star contraction, each round written.

Null or empty text, or text of spaces only: fingerprint zero, linked like any
other. Null doc_id: the row gets its fingerprint and the component id of its
group, but never is the smallest id. Repeated rows: each is returned. An empty
table gives no rows. Extra columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from fieldmart.llm.common import components, partitions, text_slices, written

#: Longest posting that is compared pairwise; a longer one goes through midpoints.
PAIRS_LIMIT = 4096
#: Fingerprints, drawn by hash, that show which postings are long, and the least
#: number of them that a posting must hold to count as long.
SAMPLE, LEAST_SEEN = 50_000, 32
#: Packed bytes that one index task should get.
BUCKET_BYTES = 16 << 20
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: bytes, shingle: int = 4, seed: int = 42) -> int:
    """Fingerprint of one UTF-8 text."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(line, seed)]
    else:
        gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
        starts = [0, *(gaps + 1).tolist()]
        ends = [*gaps.tolist(), len(line)][shingle - 1:]
        h = xxhash.xxh64_intdigest
        hashes = [h(line[s:e], seed) for s, e in zip(starts, ends)]
    n, ones = len(hashes), np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        part = np.array(hashes[at:at + (1 << 16)], dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def text_hash() -> Column:
    """Names a text among those of one doc_id; a null text is not the empty one."""
    return F.coalesce(F.md5(F.col("text").cast("string").cast("binary")), F.lit("")).alias("text_hash")


def fingerprints(docs: DataFrame, shingle: int = 4, seed: int = 42, hashed: bool = False) -> DataFrame:
    """(doc_id, fp long: the fingerprint's 64 bits as a signed number), with text_hash if ``hashed``."""
    more = ["text_hash"] if hashed else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text_slices(batches):
            raw, cut = data.tobytes(), offsets.tolist()
            fps = np.fromiter((fingerprint(raw[a:b], shingle, seed) for a, b in zip(cut, cut[1:])), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps.view(np.int64)), *[batch.column(c) for c in more]], names=["doc_id", "fp", *more])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *[text_hash() for _ in more])
    return rows.mapInArrow(run, "doc_id long, fp long" + "".join(f", {c} string" for c in more))


@lru_cache
def choices(k: int) -> tuple[list[int], np.ndarray]:
    """Byte masks for each choice of 8 - k positions, and for each set of
    equal positions (as 8 bits) the first choice inside it, or -1."""
    sets = list(combinations(range(8), 8 - k))
    first = np.full(256, -1, np.int16)
    for bits in range(256):
        equal = [p for p in range(8) if bits >> p & 1]
        if len(equal) >= 8 - k:
            first[bits] = sets.index(tuple(equal[:8 - k]))
    return [sum(0xFF << (8 * p) for p in s) for s in sets], first


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def tally(x: np.ndarray) -> np.ndarray:
    """Bit p is set if byte p of the difference is zero (a shared positional byte)."""
    out = np.zeros(len(x), np.uint8)
    for p in range(8):
        out |= (((x >> np.uint64(8 * p)) & np.uint64(255)) == 0).astype(np.uint8) << np.uint8(p)
    return out


def split_by(values: np.ndarray, bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    values, bucket = values[order], bucket[order]
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    for part, at in zip(np.split(values, cuts), np.concatenate([[0], cuts])):
        if len(part):
            yield int(bucket[at]), part


def hot_postings(fps: DataFrame, n: int, k: int, limit: int) -> list[np.ndarray]:
    """For each choice the keys of postings that hold more than ``limit`` of the
    ``n`` fingerprints, as estimated from a sample. At most
    ``SAMPLE / LEAST_SEEN`` keys a choice. Which postings are named decides where
    the work is done and never what is linked."""
    share = min(1.0, SAMPLE / max(n, 1))
    least = max(LEAST_SEEN, limit * share)
    masks = choices(k)[0]

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(range(len(masks)), pa.int32()), pa.array([(own & np.uint64(m)).tobytes() for m in masks], pa.binary())], names=["choice", "packed"])

    def often(group: pd.DataFrame) -> pd.DataFrame:
        key, seen = np.unique(np.frombuffer(b"".join(group["packed"]), np.uint64), return_counts=True)
        return pd.DataFrame({"choice": group["choice"].iloc[0], "key": key[seen > least].view(np.int64)})

    sample = fps.where(F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) < int(share * (1 << 30)))
    hot = sample.mapInArrow(keys, "choice int, packed binary").groupBy("choice").applyInPandas(often, "choice int, key long").toPandas()
    return [np.sort(hot["key"][hot["choice"] == c].to_numpy(np.int64).view(np.uint64)) for c in range(len(masks))]


def member(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which values stand in the sorted array ``of``."""
    if not len(of):
        return np.zeros(len(values), bool)
    return of[np.minimum(np.searchsorted(of, values), len(of) - 1)] == values


def post(fps: DataFrame, k: int, buckets: int, hot: list[np.ndarray]) -> DataFrame:
    """Postings as rows (bucket, choice, packed fingerprints); members of a hot
    posting come under choice -1, dealt by themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            rows: tuple[list, list, list] = ([], [], [])
            marked = np.zeros(len(own), bool)
            for c, mask in enumerate(choices(k)[0]):
                key = own & np.uint64(mask)
                gone = member(key, hot[c])
                marked |= gone
                for bucket, part in split_by(own[~gone], mixed(key[~gone] + np.uint64(c)) % np.uint64(buckets)):
                    rows[0].append(bucket), rows[1].append(c), rows[2].append(part.tobytes())
            for bucket, part in split_by(own[marked], mixed(own[marked]) % np.uint64(buckets)):
                rows[0].append(bucket), rows[1].append(-1), rows[2].append(part.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.int32()), pa.array(rows[2], pa.binary())], names=["bucket", "choice", "packed"])

    return fps.mapInArrow(run, "bucket int, choice int, packed binary")


def compare(fps: np.ndarray, choice: int, k: int, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links (from, to) found in the postings of one choice, contracted to
    stars, and the members of postings over the limit."""
    masks, first = choices(k)
    fps = np.unique(fps)
    key = fps & np.uint64(masks[choice])
    order = np.argsort(key, kind="stable")
    fps, key = fps[order], key[order]
    begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    size = np.diff(np.append(begin, len(key)))
    run_size = np.repeat(size, size)
    long = fps[run_size > limit]
    keep = (run_size > 1) & (run_size <= limit)
    fps, left = fps[keep], (np.repeat(begin + size, size) - np.arange(len(key)))[keep]
    at, a, b, step = np.arange(len(fps)), [], [], 1
    while True:
        at = at[left[at] > step]  # those with a member of the same posting `step` places on
        if not len(at):
            break
        differ = fps[at] ^ fps[at + step]
        hit = at[(first[tally(differ)] == choice) & (np.bitwise_count(differ) <= k)]
        a.append(hit), b.append(hit + step)
        step += 1
    none = np.zeros(0, np.uint64)
    if not a:
        return none, none, long
    root = components(len(fps), np.concatenate(a), np.concatenate(b))
    linked = root != np.arange(len(fps))
    return fps[linked], fps[root[linked]], long


def links(fps: DataFrame, k: int = 4, limit: int | None = None) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fps`` (column fp) that
    connect exactly what chains of at most ``k`` differing bits connect."""
    limit = limit or PAIRS_LIMIT
    if k > 6:
        raise ValueError("fingerprints that share fewer than two bytes have no useful posting")
    spark = fps.sparkSession
    n = fps.count()
    buckets = max(partitions(spark), -(-n * len(choices(k)[0]) * 8 // BUCKET_BYTES))
    hot = hot_postings(fps, n, k, limit)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        found = []
        for choice, rows in group.groupby("choice"):
            packed = np.frombuffer(b"".join(rows["packed"]), np.uint64)
            none = packed[:0]
            a, b, long = compare(packed, int(choice), k, limit) if choice >= 0 else (none, none, packed)
            found += [(a, b, False), (long, long, True)]
        a, b = (np.concatenate([f[i] for f in found]) for i in (0, 1))
        marked = np.concatenate([np.full(len(f[0]), f[2]) for f in found])
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64), "marked": marked}).drop_duplicates()

    found = written(post(fps, k, buckets, hot).groupBy("bucket").applyInPandas(run, "a long, b long, marked boolean"), "simhash-links")
    marked = found.where("marked").select(F.col("a").alias("fp")).distinct()
    return found.where("not marked").select("a", "b").unionByName(midpoint_links(marked, k))


@lru_cache
def near(k: int) -> np.ndarray:
    """All differences of at most k - k//2 bits; the first ones have at most k//2."""
    bits = [np.uint64(1) << np.uint64(i) for i in range(64)]
    out = [np.uint64(0)]
    for r in range(1, k - k // 2 + 1):
        out += [np.bitwise_or.reduce(c) for c in combinations(bits, r)]
    return np.array(out, np.uint64)


def midpoint_links(marked: DataFrame, k: int) -> DataFrame:
    """Links among marked fingerprints. Each lists all values within k - k//2
    bits; a value's listers are linked if one of them is within k//2 bits."""
    deltas = near(k)
    close = np.bitwise_count(deltas) <= k // 2
    buckets = max(partitions(marked.sparkSession), -(-marked.count() * len(deltas) * 16 // BUCKET_BYTES))

    def lister(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(fps), 512):
                own, rows = fps[at:at + 512], ([], [], [])
                for is_close in (True, False):
                    value = (own[:, None] ^ deltas[None, close == is_close]).ravel()
                    pairs = np.stack([value, np.repeat(own, int((close == is_close).sum()))], axis=1)
                    for bucket, part in split_by(pairs, mixed(value) % np.uint64(buckets)):
                        rows[0].append(bucket), rows[1].append(is_close), rows[2].append(part.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.bool_()), pa.array(rows[2], pa.binary())], names=["bucket", "close", "packed"])

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        near_by, far = (np.frombuffer(b"".join(group["packed"][group["close"] == c]), np.uint64).reshape(-1, 2) for c in (True, False))
        near_by = near_by[np.lexsort((near_by[:, 1], near_by[:, 0]))]
        values, head = np.unique(near_by[:, 0], return_index=True)
        out = []
        for listed in (near_by, far):
            at = np.minimum(np.searchsorted(values, listed[:, 0]), max(len(values) - 1, 0))
            if len(values) and len(listed):
                to = near_by[head[at], 1]
                linked = (values[at] == listed[:, 0]) & (listed[:, 1] != to)
                out.append(np.unique(np.stack([listed[linked, 1], to[linked]], axis=1), axis=0))
        found = np.concatenate(out) if out else np.zeros((0, 2), np.uint64)
        return pd.DataFrame({"a": found[:, 0].view(np.int64), "b": found[:, 1].view(np.int64)})

    return marked.mapInArrow(lister, "bucket int, close boolean, packed binary").groupBy("bucket").applyInPandas(meet, "a long, b long")


def connect(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that each linked node reaches, by
    alternating large-star and small-star contraction. Every round is a written
    table, so a lost executor costs at most one round."""
    # each node points to a smaller one
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("to")).distinct(), "star")
    before = None
    for _ in range(rounds):
        state = now.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64("node", "to").cast("decimal(20,0)")), F.lit(0)).alias("h")).first()
        if state == before or not state["n"]:
            break
        before = state
        both = now.unionByName(now.select(F.col("to").alias("node"), F.col("node").alias("to")))
        least = both.groupBy("node").agg(F.least(F.min("to"), F.col("node")).alias("least"))
        large = both.where("to > node").join(least, "node").select(F.col("to").alias("node"), F.col("least").alias("to")).where("node <> to").distinct()
        large = written(large, "star")
        least = large.groupBy("node").agg(F.min("to").alias("least"))
        small = (large.join(least, "node").where("to <> least").select(F.col("to").alias("node"), F.col("least").alias("to"))
                 .unionByName(least.select("node", F.col("least").alias("to"))).distinct())
        now = written(small, "star")
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.groupBy("node").agg(F.min("to").alias("component"))


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, seed: int = 42, limit: int | None = None) -> DataFrame:
    """(doc_id, fp, component, component_id) for every row of ``docs`` (doc_id,
    text); component is the group's smallest fingerprint."""
    return grouped(fingerprints(docs, shingle, seed), max_bits, limit)


def grouped(rows: DataFrame, max_bits: int = 4, limit: int | None = None) -> DataFrame:
    """``rows`` (doc_id, fp and others) with component and component_id."""
    rows = written(rows, "fingerprints")
    nodes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprint-nodes")
    linked = connect(links(nodes.select("fp"), max_bits, limit))
    group = nodes.join(linked, nodes["fp"] == linked["node"], "left").select("fp", "first_id", F.coalesce("component", "fp").alias("component"))
    ids = group.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return rows.join(group.select("fp", "component").join(ids, "component"), "fp").select(*rows.columns, "component", "component_id")


#: What tells one document from another; no part is ever null.
KEY = ["named", "id", "text_hash"]


def doc_key(hashed: Column | None = None) -> list[Column]:
    doc_id = F.col("doc_id").cast("long")
    return [doc_id.isNotNull().alias("named"), F.coalesce(doc_id, F.lit(0)).alias("id"), F.col("text_hash") if hashed is None else hashed]


def keep_first(docs: DataFrame, shingle: int = 4, max_bits: int = 4, seed: int = 42, limit: int | None = None) -> DataFrame:
    """``docs`` with one document of each group: one whose doc_id is the
    component id (null in a group without ids), of these the one with the
    smallest text; of rows that repeat both, the one smallest by its other plain
    columns. The choice is made in each group on its own, so a doc_id that
    stands in several groups may stay in each of them."""
    found = grouped(fingerprints(docs, shingle, seed, hashed=True), max_bits, limit)
    able = written(found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("component", *doc_key()).distinct(), "near-duplicates")
    groups = able.groupBy("component").agg(F.count(F.lit(1)).alias("n"), *[F.min(c).alias(c) for c in KEY])
    kept, several = groups.where("n = 1").select(*KEY), groups.where("n > 1").select(F.col("component").alias("_group"))
    plain = [F.col(f.name) for f in docs.schema.fields if isinstance(f.dataType, AtomicType) and f.name != "text"]
    rows = docs.select(*doc_key(text_hash()), F.col("text").cast("string").alias("own_text"), F.struct(*plain).alias("rest"), F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    if not several.isEmpty():  # one doc_id with different texts in one group
        open_keys = able.join(several, F.col("component") == F.col("_group")).select("component", *KEY)
        texts = rows.groupBy(*KEY).agg(F.first("own_text").alias("own_text")).join(open_keys, KEY)
        least = texts.groupBy("component").agg(F.min(F.struct(F.col("own_text").isNotNull().alias("has"), "own_text", *KEY)).alias("least"))
        kept = kept.unionByName(least.select(*[F.col("least")[c].alias(c) for c in KEY]))
    # repeated rows are reduced where they are read, before they meet in one task
    single = rows.groupBy(*KEY).agg(F.min_by("row", "rest").alias("row")).join(kept, KEY, "left_semi")
    return single.select(*[F.col("row")[c].alias(c) for c in docs.columns])
