"""Substring deduplication by relative Lempel-Ziv parsing.

The corpus, ordered by doc_id, is cut into reference blocks of about
``BLOCK_BYTES`` of text (more where that would make over ``MOST_BLOCKS``; a longer
document is a block's last). Every block is indexed: its distinct word windows of
``window`` words, as sorted fingerprints (64 bits for the place and 24 more as a
check), go in packed arrays to the index bucket of their leading bits. A bucket
finds for each fingerprint the first block that holds it, and answers every
later block with one bit an entry and the numbers of those reference blocks.

A document is then read left to right: a factor begins at a window that some
earlier block, or an earlier document of its own block, holds, and grows word by
word while the following windows have the same earliest block; where they don't,
the factor ends and the next one may begin. The index holds no places, so a factor
is a run of known windows and not always one phrase of its block, nor the longest.
Since a shorter match than a window is no duplicate, a factor has at least
``window`` words. The windows across each factor boundary are looked up like all others,
so passages that end in one reference and go on in another are found whole. The
words that factors cover are removed; windows are judged on the input texts.

An entry of the index costs about ten bytes, whatever the number of copies: a
block sends a window once, and a bucket gets at most one entry a block for it,
so neither frequent passages nor groups of copies gather in one task.

Null text: no words. Null doc_id: the row is returned whole and is no
reference. Rows that repeat a doc_id don't remove each other's words. Texts
shorter than a window and empty tables are returned as they are. Very long texts: a
block's last document, whole. Extra columns
are ignored. Two different windows are taken for equal with probability 2**-88
each pair."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldmart.llm.common import before_each, partitions, strings_at, text_slices, word_spans, written

BLOCK_BYTES = 8 << 20
#: The driver holds one number a block, this many at most.
MOST_BLOCKS = 1 << 20
#: Blocks' worth of entries that one bucket of the index gets.
BLOCKS_PER_BUCKET = 2
CHECK_BYTES = 3
_ODD = np.uint64(0x9E3779B97F4A7C15)

RESULT = "doc_id long, n_words long, n_removed long, kept string, spans array<struct<start:int,end:int,block:int>>"


class Block:
    """Documents of one block in doc_id order, and their windows."""

    def __init__(self, docs: pa.Table, window: int):
        docs = docs.sort_by("doc_id").combine_chunks()
        self.ids = docs.column("doc_id").to_pylist()
        batch = docs.select(["text"]).to_batches()[0]
        _, self.data, offsets = next(text_slices(iter([batch]), limit=1 << 62))
        self.offsets = offsets
        self.starts, self.ends, self.first = word_spans(self.data, offsets)
        n = len(self.starts)
        words = strings_at(self.data, self.starts, self.ends).dictionary_encode()
        digests = b"".join(map(xxhash.xxh3_128_digest, words.dictionary.to_pylist()))
        code = words.indices.to_numpy()
        hashes = np.frombuffer(digests, np.uint64).reshape(-1, 2)
        doc = np.repeat(np.arange(len(self.ids)), np.diff(self.first))
        self.at = np.flatnonzero(np.arange(n) + window <= np.repeat(self.first[1:], np.diff(self.first)))
        m = max(n - window + 1, 0)
        place, check = (self._fold(hashes[:, i][code], window, m)[self.at] for i in (0, 1))
        check >>= np.uint64(64 - 8 * CHECK_BYTES)
        ids = np.array(self.ids, np.int64)
        self.rank = np.cumsum(np.concatenate([[0], ids[1:] != ids[:-1]]))[doc[self.at]] if n else np.zeros(0, np.int64)
        order = np.argsort(place)
        p, c = place[order], check[order]
        same = p[1:] == p[:-1]
        if (same & (c[1:] != c[:-1])).any():  # two windows of one place: their order must be the same each time
            order = np.lexsort((check, place))
            p, c = place[order], check[order]
            same = p[1:] == p[:-1]
        new = np.concatenate([[True], ~(same & (c[1:] == c[:-1]))])[:len(p)]
        begin = np.flatnonzero(new)
        self.place, self.check = p[begin], c[begin]
        self.entry = np.empty(len(p), np.int64)
        self.entry[order] = np.cumsum(new) - 1
        earliest = np.minimum.reduceat(self.rank[order], begin) if len(begin) else np.zeros(0, np.int64)
        self.repeated_here = self.rank > earliest[self.entry]

    @staticmethod
    def _fold(h: np.ndarray, window: int, m: int) -> np.ndarray:
        out = np.zeros(m, np.uint64)
        for j in range(window):
            out = out * _ODD + h[j:j + m]
        out ^= out >> np.uint64(32)
        return out * _ODD

    def cuts(self, buckets: int) -> np.ndarray:
        """Where the entries of each bucket begin."""
        bucket = ((self.place >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        return np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))


def low_bytes(x: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(x.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def from_low_bytes(raw: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(-1, width)
    return out.view("<u8").ravel().astype(np.uint64)


def index_rows(block: int, own: Block, buckets: int) -> pa.Table:
    rows: dict[str, list] = {"bucket": [], "block": [], "first": [], "width": [], "steps": [], "checks": []}
    cuts = own.cuts(buckets)
    for bucket in np.flatnonzero(np.diff(cuts)):
        place = own.place[cuts[bucket]:cuts[bucket + 1]]
        steps = np.diff(place)
        width = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(steps) else 1
        for name, value in (("bucket", int(bucket)), ("block", block), ("first", int(place[0]) - (1 << 63)), ("width", width),
                            ("steps", low_bytes(steps, width)), ("checks", low_bytes(own.check[cuts[bucket]:cuts[bucket + 1]], CHECK_BYTES))):
            rows[name].append(value)
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
    return pa.Table.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), types)], names=list(rows))


def answer_rows(rows: list[dict]) -> pa.Table:
    """For each block with entries that an earlier block holds: which, and where."""
    rows = sorted(rows, key=lambda r: r["block"])
    places, checks, blocks = [], [], []
    for r in rows:
        steps = from_low_bytes(r["steps"], r["width"])
        places.append(np.uint64(r["first"] + (1 << 63)) + np.concatenate([np.zeros(1, np.uint64), np.cumsum(steps)]))
        checks.append(from_low_bytes(r["checks"], CHECK_BYTES))
        blocks.append(np.full(len(places[-1]), r["block"], np.int32))
    place, check, block = np.concatenate(places), np.concatenate(checks), np.concatenate(blocks)
    order = np.argsort(place, kind="stable")
    p, c = place[order], check[order]
    if ((p[1:] == p[:-1]) & (c[1:] != c[:-1])).any():
        order = np.lexsort((block, check, place))
        p, c = place[order], check[order]
    new = np.concatenate([[True], (p[1:] != p[:-1]) | (c[1:] != c[:-1])])
    begin = np.flatnonzero(new)
    earliest = np.empty(len(p), np.int32)
    earliest[order] = np.repeat(np.minimum.reduceat(block[order], begin), np.diff(np.append(begin, len(p))))
    seen = earliest < block
    out: dict[str, list] = {"block": [], "bucket": [], "seen": [], "earlier": []}
    at = 0
    for r, own in zip(rows, places):
        mine = seen[at:at + len(own)]
        if mine.any():
            for name, value in (("block", r["block"]), ("bucket", r["bucket"]), ("seen", np.packbits(mine).tobytes()),
                                ("earlier", earliest[at:at + len(own)][mine].astype("<i4").tobytes())):
                out[name].append(value)
        at += len(own)
    types = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.Table.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], names=list(out))


def parse(block: int, own: Block, answers: list[dict], window: int, buckets: int) -> pa.Table:
    """Factor the block's documents and remove what factors cover."""
    cuts = own.cuts(buckets)
    reference = np.full(len(own.place), -1, np.int32)
    for a in answers:
        low, high = cuts[a["bucket"]], cuts[a["bucket"] + 1]
        seen = np.unpackbits(np.frombuffer(a["seen"], np.uint8), count=high - low).astype(bool)
        reference[low:high][seen] = np.frombuffer(a["earlier"], "<i4")
    ref = reference[own.entry]
    ref = np.where((ref < 0) & own.repeated_here, block, ref)
    hit = np.flatnonzero(ref >= 0)
    at, ref = own.at[hit], ref[hit]
    doc = np.searchsorted(own.first, at, side="right") - 1
    # a factor goes on while the next word's window is found in the same block
    begins = np.concatenate([[True], (np.diff(at) != 1) | (np.diff(doc) != 0) | (np.diff(ref) != 0)])[:len(at)]
    begin = np.flatnonzero(begins)
    last = np.append(begin[1:], len(at)) - 1 if len(at) else begin
    spans = list(zip(doc[begin].tolist(), at[begin].tolist(), (at[last] + window).tolist(), ref[begin].tolist()))
    change = np.zeros(len(own.starts) + 1, np.int64)
    np.add.at(change, at[begin], 1)
    np.add.at(change, at[last] + window, -1)
    gone = np.cumsum(change[:-1]) > 0
    removed = np.concatenate([[0], np.cumsum(gone)])
    n_removed = removed[own.first[1:]] - removed[own.first[:-1]]
    per_doc: list[list] = [[] for _ in own.ids]
    for d, s, e, r in spans:
        per_doc[d].append({"start": s - int(own.first[d]), "end": e - int(own.first[d]), "block": r})
    raw, cut, first = own.data.tobytes(), own.offsets.tolist(), own.first.tolist()
    kept = []
    for d in range(len(own.ids)):
        words = raw[cut[d]:cut[d + 1]].split()
        kept.append((b" ".join(words) if not n_removed[d] else b" ".join(compress(words, ~gone[first[d]:first[d + 1]]))).decode())
    return result(own.ids, np.diff(own.first), n_removed, kept, per_doc)


def result(ids, n_words, n_removed, kept, spans) -> pa.Table:
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("block", pa.int32())]))
    return pa.Table.from_arrays([pa.array(ids, pa.int64()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string()), pa.array(spans, span)],
                                names=["doc_id", "n_words", "n_removed", "kept", "spans"])


def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in text_slices(batches):
        raw, cut = data.tobytes(), offsets.tolist()
        words = [raw[a:b].split() for a, b in zip(cut, cut[1:])]
        yield from result(batch.column("doc_id").to_pylist(), [len(w) for w in words], [0] * len(words), [b" ".join(w).decode() for w in words], [[]] * len(words)).to_batches()


def block_bounds(docs: DataFrame, block_bytes: int) -> np.ndarray:
    """The doc_ids at which the second and later blocks begin: the first ones at
    which the bytes of all texts before, in doc_id order, pass a multiple of the
    block's size. Only ids and sizes are sorted; each range of them sums its own,
    and one sum a range is added up globally."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    sizes = written(docs.select("doc_id", size.alias("size")), "substring-sizes")
    total = sizes.agg(F.sum("size")).first()[0] or 0
    step = max(block_bytes, -(-total // MOST_BLOCKS))
    ranges = written(sizes.repartitionByRange(partitions(docs.sparkSession), "doc_id").withColumn("part", F.spark_partition_id()), "substring-ranges")
    before = before_each(ranges.groupBy("part").agg(F.sum("size").alias("bytes")), "part", "bytes")
    inside = Window.partitionBy("part").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranges.join(F.broadcast(before), "part").withColumn("at", F.col("_before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))  # one row a range
    firsts = placed.groupBy(F.expr(f"at div {step}").alias("nth")).agg(F.min("doc_id").alias("first")).where("nth > 0")
    return np.unique(firsts.select("first").toArrow().column("first").to_numpy())


def remove_repeats(docs: DataFrame, window: int = 13, block_bytes: int | None = None) -> DataFrame:
    """For every row of ``docs`` (doc_id, text): doc_id, n_words, n_removed, the
    kept words joined by one space, and the factors as word spans with the
    reference block in which they were found."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    named = docs.where("doc_id is not null")
    bounds = block_bounds(named, block_bytes or BLOCK_BYTES)
    buckets = max(1, -(-(len(bounds) + 1) // BLOCKS_PER_BUCKET))

    @F.pandas_udf("int")
    def block_of(ids):
        import pandas as pd

        return pd.Series(np.searchsorted(bounds, ids.to_numpy(), side="right").astype(np.int32))

    placed = named.withColumn("block", block_of("doc_id"))

    def index(docs_of_block: pa.Table) -> pa.Table:
        return index_rows(docs_of_block.column("block")[0].as_py(), Block(docs_of_block, window), buckets)

    def answer(entries: pa.Table) -> pa.Table:
        return answer_rows(entries.to_pylist())

    def finish(docs_of_block: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs_of_block.num_rows:
            return result([], [], [], [], [])
        return parse(docs_of_block.column("block")[0].as_py(), Block(docs_of_block, window), answers.to_pylist(), window, buckets)

    entries = placed.groupBy("block").applyInArrow(index, "bucket int, block int, first long, width int, steps binary, checks binary")
    answers = entries.groupBy("bucket").applyInArrow(answer, "block int, bucket int, seen binary, earlier binary")
    parsed = placed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(finish, RESULT)
    return parsed.unionByName(docs.where("doc_id is null").mapInArrow(whole, RESULT))
