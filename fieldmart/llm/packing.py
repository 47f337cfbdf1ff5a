"""Best-fit decreasing packing of documents into fixed-size sequences.

Documents become pieces of at most ``capacity`` tokens; only longer documents
are cut, and their first piece takes the remainder. Best-fit decreasing handles
pieces from long to short and puts each into the open bin with the smallest
remaining capacity that holds it. Pieces of one length are interchangeable, and
so are bins with the same remaining capacity, so the packing of the whole corpus
follows from the counts by length alone (at most ``capacity`` numbers): a
segment tree over remaining capacities finds the tightest class of open bins in
logarithmic time, and a whole class is filled in one step. The result is exactly
what handling the pieces one by one gives. The plan, whose size depends on the
capacity only, maps (length, rank among its length) to (bin, offset); ranks are
global row numbers in order of length, so one length may hold most pieces.

Null or empty text: a document of the end id alone. Null doc_id and repeated
rows: packed like any other row. Empty table: no rows. Extra columns are
ignored."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmart.llm.common import number_rows, text_slices, written
from fieldmart.llm.tokens import encoder


class OpenBins:
    """Segment tree over remaining capacities 0..capacity; a node tells whether
    any bin with a capacity below it is open."""

    def __init__(self, capacity: int):
        self.width = 1 << capacity.bit_length()
        self.any = [False] * (2 * self.width)
        self.classes: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # runs (first bin, bins)

    def _mark(self, left: int) -> None:
        at = self.width + left
        self.any[at] = bool(self.classes[left])
        while at > 1:
            at //= 2
            self.any[at] = self.any[2 * at] or self.any[2 * at + 1]

    def add(self, left: int, first: int, bins: int) -> None:
        if bins and left:
            self.classes[left].append((first, bins))
            self._mark(left)

    def take(self, left: int, bins: int) -> tuple[int, int]:
        """At most so many bins of the class, as one run."""
        first, there = self.classes[left].pop()
        if there > bins:
            self.classes[left].append((first + bins, there - bins))
        self._mark(left)
        return first, min(bins, there)

    def tightest(self, need: int) -> int | None:
        """Smallest remaining capacity >= need of any open bin."""
        at = self.width + need
        if self.any[at]:
            return need
        while at > 1:  # up until a right sibling holds an open bin, then down to its leftmost
            if at % 2 == 0 and self.any[at + 1]:
                at += 1
                while at < self.width:
                    at = 2 * at if self.any[2 * at] else 2 * at + 1
                return at - self.width
            at //= 2
        return None


def plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Rows (length, first rank, ranks, first bin, offset), by length and rank:
    the pieces of these ranks go to consecutive bins at this offset."""
    bins, rows, opened = OpenBins(capacity), [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = bins.tightest(length)
            if room is None:
                room, n = capacity, -(-left // (capacity // length))
                first, opened = opened, opened + n
            else:
                first, n = bins.take(room, -(-left // (room // length)))
            # a bin that takes one piece is the tightest for the next, so each is filled in turn
            each = room // length
            full, rest = (n, 0) if left >= n * each else divmod(left, each)
            for k in range(each):
                there = full + (k < rest)
                if there:
                    rows.append((length, rank, there, first, capacity - room + k * length))
                    rank, left = rank + there, left - there
            bins.add(room - each * length, first, full)
            if rest:
                bins.add(room - rest * length, first + full, 1)
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) and, if asked for, ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, end_id).encode
        for batch, data, offsets in text_slices(batches):
            ids, ends = encode(data, offsets)
            sizes = np.diff(ends, prepend=0)
            n = -(-sizes // capacity)
            doc = np.repeat(np.arange(len(n)), n)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            short = sizes - (n - 1) * capacity  # the first piece takes the remainder
            start = np.where(piece == 0, 0, short[doc] + (piece - 1) * capacity)
            length = np.where(piece == 0, short[doc], capacity)
            low = (ends - sizes)[doc] + start
            raw = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(low.tolist(), (low + length).tolist())]
            out = [batch.column("doc_id").take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                out.append(pa.ListArray.from_arrays(pa.array(np.append(low, len(ids)), pa.int32()), pa.array(ids.astype(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names=names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def pack(items: DataFrame, capacity: int, order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """``items`` (a table with a column length, 1 to capacity) with sequence_id
    and offset of the best-fit decreasing packing."""
    counts = {r["length"]: r["count"] for r in items.groupBy("length").count().collect()}  # at most `capacity` rows
    steps = plan(counts, capacity)
    before, total = {}, 0
    for length in sorted(counts):
        before[length], total = total, total + counts[length]
    first_row = np.array([before[x] for x in steps[:, 0]], np.int64) + steps[:, 1] if len(steps) else np.zeros(0, np.int64)
    numbered = number_rows(items, ["length", *order], "pack-pieces")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column("row_number").to_numpy(zero_copy_only=False)
            at = np.searchsorted(first_row, row, side="right") - 1
            kept = batch.drop_columns(["row_number"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(steps[at, 3] + row - first_row[at]), pa.array(steps[at, 4])],
                                             names=[*kept.schema.names, "sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema.fields)
    return numbered.mapInArrow(place, f"{fields}, sequence_id long, `offset` long")


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = 1024, with_ids: bool = False) -> DataFrame:
    """Every piece of every document with its place."""
    return pack(written(pieces(docs, tokenizer, end_id, capacity, with_ids), "pieces"), capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed sequences from placed pieces with ids; a
    sequence holds at most ``capacity`` ids, so a group is small."""
    return (placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
            .select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids")))
