"""Helpers shared by the operators: table reads, written intermediates, row
numbers, and vectorised word spans over Arrow string columns."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import fieldmart
from fieldmart.session import materialize, scratch_path

#: Words are runs of anything but these six ASCII characters.
WORD = r"[^\x20\x09-\x0D]+"
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True

#: Text bytes that one vectorised step handles (temporaries are about ten times that).
SLICE_BYTES = 4 << 20


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package as a zip file in the shared folder, once
    per application (the functions run inside tasks import it)."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root, packed = Path(fieldmart.__file__).parent, io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"fieldmart/{p.relative_to(root)}")
    name = scratch_path(spark, "packages", app, "fieldmart_package.zip")
    to = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    out = to.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(to)
    out.write(bytearray(packed.getvalue()))
    out.close()
    spark.sparkContext.addPyFile(name)
    _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table written under the cluster's shared folder."""
    return materialize(df, f"llm-{name}")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def number_rows(df: DataFrame, order: list, name: str, into: str = "row_number", parts: int | None = None) -> DataFrame:
    """``df`` with dense global row numbers from 0 in ``order``, as a written
    table. The rows are range-partitioned and sorted; the position inside a
    partition (low 33 bits of ``monotonically_increasing_id``, whose layout
    the function's documentation fixes) is written with them, so numbers never
    change afterwards. Only one count per partition is summed globally."""
    n = parts or partitions(df.sparkSession)
    placed = written(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                     .withColumn("_mid", F.monotonically_increasing_id()), name)
    placed = (placed.withColumn("_part", F.shiftrightunsigned("_mid", 33).cast("int"))
              .withColumn("_at", F.col("_mid").bitwiseAND((1 << 33) - 1)))
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    return (placed.join(F.broadcast(before_each(counts, "_part", "_n")), "_part")  # one row per partition
            .withColumn(into, F.col("_before") + F.col("_at")).drop("_mid", "_part", "_at", "_before"))


def before_each(counts: DataFrame, key: str, amount: str) -> DataFrame:
    """(key, _before): the sum of ``amount`` over all smaller keys. ``counts``
    holds one row per partition of a table, so a single task can sum it."""
    from pyspark.sql import Window

    w = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(F.col(key), F.coalesce(F.sum(amount).over(w), F.lit(0)).alias("_before"))


def text_slices(batches: Iterator[pa.RecordBatch], limit: int | None = None) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(batch, bytes, offsets) over runs of rows with at most ``limit`` text
    bytes (a longer text is a run of its own). Column ``text``; null is empty."""
    limit = limit or SLICE_BYTES
    for batch in batches:
        at = batch.schema.get_field_index("text")
        text = batch.column(at)
        if text.null_count:
            text = text.fill_null("")
            batch = batch.set_column(at, "text", text)
        if not len(text):
            continue
        wide = pa.types.is_large_string(text.type)
        offsets = np.frombuffer(text.buffers()[1], dtype=np.int64 if wide else np.int32)[text.offset:text.offset + len(text) + 1].astype(np.int64)
        data = np.frombuffer(text.buffers()[2], dtype=np.uint8) if text.buffers()[2] else np.zeros(0, np.uint8)
        first = 0
        while first < len(text):
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
            yield batch.slice(first, last - first), data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
            first = last


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte spans of all words, and for each text the
    index of its first word (one more entry at the end)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    solid = ~IS_SPACE[data]
    begins, stops = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    stops[:-1] &= ~solid[1:]
    edge = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]  # texts touch without a space between them
    begins[edge] = solid[edge]
    stops[edge - 1] = solid[edge - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def strings_at(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans as an Arrow binary array."""
    lengths = ends - starts
    stop = np.cumsum(lengths)
    where = np.repeat(starts - (stop - lengths), lengths) + np.arange(int(stop[-1]) if len(stop) else 0)
    offsets = np.concatenate([[0], stop]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[where])])


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """flat[starts[i]:starts[i] + lengths[i]] for all i, one after the other."""
    stop = np.cumsum(lengths)
    total = int(stop[-1]) if len(stop) else 0
    return flat[np.repeat(starts - (stop - lengths), lengths) + np.arange(total)]


def components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node that the edges (a, b) connect it to."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while True:
            jump = new[new]
            if (jump == new).all():
                break
            new = jump
        label = new
        left = label[a] != label[b]
        a, b = a[left], b[left]
    return label
