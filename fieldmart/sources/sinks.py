"""Mart writers and exports.

Paths are folders of a shared file system (the cluster's
``spark.checkpoint.dir`` by default), never machine-local temp folders.
"""

from __future__ import annotations

import datetime as _dt
import time
import uuid
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmart.session import row_partitions

SUPPORTED_FORMATS = ("parquet", "csv")
DATE_KEYS = ("production_date", "event_date")


def check_format(fmt: str) -> str:
    """Only parquet and csv are written; anything else is an error."""
    if fmt not in SUPPORTED_FORMATS:
        raise ValueError(f"Unsupported file format: {fmt}")
    return fmt


def _file_system(spark: SparkSession, path: str):
    """(file system, path) of the JVM for a path's own scheme."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace a mart table. The new table is written beside the old one and takes
    its place by renames only when it is whole: a write that fails leaves the old table
    as it was, and a frame may read the table that it replaces. If the process dies
    between the two renames, the old table stands beside its place under
    ``<path>.old-...``, where :func:`read_mart` finds it."""
    check_format(fmt)
    spark, path, tag = df.sparkSession, path.rstrip("/"), uuid.uuid4().hex
    fresh, old = f"{path}.new-{tag}", f"{path}.old-{int(time.time() * 1000):013d}-{tag}"
    fs, place = _file_system(spark, path)
    new, gone = place.suffix(fresh[len(path):]), place.suffix(old[len(path):])
    try:
        _writer(df, fmt).save(fresh)
    except BaseException:
        fs.delete(new, True)
        raise
    had = fs.exists(place)
    if had and not fs.rename(place, gone):
        fs.delete(new, True)
        raise OSError(f"{path}: the old table can't be moved aside")
    if not fs.rename(new, place):
        if had:
            fs.rename(gone, place)
        raise OSError(f"{path}: the new table can't be moved into place")
    for status in fs.globStatus(place.suffix(".old-*")) or []:      # this swap's, and any that a dead process left
        fs.delete(status.getPath(), True)


def read_mart(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A mart written by :func:`write_table`: the table in place, or the latest old
    one if a swap was cut off between its renames."""
    fs, place = _file_system(spark, path.rstrip("/"))
    if not fs.exists(place):
        left = sorted(s.getPath().toString() for s in fs.globStatus(place.suffix(".old-*")) or [])
        if left:
            return _reader(spark, fmt, left[-1])
    return _reader(spark, fmt, path)


def write_jdbc(df: DataFrame, url: str, table: str, batch_size: int = 1000, properties: dict | None = None) -> None:
    """S2 over JDBC: overwrite with multi-row batches of 1,000."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", str(batch_size))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.mode("overwrite").save()


def _writer(df: DataFrame, fmt: str):
    w = df.write.format(fmt)
    return w.option("header", "true") if fmt == "csv" else w


def _reader(spark: SparkSession, fmt: str, path: str) -> DataFrame:
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.option("header", "true")
    return r.load(path)


def route_partition_key(df: DataFrame, candidates: Sequence[str] = DATE_KEYS) -> str | None:
    """The first date key present (production_date, then event_date)."""
    for c in candidates:
        if c in df.columns:
            return c
    return None


#: Spark's folder of rows without a partition value.
NO_DATE = "__HIVE_DEFAULT_PARTITION__"
MANIFEST = "dataset string, partition_value string, object string, rows_count bigint"


#: Folders that one task lists; Spark would start a task for each.
FOLDERS_A_TASK = 64


@contextmanager
def listing_tasks(spark: SparkSession, folders: int) -> Iterator[None]:
    """While it lasts, folders are listed by tasks of ``FOLDERS_A_TASK`` folders each."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    spark.conf.set(key, str(max(1, min(int(before), max(spark.sparkContext.defaultParallelism, -(-folders // FOLDERS_A_TASK))))))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def read_export(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A dataset that :func:`export_partitioned` wrote, with all its dates."""
    fs, place = _file_system(spark, path)
    with listing_tasks(spark, len(fs.listStatus(place))):
        return _reader(spark, fmt, path)


def written_objects(spark: SparkSession, path: str, dataset: str, fmt: str, partition_column: str | None, folders: Sequence[str] | None = None) -> DataFrame:
    """The files of the given partition folders (of the whole dataset without
    them) with their rows. No data column is read, so Parquet rows come from the files'
    footers; other folders are neither listed nor read."""
    reader = spark.read.format(fmt).option("basePath", path)
    if fmt == "csv":
        reader = reader.option("header", "true")
    with listing_tasks(spark, len(folders or [])):
        found = reader.load([f"{path}/{f}" for f in folders] if folders else path)
    value = F.col(partition_column).cast("string") if partition_column else F.lit(None).cast("string")
    rows = (found.select(value.alias("partition_value"), F.col("_metadata.file_path").alias("object"))
                 .groupBy("partition_value", "object").agg(F.count(F.lit(1)).alias("rows_count")))
    return rows.select(F.lit(dataset).alias("dataset"), "partition_value", "object", "rows_count")


def rows_by_date(df: DataFrame, partition_column: str) -> dict[str | None, int]:
    """The frame's dates (None: no date) with their rows: one number a day."""
    return {r[0]: r[1] for r in df.groupBy(F.col(partition_column).cast("string").alias("d")).count().collect()}


def write_dates(spread: DataFrame, path: str, dataset: str, partition_column: str, dates: Iterable[str | None], fmt: str = "parquet",
                max_records_per_file: int = 5_000_000) -> DataFrame:
    """Write rows, dealt so that a task has few dates, over the folders of the given
    dates, which are all of theirs; returns the manifest."""
    (_writer(spread, fmt).mode("overwrite").partitionBy(partition_column)
        .option("partitionOverwriteMode", "dynamic")          # per write, not session-wide
        .option("maxRecordsPerFile", str(max_records_per_file)).save(path))
    return written_objects(spread.sparkSession, path, dataset, fmt, partition_column, [f"{partition_column}={d or NO_DATE}" for d in sorted(dates, key=str)])


def export_partitioned(df: DataFrame, root: str, dataset: str, partition_column: str | None = None,
                       fmt: str = "parquet", max_records_per_file: int = 5_000_000) -> DataFrame:
    """Write ``root/dataset`` and return a manifest DataFrame
    (dataset, partition value, object, rows) of the objects written.

    * partitioned: the key is normalised to a date (a NULL date lands in
      Spark's default partition folder, T15); rows are range-partitioned on
      (date, row hash) so a hot date is split over several tasks while each
      task holds few dates (few files); dynamic overwrite replaces only the
      dates being written (T16).
    * unpartitioned (no key, or key absent): a plain overwrite.
    * empty input: nothing is written and the manifest is empty (S6).

    The manifest holds what this call wrote: a dynamic overwrite leaves exactly its own
    files in the folders of the frame's dates, and only those are looked at. The driver
    knows the frame's distinct dates, one value per day. The frame is read for them, for
    the range bounds and for the write: pass a written table when it is dear to compute."""
    check_format(fmt)
    spark = df.sparkSession
    path = f"{root.rstrip('/')}/{dataset}"
    if partition_column and partition_column in df.columns:
        work = df.withColumn(partition_column, F.to_date(F.col(partition_column)))
        dates = rows_by_date(work, partition_column)
        if not dates:
            return spark.createDataFrame([], MANIFEST)
        spread = work.repartitionByRange(row_partitions(spark, sum(dates.values())), F.col(partition_column), F.xxhash64(*[F.col(c) for c in df.columns]))
        return write_dates(spread, path, dataset, partition_column, dates, fmt, max_records_per_file)
    if df.isEmpty():
        return spark.createDataFrame([], MANIFEST)
    _writer(df, fmt).mode("overwrite").save(path)
    return written_objects(spark, path, dataset, fmt, None)


def export_marts(marts: Mapping[str, DataFrame], root: str, prefix: str = "processed",
                 fmt: str = "parquet") -> DataFrame:
    """Export each frame under ``prefix/name``, partitioned by the
    routed date key; returns the combined manifest."""
    manifests = []
    for name, df in marts.items():
        manifests.append(export_partitioned(df, root, f"{prefix}/{name}", route_partition_key(df), fmt))
    out = manifests[0]
    for m in manifests[1:]:
        out = out.unionByName(m)
    return out


def write_manifest(manifest: DataFrame, path: str, tables: Iterable[str]) -> None:
    """Run manifest (created_at UTC, written objects, tables) as JSON."""
    created = _dt.datetime.now(_dt.timezone.utc).isoformat()
    (manifest.withColumn("created_at", F.lit(created))
             .withColumn("tables", F.array(*[F.lit(t) for t in tables]))
             .coalesce(1).write.mode("overwrite").json(path))


def write_report(metrics: DataFrame, path: str) -> None:
    """Model metrics as JSON records."""
    metrics.coalesce(1).write.mode("overwrite").json(path)


def execute_sql(spark: SparkSession, statements: Iterable[str]) -> list[DataFrame]:
    """Run statements in order, skipping blank ones, all or nothing: they run in a
    copy of the session, with its settings and views, and the views that they made,
    replaced or dropped are published to the session together after the last one. If one
    fails, the copy is dropped and the session is as before. Each frame reads the views
    as its statement saw them. Statements that write tables of a shared catalog take
    effect at once; Spark has no transaction over several of them."""
    staged = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())

    def views(session: SparkSession) -> dict:
        catalog = session._jsparkSession.sessionState().catalog()
        names = catalog.getTempViewNames()
        return {n: catalog.getRawTempView(n).get() for n in (names.apply(i) for i in range(names.size()))}

    active, start = SparkSession.getActiveSession(), views(staged)
    try:
        out = [staged.sql(s) for s in statements if s.strip()]
    finally:
        if active is not None:
            spark.sparkContext._jvm.org.apache.spark.sql.classic.SparkSession.setActiveSession(spark._jsparkSession)
    end = views(staged)
    for name in start.keys() - end.keys():
        spark.catalog.dropTempView(name)
    for name, view in end.items():       # only what the statements changed
        if name not in start or not view.equals(start[name]):
            spark._jsparkSession.sessionState().catalog().createTempView(name, view, True)
    return out


def read_sql(spark: SparkSession, text: str) -> DataFrame:
    """A SELECT over registered views."""
    return spark.sql(text)
