"""S1 ``read_table``: full-table reads as lazy DataFrames.

Parquet is the default; column pruning and filter pushdown reach the scan
because nothing here touches the data. JDBC reads are split on a numeric key
into ``num_partitions`` range queries so that no single task pulls a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType


def read_table(spark: SparkSession, root: str, name: str, fmt: str = "parquet",
               schema: StructType | None = None) -> DataFrame:
    """Read ``{root}/{name}.{fmt}`` (a file or a dataset folder)."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", "true")
    return reader.load(f"{root.rstrip('/')}/{name}.{fmt}")


#: Parts into which one counting query cuts a range of keys.
CUTS = 256


def balanced_ranges(count, lower: int, upper: int, ranges: int) -> list[tuple[int, int]]:
    """At most ``ranges`` key ranges [a, b] that together cover [lower, upper], with nearly
    equal rows unless a single key has more. ``count(a, width, b)`` gives (part, rows) of
    the parts of equal width of [a, b]; parts with more than an eighth of a range's share
    are cut again, so no range exceeds its share by more than that."""
    done: list[tuple[int, int, int]] = []
    todo, total = [(lower, upper)], None
    while todo:
        further = []
        for a, b in todo:
            width = -(-(b - a + 1) // CUTS)
            found = [(a + k * width, min(a + (k + 1) * width - 1, b), n) for k, n in count(a, width, b)]
            total = sum(n for *_, n in found) if total is None else total
            for x, y, n in found:
                if n * ranges * 8 > total and y > x:
                    further.append((x, y))
                else:
                    done.append((x, y, n))
        todo = further
    starts, before = {}, 0
    for a, _, n in sorted(done):
        starts.setdefault(before * ranges // total, a)
        before += n
    # parts without rows belong to the range before them
    first = [lower, *sorted(starts.values())[1:]]
    return [(a, b - 1) for a, b in zip(first, [*first[1:], upper + 1])]


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None, num_partitions: int | None = None,
              properties: dict | None = None, quote: str = '"') -> DataFrame:
    """S1 over JDBC: parallel range reads on the serial key when given. With explicit
    bounds the ranges have equal widths. Without, the database counts rows per part of
    the key's span (a grouped query of at most ``CUTS`` rows, again where it is dense)
    and the ranges have nearly equal rows, however uneven the keys are. The key is
    quoted with ``quote``, standard SQL double quotes by default; rows without a key are
    in the first range. ``num_partitions`` defaults to the session's parallelism."""
    num_partitions = num_partitions or spark.sparkContext.defaultParallelism

    def reader():
        r = spark.read.format("jdbc").option("url", url)
        for k, v in (properties or {}).items():
            r = r.option(k, v)
        return r

    r = reader().option("dbtable", table)
    if partition_column is None:
        return r.load()
    q = f"{quote}{partition_column}{quote}"
    if lower is not None and upper is not None:
        return (r.option("partitionColumn", partition_column).option("lowerBound", str(int(lower))).option("upperBound", str(int(upper)))
                .option("numPartitions", str(num_partitions)).load())
    b = reader().option("query", f"SELECT MIN({q}) AS lo, MAX({q}) AS hi FROM {table}").load().first()
    if b[0] is None:                      # empty table, or keys all missing: a single plain read
        return r.load()

    def count(first: int, width: int, last: int) -> list[tuple[int, int]]:
        parts = f"SELECT ({q} - {first}) / {width} AS part FROM {table} WHERE {q} BETWEEN {first} AND {last}"
        return [(int(x[0]), int(x[1])) for x in reader().option("query", f"SELECT part, COUNT(*) AS n FROM ({parts}) parts GROUP BY part").load().collect()]

    ranges = balanced_ranges(count, int(b[0]), int(b[1]), num_partitions)
    conditions = [f"{q} >= {x} AND {q} <= {y}" for x, y in ranges]
    conditions[0] = f"({conditions[0]}) OR {q} IS NULL"
    return spark.read.jdbc(url, table, predicates=conditions, properties=properties or {})


def nan_to_null_all(df: DataFrame) -> DataFrame:
    """The source boundary rule: NaN becomes NULL in every
    floating column, so no operator sees NaN."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(F.when(F.isnan(F.col(f.name)), F.lit(None)).otherwise(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def register_views(spark: SparkSession, frames: dict[str, DataFrame]) -> None:
    """Expose DataFrames to SQL text (S11) as temporary views."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
