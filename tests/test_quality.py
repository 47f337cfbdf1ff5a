"""Integrity checks (C1-C5) and the entity calendar."""

import datetime as dt

from pyspark.sql.types import LongType, StringType, StructField, StructType

from fieldmart.operators import joins, quality


def test_c1_c2_c3(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "x")], "k int, fk string")
    assert quality.null_counts(df).first().nulls_fk == 1
    assert [tuple(r) for r in quality.duplicate_keys(df, ["k"]).collect()] == [(1, 2)]
    dim = spark.createDataFrame([("a",)], "id string")
    assert [r.fk for r in quality.orphan_keys(df, "fk", dim, "id").collect()] == ["x"]


def test_c4_missing_days(spark):
    df = spark.createDataFrame([(1, dt.date(2026, 1, 1)), (1, dt.date(2026, 1, 4)), (2, dt.date(2026, 1, 2))],
                               "e int, day date")
    out = sorted((r.e, r.day.day) for r in joins.missing_days(df, "e", "day").collect())
    assert out == [(1, 2), (1, 3)]


def test_c5_check_schema(spark):
    df = spark.createDataFrame([(1, "a")], "k long, s string")
    ok = StructType([StructField("k", LongType()), StructField("s", StringType())])
    assert quality.check_schema(df, ok) == []
    bad = StructType([StructField("k", StringType()), StructField("z", StringType())])
    probs = quality.check_schema(df, bad)
    assert any("missing column z" in p for p in probs) and any("column k" in p for p in probs)
