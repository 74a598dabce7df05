"""Scalar expressions: the small literal cases of FIXTURES.md section 3."""

import datetime as dt

from pyspark.sql import functions as F

from factline.functions import exprs as X


def one(spark, col, value=None, schema="x string"):
    df = spark.createDataFrame([(value,)], schema)
    return df.select(col.alias("r")).first()["r"]


def test_or_zero_decimal(spark):
    df = spark.createDataFrame([("x",), ("12.3456",), (None,)], "x string")
    got = [r[0] for r in df.select(X.or_zero_decimal("x", 18, 3)).collect()]
    assert [str(v) for v in got] == ["0.000", "12.346", "0.000"]


def test_or_zero_int(spark):
    df = spark.createDataFrame([("1-URGENT",), ("7",)], "x string")
    got = [r[0] for r in df.select(X.or_zero_int("x"), X.or_zero_int(X.split_part("x", "-", 1))).collect()]
    assert got == [0, 7]


def test_bytes_to_uuid(spark):
    df = spark.createDataFrame([(bytes(range(16)),)], "b binary")
    assert df.select(X.bytes_to_uuid("b")).first()[0] == "00010203-0405-0607-0809-0a0b0c0d0e0f"


def test_time_delta(spark):
    df = spark.createDataFrame([("",), ("5m",), ("1h 30m",), ("junk",), ("2 days",)], "x string")
    got = [r[0] for r in df.select(X.time_delta_seconds("x", 3600)).collect()]
    assert got == [3600, 300, 5400, None, 172800]


def test_topic_parts(spark):
    df = spark.createDataFrame([("Fact.T#x:1",), ("Fact.T",), ("A:2",)], "t string")
    got = [tuple(r[0]) for r in df.select(X.topic_parts("t")).collect()]
    assert got == [("Fact.T", "x", "1"), ("Fact.T", "", ""), ("A", "", "2")]


def test_time_window(spark):
    rows = [(dt.datetime(2024, 1, 1, 3, 45), "0:30-6:00"), (dt.datetime(2024, 1, 1, 23, 30), "22:00-2:00"),
            (dt.datetime(2024, 1, 1, 12, 0), "22:00-2:00"), (dt.datetime(2024, 1, 1, 12, 0), "")]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, w string")
    assert [r[0] for r in df.select(X.in_time_window("ts", "w")).collect()] == [True, True, False, True]


def test_readable(spark):
    df = spark.createDataFrame([(0,), (1023,), (1536,), (5 * 1024 ** 3,)], "x bigint")
    got = [r[0] for r in df.select(X.readable_size("x")).collect()]
    assert got == ["0.00 B", "1023.00 B", "1.50 KiB", "5.00 GiB"]
    df = spark.createDataFrame([(0,), (5400,), (90061,)], "x bigint")
    got = [r[0] for r in df.select(X.readable_delta("x")).collect()]
    assert got == ["0 seconds", "1 hour and 30 minutes", "1 day, 1 hour, 1 minute and 1 second"]
    df = spark.createDataFrame([(999,), (1500000,)], "x bigint")
    assert [r[0] for r in df.select(X.readable_quantity("x")).collect()] == ["999.00", "1.50 million"]


def test_best_effort_timestamp(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("02.01.2024",), ("nope",)], "x string")
    got = [r[0] for r in df.select(X.or_zero_timestamp("x")).collect()]
    assert got == [dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2), dt.datetime(1970, 1, 1)]
