import datetime as dt
import hashlib
from decimal import Decimal

from pyspark.sql import functions as F

from sparkmarts.functions import cents_to_dollars, day_of_week_sun0, month_start, ratio, surrogate_key
from sparkmarts.functions.columns import SURROGATE_NULL_MARKER


def test_cents_to_dollars(spark):
    df = spark.createDataFrame([(12345,), (-5,), (None,)], "c bigint")
    got = [r.d for r in df.select(cents_to_dollars("c").alias("d")).collect()]
    assert got == [Decimal("123.45"), Decimal("-0.05"), None]
    one = df.select(cents_to_dollars("c", 1).alias("d")).first().d
    assert one == Decimal("123.5")  # half up


def test_surrogate_key_nulls(spark):
    df = spark.createDataFrame([(1, 2), (None, 2), (1, None)], "a bigint, b int")
    keys = [r.k for r in df.select(surrogate_key("a", "b").alias("k")).collect()]
    assert keys[0] == hashlib.md5(b"1-2").hexdigest()
    assert keys[1] == hashlib.md5(f"{SURROGATE_NULL_MARKER}-2".encode()).hexdigest()
    assert len(set(keys)) == 3


def test_month_start_and_weekday(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 2, 29, 13, 5),)], "ts timestamp_ntz")
    r = df.select(month_start("ts").alias("m"), day_of_week_sun0(F.col("ts").cast("date")).alias("w")).first()
    assert r.m == dt.date(2024, 2, 1) and r.w == 4  # Thursday


def test_ratio_guards(spark):
    df = spark.createDataFrame([(1, 4), (1, 0), (1, None), (None, 2)], "n int, d int")
    assert [r.x for r in df.select(ratio("n", "d").alias("x")).collect()] == [0.25, None, None, None]
