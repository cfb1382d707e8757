import datetime as dt

from pyspark.sql import functions as F

from pulsehouse.functions import (age_bin, age_years, bin_labels, decode_envelope,
                                  epoch_seconds, epoch_to_timestamp, flatten,
                                  minutes_between, to_envelope, to_wall, validity,
                                  week_part)
from pulsehouse.schemas import AGE_EDGES


def test_epoch_fraction_and_nan(spark):
    df = spark.createDataFrame([(1700000000.25,), (float("nan"),), (None,)], "x double")
    out = [r.t for r in df.select(to_wall(epoch_to_timestamp("x")).alias("t")).collect()]
    assert out[0] == dt.datetime(2023, 11, 14, 22, 13, 20, 250000)
    assert out[1] is None and out[2] is None


def test_epoch_seconds_floors(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'1969-12-31 23:59:59.5' AS t, "
                   "TIMESTAMP_NTZ'2024-01-01 00:00:01.9' AS u")
    r = df.select(epoch_seconds("t").alias("a"), epoch_seconds("u").alias("b")).first()
    assert r.a == -1 and r.b == 1704067201


def test_minutes_between_rounds_two_places(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:00' a, "
                   "TIMESTAMP_NTZ'2024-01-01 00:01:01' b")
    assert df.select(minutes_between("a", "b").alias("m")).first().m == 1.02


def test_week_part_iso(spark):
    df = spark.sql("SELECT DATE'2021-01-01' d, DATE'2024-01-01' e, DATE'2020-12-31' f")
    r = df.select(week_part("d").alias("a"), week_part("e").alias("b"),
                  week_part("f").alias("c")).first()
    assert (r.a, r.b, r.c) == ("2020-53", "2024-01", "2020-53")


def test_age_born_29_february(spark):
    df = spark.sql("SELECT DATE'2000-02-29' dob, DATE'2024-02-28' r1, DATE'2024-02-29' r2, "
                   "DATE'2023-02-28' r3")
    r = df.select(age_years("dob", "r1").alias("a"), age_years("dob", "r2").alias("b"),
                  age_years("dob", "r3").alias("c")).first()
    assert (r.a, r.b, r.c) == (23, 24, 22)


def test_age_bins_labels(spark):
    labels = bin_labels(AGE_EDGES)
    assert labels[0] == "under 18" and labels[1] == "18-24" and labels[-1] == "95+"
    df = spark.createDataFrame([(5,), (18,), (24,), (25,), (95,), (None,), (-1,)], "a int")
    got = [r.b for r in df.select(age_bin("a").alias("b")).collect()]
    assert got == ["under 18", "18-24", "18-24", "25-34", "95+", "invalid", "invalid"]


def test_validity_flags_without_dropping(spark):
    df = spark.createDataFrame([(80.0,), (-1.0,), (None,)], "heartrate double")
    got = [r.v for r in df.select(validity("heartrate > 0").alias("v")).collect()]
    assert got == [True, False, False]
    assert df.withColumn("v", validity("heartrate > 0")).count() == 3


def test_malformed_json_gives_nulls(spark):
    df = spark.createDataFrame([("1", '{"k": 5}'), ("2", "{bad"), ("3", None)],
                               "id string, props string")
    env = to_envelope(df, key="id", topic=F.lit("t"), value_col="props")
    out = flatten(decode_envelope(env, "k INT"), "value").orderBy("key").collect()
    assert [r.k for r in out] == [5, None, None]


def test_envelope_round_trip_keeps_microseconds(spark):
    df = spark.sql("SELECT 7L AS id, TIMESTAMP_NTZ'2024-01-01 00:00:01.123456' AS ts, "
                   "6.55D AS v")
    env = to_envelope(df, key="id", topic=F.lit("t"), timestamp="ts")
    back = flatten(decode_envelope(env, "id LONG, ts TIMESTAMP_NTZ, v DOUBLE",
                                   ts_as_long=False), "value").first()
    assert back.key == "7" and back.v == 6.55
    assert back.ts == dt.datetime(2024, 1, 1, 0, 0, 1, 123456)


def test_epochs_out_of_range_become_null(spark):
    from pulsehouse.functions.time import epoch_to_timestamp
    rows = [(1.7e9,), (1.7e15,), (-1e300,), (float("nan"),), (None,), (253402300799.0,), (-62135596800.0,)]
    out = spark.createDataFrame(rows, "x double").select(epoch_to_timestamp("x").isNotNull().alias("ok"))
    assert [r.ok for r in out.collect()] == [True, False, False, False, False, True, True]
    out = spark.createDataFrame([(1_700_000_000_000_000,), (1_700_000_000,)], "x long").select(
        epoch_to_timestamp("x").isNull().alias("no"))
    assert [r.no for r in out.collect()] == [True, False]
