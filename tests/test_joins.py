import datetime as dt
import random

from pyspark.sql import functions as F

from pulsehouse.operators import (attach_readings, interval_join, pair_actions,
                                  visit_report)

T = dt.datetime


def _visits(spark, rows):
    return spark.createDataFrame(rows, "mac_address string, gym long, login timestamp_ntz, "
                                       "logout timestamp_ntz")


def _sessions(spark, rows):
    return spark.createDataFrame(rows, "mac_address string, session_id int, "
                                       "start_time timestamp_ntz, end_time timestamp_ntz")


def test_visit_report_edges(spark):
    visits = _visits(spark, [
        ("m1", 1, T(2024, 1, 1, 8), T(2024, 1, 1, 10)),
        ("m1", 2, T(2024, 1, 1, 9), T(2024, 1, 1, 11)),     # overlaps the first
        ("m2", 1, T(2024, 1, 1, 8), None),                  # still open
    ])
    sessions = _sessions(spark, [
        ("m1", 1, T(2024, 1, 1, 9, 30), T(2024, 1, 1, 9, 45)),   # inside both visits
        ("m1", 2, T(2024, 1, 1, 8), T(2024, 1, 1, 8, 30)),       # exactly at login
        ("m1", 3, T(2024, 1, 1, 11), T(2024, 1, 1, 11, 5)),      # exactly at logout of 2
        ("m1", 4, T(2024, 1, 1, 11, 0, 1), T(2024, 1, 1, 12)),   # 1 s after: outside
        ("m2", 5, T(2024, 1, 1, 9), T(2024, 1, 1, 9, 10)),       # NULL logout
    ])
    for strategy in ("range", "bucketed"):
        out = visit_report(visits, sessions, keep=["gym", "session_id"],
                           strategy=strategy, bucket_seconds=3600).collect()
        got = sorted((r.session_id, r.gym) for r in out)
        assert got == [(1, 1), (1, 2), (2, 1), (3, 2)], strategy
        m = {(r.session_id, r.gym): (r.minutes_in_gym, r.minutes_exercising) for r in out}
        assert m[(1, 1)] == (120.0, 15.0)
        assert all(r.date == dt.date(2024, 1, 1) for r in out)


def test_bucketed_equals_range_random(spark):
    rnd = random.Random(7)
    base = T(2024, 1, 1)
    pts, rngs = [], []
    for i in range(400):
        k = rnd.choice(["a", "b", "c", "hot", "hot", "hot"])
        pts.append((k, i, base + dt.timedelta(minutes=rnd.randint(0, 20000))))
    for j in range(120):
        k = rnd.choice(["a", "b", "hot"])
        lo = base + dt.timedelta(minutes=rnd.randint(0, 20000))
        hi = None if j % 17 == 0 else lo + dt.timedelta(minutes=rnd.randint(0, 5000))
        rngs.append((k, j, lo, hi))
    p = spark.createDataFrame(pts, "k string, pid int, t timestamp_ntz")
    r = spark.createDataFrame(rngs, "k string, rid int, lo timestamp_ntz, hi timestamp_ntz")
    a = interval_join(p, r, ["k"], "t", "lo", "hi", strategy="range")
    for width in (600, 86_400, 7 * 86_400):
        b = interval_join(p, r, ["k"], "t", "lo", "hi", bucket_seconds=width)
        assert a.count() == b.count()
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    brute = sum(1 for (k, _, t) in pts for (k2, _, lo, hi) in rngs
                if k == k2 and hi is not None and lo <= t <= hi)
    assert a.count() == brute


def test_pairing_needs_a_later_stop(spark):
    ev = spark.createDataFrame([
        (1, 10, "start", T(2024, 1, 1, 8)), (1, 10, "stop", T(2024, 1, 1, 9)),
        (1, 11, "start", T(2024, 1, 1, 8)),                       # no stop yet
        (2, 12, "stop", T(2024, 1, 1, 7)), (2, 12, "start", T(2024, 1, 1, 8)),  # stop first
    ], "user_id int, session_id int, action string, time timestamp_ntz")
    out = pair_actions(ev, ["user_id", "session_id"], "time", "action", "start", "stop")
    rows = out.collect()
    assert [(r.user_id, r.session_id) for r in rows] == [(1, 10)]
    assert rows[0].start_time == T(2024, 1, 1, 8) and rows[0].end_time == T(2024, 1, 1, 9)


def test_readings_attach_inclusive_and_valid_only(spark):
    sessions = spark.createDataFrame(
        [(1, 7, T(2024, 1, 1, 8), T(2024, 1, 1, 9))],
        "user_id int, session_id int, start_time timestamp_ntz, end_time timestamp_ntz")
    bridge = spark.createDataFrame([(100, 1)], "device_id long, user_id int")
    readings = spark.createDataFrame([
        (100, T(2024, 1, 1, 8), 80.0, True), (100, T(2024, 1, 1, 9), 90.0, True),
        (100, T(2024, 1, 1, 9, 0, 1), 95.0, True), (100, T(2024, 1, 1, 8, 30), -1.0, False),
    ], "device_id long, time timestamp_ntz, heartrate double, valid boolean")
    out = attach_readings(readings, sessions, ["user_id"], bridge=bridge,
                          bridge_on=["device_id"], bucket_seconds=1800)
    assert sorted(r.heartrate for r in out.collect()) == [80.0, 90.0]


def test_long_ranges_are_copied_to_few_buckets(spark):
    """99 ten-minute sessions, one of 54 years and one of the whole calendar: no range
    is copied more than WIDER + 1 times, and the result is that of the plain join."""
    from pulsehouse.operators import joins
    base = T(2024, 1, 1)
    rngs = [("a", i, base + dt.timedelta(hours=i), base + dt.timedelta(hours=i, minutes=10)) for i in range(99)]
    rngs += [("a", 99, T(1970, 1, 1), base), ("a", 100, T(1, 1, 1), T(9999, 12, 31)), ("b", 101, base, base),
             ("a", 102, base, T(2023, 1, 1)), ("a", 103, None, base)]
    pts = [("a", i, base + dt.timedelta(minutes=7 * i)) for i in range(800)] + [("b", 900, base), ("a", 901, T(1960, 5, 5))]
    r = spark.createDataFrame(rngs, "k string, rid int, lo timestamp_ntz, hi timestamp_ntz")
    p = spark.createDataFrame(pts, "k string, pid int, t timestamp_ntz")
    a = interval_join(p, r, ["k"], "t", "lo", "hi", strategy="range")
    for base_width in (1, 60, 86_400):
        b = interval_join(p, r, ["k"], "t", "lo", "hi", bucket_seconds=base_width)
        assert sorted(map(tuple, b.collect())) == sorted(map(tuple, a.collect()))
    width = joins._width(joins._level(joins.epoch_seconds("hi") - joins.epoch_seconds("lo"), 60), 60)
    copies = r.where("hi >= lo").select((joins._bucket("hi", width) - joins._bucket("lo", width) + 1).alias("n"))
    assert copies.agg(F.max("n")).first()[0] <= joins.WIDER + 1


def test_interval_join_without_ranges(spark):
    p = spark.createDataFrame([("a", 1, T(2024, 1, 1))], "k string, pid int, t timestamp_ntz")
    r = spark.createDataFrame([("a", 1, T(2024, 1, 2), T(2024, 1, 1))], "k string, rid int, lo timestamp_ntz, hi timestamp_ntz")
    assert interval_join(p, r, ["k"], "t", "lo", "hi").count() == 0


def test_hot_key_is_spread_over_buckets(spark):
    """A key holding a third of the rows is split over many (key, bucket)
    join groups; the result still equals the plain range join."""
    base = T(2024, 1, 1)
    n = 3000
    pts = [("hot" if i % 3 == 0 else f"k{i % 50}", i, base + dt.timedelta(hours=i))
           for i in range(n)]
    rngs = [("hot" if j % 3 == 0 else f"k{j % 50}", j, base + dt.timedelta(hours=10 * j),
             base + dt.timedelta(hours=10 * j + 5)) for j in range(300)]
    p = spark.createDataFrame(pts, "k string, pid int, t timestamp_ntz")
    r = spark.createDataFrame(rngs, "k string, rid int, lo timestamp_ntz, hi timestamp_ntz")
    width = 6 * 3600
    buckets = (p.where("k = 'hot'")
               .select(F.floor(F.unix_timestamp("t") / width).alias("b")).distinct().count())
    assert buckets > 100           # the hot key's points fall in many join groups
    a = interval_join(p, r, ["k"], "t", "lo", "hi", strategy="range")
    b = interval_join(p, r, ["k"], "t", "lo", "hi", bucket_seconds=width)
    assert a.count() == b.count() > 0
    assert b.exceptAll(a).count() == 0


def test_keys_with_few_ranges_are_joined_without_copies(spark, monkeypatch):
    """Points of such keys are neither copied by level nor dealt by bucket; a key with many
    ranges still is, and the rows are those of the plain join, NULL keys and twins included."""
    from pulsehouse.operators import joins
    base = T(2024, 1, 1)
    pts = [(k, i, base + dt.timedelta(hours=i)) for i in range(60) for k in ("a", "b", None)] + [("a", 5, base)] * 2
    few = [("a", j, base + dt.timedelta(hours=5 * j), base + dt.timedelta(days=j)) for j in range(4)] + [(None, 9, base, base)]
    many = [("b", 10 + j, base + dt.timedelta(hours=j), base + dt.timedelta(hours=j + j % 7)) for j in range(30)]
    p = spark.createDataFrame(pts, "k string, pid int, t timestamp_ntz")
    ddl = "k string, rid int, lo timestamp_ntz, hi timestamp_ntz"
    monkeypatch.setattr(joins, "FEW", 4)
    for rows, copied in ((few, False), (few + many, True), (many, True)):
        r = spark.createDataFrame(rows, ddl)
        a = interval_join(p, r, ["k"], "t", "lo", "hi", strategy="range")
        b = interval_join(p, r, ["k"], "t", "lo", "hi")
        assert a.count() > 0 and sorted(map(tuple, b.collect())) == sorted(map(tuple, a.collect()))
        assert ("Generate" in b._jdf.queryExecution().optimizedPlan().toString()) is copied


def test_a_bridge_is_joined_to_the_sessions(spark):
    """Readings meet sessions by device: they are shuffled once, and come with the same columns."""
    sessions = spark.createDataFrame([(1, 7, T(2024, 1, 1, 8), T(2024, 1, 1, 9)), (2, 8, T(2024, 1, 1, 8), T(2024, 1, 2))],
                                     "user_id int, session_id int, start_time timestamp_ntz, end_time timestamp_ntz")
    bridge = spark.createDataFrame([(100, 1), (100, 2), (200, 2), (None, 1)], "device_id long, user_id int")
    readings = spark.createDataFrame([(100, T(2024, 1, 1, 8), 80.0), (200, T(2024, 1, 1, 12), 90.0), (None, T(2024, 1, 1, 8), 70.0)],
                                     "device_id long, time timestamp_ntz, heartrate double")
    out = attach_readings(readings, sessions, ["user_id"], valid_col=None, bridge=bridge, bridge_on=["device_id"])
    assert out.columns == ["device_id", "time", "heartrate", "user_id", "session_id", "start_time", "end_time"]
    assert sorted((r.device_id, r.user_id, r.session_id) for r in out.collect()) == [(100, 1, 7), (100, 2, 8), (200, 2, 8)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("device_id") < plan.index("heartrate") and plan.count("Join") == 2
    first = next(x for x in plan.splitlines() if "Join" in x)
    assert "device_id" in first and "user_id" not in first
