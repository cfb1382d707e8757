"""Rejected records, observed expectations, open sessions, partition compaction, digests."""
import datetime as dt
import json
import pathlib

import pytest
from pyspark.sql import functions as F

from pulsehouse.operators.maintenance import compact_partitions, partition_files
from pulsehouse.operators.quality import tables_differ
from pulsehouse.plans.layered import lakehouse
from pulsehouse.schemas import JSON_OPTIONS, PAYLOADS, REGISTRATION_CSV
from pulsehouse.session import scratch_dir
from pulsehouse.sources.files import parquet_stream
from pulsehouse.streaming.finals import dropped, file_by_time, final_windows, late_rows
from pulsehouse.streaming.ingest import (CORRUPT, Observed, checked_csv_stream, csv_fault, expect, payload_fault,
                                         split_rejects)
from pulsehouse.streaming.runner import await_queries, start_stream


def _folder(root, *parts):
    p = pathlib.Path(root.removeprefix("file:")).joinpath(*parts)
    p.mkdir(parents=True, exist_ok=True)
    return p


def test_lines_are_accepted_or_rejected(spark):
    root = scratch_dir(spark, "test_rejects")
    lines = ["1,10,aa,5.5", "bad,11,bb,6", "2,12,cc", "3,13,dd,7,8", "4,x,ee,y", ",,,", '5,14,"f,f",9', "6,15,,"]
    landing = _folder(root, "landing")

    def run():
        src = checked_csv_stream(spark, f"{root}/landing", REGISTRATION_CSV)
        fault = F.when(F.col(CORRUPT).isNotNull(), csv_fault(REGISTRATION_CSV))
        await_queries([start_stream(src, f"{root}/_ckpt", foreach_batch=split_rejects(
            f"{root}/good", f"{root}/bad", fault, CORRUPT))])
    (landing / "a.csv").write_text("\n".join(["h1,h2,h3,h4", *lines]) + "\n")
    run()
    (landing / "b.csv").write_text("h1,h2,h3,h4\n9,bad,zz,1\n")
    run()
    good, bad = spark.read.parquet(f"{root}/good"), spark.read.parquet(f"{root}/bad")
    assert good.count() + bad.count() == len(lines) + 1
    assert {(r.user_id, r.device_id, r.mac_address) for r in good.collect()} == {
        (1, 10, "aa"), (5, 14, "f,f"), (None, None, None), (6, 15, None)}
    told = {r.text: (r.reason, r.source_file.rsplit("/", 1)[1]) for r in bad.collect()}
    assert told == {"bad,11,bb,6": ("no value for user_id", "a.csv"), "2,12,cc": ("3 of 4 fields", "a.csv"),
                    "3,13,dd,7,8": ("too many fields", "a.csv"),
                    "4,x,ee,y": ("no value for device_id, registration_timestamp", "a.csv"),
                    "9,bad,zz,1": ("no value for device_id", "b.csv")}


def test_payload_faults(spark):
    ok = '{"device_id": 1, "time": 2.5, "heartrate": 80.0, "more": []}'
    rows = [(ok, None), ("{bad", "not a JSON object"), ("[1]", "not a JSON object"), (None, "no payload"),
            ('{"device_id": "x", "time": 1.0}', "a value does not fit its column"), ("{}", None), ("", "not a JSON object")]
    df = spark.createDataFrame(rows, "value string, want string")
    got = df.withColumn("got", payload_fault("value", PAYLOADS["bpm"], JSON_OPTIONS)).collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_layers_keep_rejects(spark):
    """Lines and messages that do not fit reach no silver table and can be found again."""
    root = scratch_dir(spark, "test_layer_rejects")
    (_folder(root, "landing", "registrations") / "a.csv").write_text(
        "user_id,device_id,mac_address,registration_timestamp\n1,10,aa,5\nbad,11,bb,6\n")
    _folder(root, "landing", "gym_logins")
    messages = [("bpm", '{"device_id": 10, "time": 7.0, "heartrate": 60.0}'), ("bpm", "{bad"), ("other", "{bad"),
                ("workout", '{"user_id": "x"}')]
    (_folder(root, "landing", "bus") / "a.json").write_text("".join(json.dumps(
        {"key": "1", "value": v, "topic": t, "partition": 0, "offset": n, "timestamp": 1_700_000_000}) + "\n"
        for n, (t, v) in enumerate(messages)))
    lh = lakehouse(spark, root, rejects=True)
    lh.run(until="silver2")
    assert [tuple(r)[:2] for r in lh.read("users").collect()] == [(1, 10)]
    assert lh.read("heart_rate").count() == 1 and lh.read("workouts").count() == 0
    assert spark.read.parquet(lh.path("users_registered_rejects")).select("text", "reason").collect() == [
        ("bad,11,bb,6", "no value for user_id")]
    bus = spark.read.parquet(lh.path("bus_rejects"))
    assert {(r.topic, r.offset, r.text, r.reason) for r in bus.collect()} == {
        ("bpm", 1, "{bad", "not a JSON object"), ("workout", 3, '{"user_id": "x"}', "a value does not fit its column")}


def test_a_failed_expectation_names_its_micro_batch(spark):
    root = scratch_dir(spark, "test_observe")
    ddl = "k long, v double"
    for k, v in ((0, 1.0), (1, -1.0), (2, None)):
        spark.createDataFrame([(k, v), (k, 5.0)], ddl).coalesce(1).write.mode("append").parquet(f"{root}/src")
    df = expect(parquet_stream(spark, f"{root}/src", ddl, max_files=1), "t", positive="v > 0", keyed="k IS NOT NULL")
    with Observed(spark) as seen:
        q = start_stream(df, f"{root}/_ckpt", path=f"{root}/out")
        await_queries([q])
        seen.take_in(q)
    rows = {(r.check, r.batch): (r.rows, r.broken, r.ok) for r in seen.checks().collect()}
    assert rows == {("t.positive", 0): (2, 0, True), ("t.positive", 1): (2, 1, False), ("t.positive", 2): (2, 1, False),
                    **{("t.keyed", b): (2, 0, True) for b in range(3)}}


def _write_parts(spark, root, times):
    df = spark.range(40).selectExpr("id", "IF(id % 3 = 0, NULL, concat('a b/', id % 3)) AS p", "id % 2 AS q")
    for _ in range(times):
        df.repartition(4).write.mode("append").partitionBy("p", "q").parquet(root)


def test_compaction_leaves_good_partitions_alone(spark):
    root, ddl = scratch_dir(spark, "test_compact_parts"), "id long, p string, q long"
    _write_parts(spark, root, 2)
    spark.sql("SELECT 99L AS id, 'single' AS p, 0L AS q").write.mode("append").partitionBy("p", "q").parquet(root)
    before = sorted(map(tuple, spark.read.schema(ddl).parquet(root).collect()), key=str)
    single = {str(f) for f in _folder(root, "p=single").rglob("*.parquet")}
    assert compact_partitions(spark, root, ddl, ["p", "q"]) == 6
    assert sorted(map(tuple, spark.read.schema(ddl).parquet(root).collect()), key=str) == before
    files = partition_files(spark, root, ["p", "q"]).collect()
    assert len(files) == 7 and all(r.files == 1 for r in files)
    assert {str(f) for f in _folder(root, "p=single").rglob("*.parquet")} == single
    assert compact_partitions(spark, root, ddl, ["p", "q"]) == 0
    size = max(r.bytes for r in files)
    _write_parts(spark, root, 3)
    assert compact_partitions(spark, root, ddl, ["p", "q"], bytes_per_file=size * 2) == 6
    assert spark.read.schema(ddl).parquet(root).count() == len(before) + 120


def test_differing_tables(spark):
    ddl = "k long, s string, v double"
    rows = [(i, None if i % 7 == 0 else f"s{i % 5}", float(i % 11)) for i in range(400)] + [(None, None, None)]
    a = spark.createDataFrame(rows, ddl)
    part = F.floor(F.col("k") / 50)
    assert tables_differ(a, a.repartition(5), part).count() == 0
    b = [r for r in rows if r[0] != 120] + [rows[60], (300, None, 99.0), (None, None, 1.0)]
    got = {(r.part, r.missing, r.extra) for r in tables_differ(a, spark.createDataFrame(b, ddl), part).collect()}
    assert got == {(2, 0, 1), (1, 1, 0), (6, 1, 0), (None, 1, 0)}
    # where a NULL stands counts
    x, y = (spark.createDataFrame([r], "k long, a string, b string") for r in ((1, None, "z"), (1, "z", None)))
    assert tables_differ(x, y, F.col("k")).count() == 1


def test_open_sessions_are_told(spark):
    from pulsehouse.operators.joins import open_or_paired
    root = scratch_dir(spark, "test_open")
    t = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    parts = [[(1, "a", t(0)), (2, "a", t(5)), (1, "b", t(30))], [(1, "b", t(50)), (2, "b", t(200)), (3, "a", t(210))],
             [(9, "a", t(9000)), (9, "b", t(9000))]]
    for p in parts:
        spark.createDataFrame(p, "u long, kind string, at timestamp").coalesce(1).write.mode("append").parquet(f"{root}/s")
    src = lambda k: parquet_stream(spark, f"{root}/s", "u long, kind string, at timestamp", max_files=1).where(
        F.col("kind") == k)
    out = open_or_paired(src("a").select("u", F.col("at").alias("s")), src("b").select("u", F.col("at").alias("e")),
                         ["u"], "s", "e", "60 MINUTES", "10 minutes")
    await_queries([start_stream(out, f"{root}/_ckpt", path=f"{root}/out")])
    got = sorted(map(tuple, spark.read.parquet(f"{root}/out").where("u < 9").collect()), key=str)
    # user 2's stop came after the bound: open; user 1 has a second, later stop
    assert got == sorted([(1, t(0), t(30)), (1, t(0), t(50)), (2, t(5), None), (3, t(210), None)], key=str)


def test_envelope_seconds_are_floored_before_1970(spark):
    from pulsehouse.functions.envelope import decode_envelope
    df = spark.createDataFrame([("1", "{}", "t", dt.datetime(1969, 12, 31, 23, 59, 59, 500_000))],
                               "key string, value string, topic string, timestamp timestamp_ntz")
    assert decode_envelope(df, "k int").first()["timestamp"] == -1


def test_rejects_need_a_known_reason(spark):
    with pytest.raises(Exception):
        spark.range(1).select(csv_fault("not a schema", "x")).collect()


def _filed(spark, root, parts, ddl):
    """The first query over deliveries, the second after some of them, as a restart would."""
    outs = []
    for n, p in enumerate(parts):
        spark.createDataFrame(p, ddl).coalesce(1).write.mode("append").parquet(f"{root}/s")
        src = parquet_stream(spark, f"{root}/s", ddl, max_files=1)
        await_queries([start_stream(src, f"{root}/_a", foreach_batch=file_by_time(root, "at", "10 minutes"))])
        if n % 2:
            continue
        q = start_stream(final_windows(spark, root, ddl, "at", "10 minutes", "1 hour", ["u"], F.count("*").alias("n")),
                         f"{root}/_b", path=f"{root}/out")
        await_queries([q])
        assert dropped(q) == 0
        outs.append([(r.u, r.window_start.hour, r.n) for r in spark.read.schema(
            "window_start timestamp, u long, n long").parquet(f"{root}/out").collect()])
    return outs


def test_windows_are_final_and_late_rows_are_kept(spark):
    root = scratch_dir(spark, "test_finals")
    t = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    ddl = "u long, at timestamp"
    parts = [[(1, t(0)), (1, t(50)), (2, t(65)), (None, t(1)), (9, None)],
             [(1, t(55)), (1, t(54)), (2, t(130))],             # 55 is just on time, 54 is not
             [(1, t(119)), (2, t(120)), (2, t(190)), (1, t(20))],
             [(3, t(400))],
             [(3, t(389)), (3, t(390)), (3, t(401))]]
    outs = _filed(spark, root, parts, ddl)
    late = late_rows(spark, root, ddl)
    assert sorted((r.u, r.at, r.load_batch) for r in late.collect() if r.at) == sorted(
        [(1, t(54), 1), (1, t(119), 2), (1, t(20), 2), (3, t(389), 4)])
    assert [(r.u, r.load_batch) for r in late.where("at IS NULL").collect()] == [(9, 0)]
    kept = spark.read.parquet(f"{root}/rows").where("NOT late").count()
    assert kept + late.count() == sum(map(len, parts))
    key = lambda r: (r[0] is not None, r)
    hours = [sorted(o, key=key) for o in map(set, outs)]
    assert [len(o) for o in outs] == [len(h) for h in hours]          # each window once
    assert hours[0] == []
    assert hours[1] == sorted([(None, 0, 1), (1, 0, 3), (2, 1, 1), (2, 2, 2)], key=key)
    assert hours[2] == sorted([*hours[1], (2, 3, 1)], key=key)


def test_filed_batches_are_written_once(spark):
    root = scratch_dir(spark, "test_filed")
    ddl = "u long, at timestamp"
    t = dt.datetime(2024, 1, 1)
    write = file_by_time(root, "at", "1 hour")
    write(spark.createDataFrame([(1, t)], ddl), 0)
    write(spark.createDataFrame([(1, t), (2, t)], ddl), 0)      # replayed after its mark
    write(spark.createDataFrame([], ddl), 1)                    # empty: the mark goes on
    write(spark.createDataFrame([(3, t - dt.timedelta(hours=2))], ddl), 2)
    rows = spark.read.schema(f"{ddl}, late boolean, load_batch int").parquet(f"{root}/rows")
    assert {(r.u, r.late, r.load_batch) for r in rows.collect()} == {(1, False, 0), (3, True, 2)}
    with pytest.raises(Exception):
        write(spark.createDataFrame([(4, t)], ddl), 9)          # the mark before it is missing
