import datetime as dt
import pathlib

import pytest
from pyspark.sql import functions as F

from pulsehouse.operators import AppendTable, KeyedTable, merge_rows, pick_per_key, read_if_there
from pulsehouse.session import scratch_dir

T = dt.datetime
USERS = "user_id long, device_id long, timestamp timestamp_ntz"


def _df(spark, rows, ddl=USERS):
    return spark.createDataFrame(rows, ddl)


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def _apply(spark, batches, mode, keys=("user_id",), order=("timestamp", "device_id")):
    target = None
    for b in batches:
        target = merge_rows(target, _df(spark, b), list(keys), mode, list(order))
        target = spark.createDataFrame(target.collect(), USERS)   # materialise a version
    return target


def test_two_devices_every_arrival_order(spark):
    a, b = (1, 10, T(2024, 1, 1)), (1, 11, T(2024, 1, 2))
    for batches in ([[a, b]], [[a], [b]], [[b], [a]]):
        out = _apply(spark, batches, "earliest_wins")
        assert _rows(out, "user_id", "device_id") == [(1, 10)]
    # insert-only: the device seen in the earlier batch stays, even if later in time
    out = _apply(spark, [[b], [a]], "insert_only")
    assert _rows(out, "user_id", "device_id") == [(1, 11)]
    out = _apply(spark, [[a, b]], "insert_only")
    assert _rows(out, "user_id", "device_id") == [(1, 10)]


def test_latest_wins_ignores_late_older_record(spark):
    new, old = (1, 5, T(2024, 1, 5)), (1, 3, T(2024, 1, 3))
    out = _apply(spark, [[new], [old]], "latest_wins")
    assert _rows(out, "device_id") == [(5,)]


def test_update_vs_insert_only_for_summaries(spark):
    ddl = "user_id long, max_bpm double"
    t0 = spark.createDataFrame([(1, 10.0)], ddl)
    b1 = spark.createDataFrame([(1, 90.0)], ddl)
    upd = merge_rows(merge_rows(None, t0, ["user_id"], "update"), b1, ["user_id"], "update")
    ins = merge_rows(merge_rows(None, t0, ["user_id"], "insert_only"), b1, ["user_id"],
                     "insert_only")
    assert _rows(upd, "max_bpm") == [(90.0,)]
    assert _rows(ins, "max_bpm") == [(10.0,)]


def test_max_mode_null_never_overwrites(spark):
    ddl = "mac_address string, login timestamp_ntz, logout timestamp_ntz"
    first = spark.createDataFrame([("m", T(2024, 1, 1, 8), T(2024, 1, 1, 9))], ddl)
    second = spark.createDataFrame([("m", T(2024, 1, 1, 8), None)], ddl)
    out = merge_rows(merge_rows(None, first, ["mac_address", "login"], "max"), second,
                     ["mac_address", "login"], "max")
    assert _rows(out, "logout") == [(T(2024, 1, 1, 9),)]


def test_insert_columns_by_target_name(spark):
    tgt = spark.createDataFrame([(1, 10.0)], "user_id long, max_bpm double")
    src = spark.createDataFrame([(2, "x", 20.0)], "user_id long, city string, max_bpm double")
    out = merge_rows(tgt, src, ["user_id"], "insert_only")
    assert out.columns == ["user_id", "max_bpm"] and out.count() == 2


def test_pick_per_key_hot_key_plan_is_partial(spark):
    df = spark.range(10000).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    out = pick_per_key(df, ["k"], ["v"], latest=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan
    assert out.first().v == 9999


def _files(root):
    return {f for f in pathlib.Path(root.removeprefix("file:")).rglob("part-*.parquet") if "_changes" not in str(f)}


def test_keyed_replay_changes_nothing(spark):
    root = scratch_dir(spark, "test_replay") + "/users"
    t = KeyedTable(spark, root, USERS, ["user_id"], "earliest_wins", ["timestamp", "device_id"], changes=True)
    assert t.read().count() == 0
    t.merge(_df(spark, [(1, 11, T(2024, 1, 2))]), 0)
    batch = _df(spark, [(1, 10, T(2024, 1, 1)), (2, 20, T(2024, 1, 1))])
    t.merge(batch, 1)
    assert _rows(t.read(), "user_id", "device_id") == [(1, 10), (2, 20)]
    told = lambda: spark.read.schema(t.changes_ddl).parquet(t.changes_path)
    want = [(1, 10, 1), (1, 11, -1), (1, 11, 1), (2, 20, 1)]
    assert _rows(told(), "user_id", "device_id", "op") == want
    t.merge(batch, 1)                                          # replay: told again, same rows
    assert _rows(t.read(), "user_id", "device_id") == [(1, 10), (2, 20)]
    assert _rows(told().distinct().drop("load_time").distinct(), "user_id", "device_id", "op") == want
    files = _files(root)
    t.merge(_df(spark, [(1, 12, T(2024, 1, 5))]), 2)           # a later device changes nothing
    assert _files(root) == files and _rows(told().drop("load_time").distinct(), "user_id", "device_id", "op") == want


def test_changes_survive_a_failure_between_the_steps(spark, monkeypatch):
    """The batch fails before, or after, the table is rewritten; its replay tells all changes."""
    for step in ("_rewrite", "after"):
        root = scratch_dir(spark, "test_fail") + "/users"
        t = KeyedTable(spark, root, USERS, ["user_id"], "update", changes=True)
        t.create()
        t.merge(_df(spark, [(1, 10, None), (2, 20, None)]), 0)
        rewrite = KeyedTable._rewrite

        def fail(self, *a):
            if step == "after":
                rewrite(self, *a)
            raise RuntimeError("lost")
        monkeypatch.setattr(KeyedTable, "_rewrite", fail)
        with pytest.raises(RuntimeError):
            t.merge(_df(spark, [(1, 11, None), (3, 30, None)]), 1)
        monkeypatch.setattr(KeyedTable, "_rewrite", rewrite)
        t.merge(_df(spark, [(1, 11, None), (3, 30, None)]), 1)
        assert _rows(t.read(), "user_id", "device_id") == [(1, 11), (2, 20), (3, 30)]
        told = spark.read.schema(t.changes_ddl).parquet(t.changes_path).drop("load_time").distinct()
        assert _rows(told, "user_id", "device_id", "op") == [(1, 10, -1), (1, 10, 1), (1, 11, 1), (2, 20, 1), (3, 30, 1)]


def test_keys_can_go(spark):
    root = scratch_dir(spark, "test_gone") + "/t"
    t = KeyedTable(spark, root, USERS, ["user_id"], "update", buckets=64, changes=True)
    t.merge(_df(spark, [(1, 10, None), (2, 20, None), (None, 5, None)]), 0)
    gone = _df(spark, [(1,), (2,), (9,), (None,)], "user_id int")
    t.merge(_df(spark, [(2, 21, None)]), 1, gone=gone)         # key 1 was alone in its partition
    assert _rows(t.read(), "user_id", "device_id") == [(2, 21)]
    t.merge(_df(spark, [], USERS), 2, gone=gone)
    assert t.read().count() == 0
    told = spark.read.schema(t.changes_ddl).parquet(t.changes_path)
    assert told.agg(F.sum("op")).first()[0] == 0 and told.count() == 8


def test_only_touched_partitions_are_rewritten(spark):
    root = scratch_dir(spark, "test_touched_keys") + "/t"
    for changes in (False, True):
        t = KeyedTable(spark, f"{root}{changes}", USERS, ["user_id"], "update", buckets=32, changes=changes)
        t.merge(_df(spark, [(i, i, T(2024, 1, 1)) for i in range(500)]), 0)
        before = _files(t.root)
        assert len({f.parent for f in before}) == 32
        t.merge(_df(spark, [(7, 70, T(2024, 1, 1)), (8, 80, None)]), 1)
        new, old = _files(t.root) - before, before - _files(t.root)
        assert 1 <= len({f.parent for f in new}) <= 2 and {f.parent for f in new} == {f.parent for f in old}
        assert t.read().count() == 500
        assert _rows(t.read(_df(spark, [(7,), (8,), (900,)], "user_id int")), "user_id", "device_id") == [(7, 70), (8, 80)]


def test_replace_withdraws_the_rows_of_groups(spark):
    root = scratch_dir(spark, "test_replace")
    t = AppendTable(spark, root, USERS, ["user_id", "timestamp"], date_of="timestamp")
    t.merge(_df(spark, [(u, u, T(2024, 1, d)) for u in (1, 2, None) for d in (1, 2, 3)]), 0)
    days = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (1, 2, 9)], "day date")
    for _ in range(2):
        t.replace(_df(spark, [(1,), (None,), (5,)], "user_id long"), days,
                  _df(spark, [(1, 100, T(2024, 1, 2, 5)), (5, 5, T(2024, 1, 9))]), ["user_id"])
        assert sorted(map(tuple, t.read().collect()), key=str) == sorted(
            [(2, 2, T(2024, 1, d)) for d in (1, 2, 3)] + [(u, u, T(2024, 1, 3)) for u in (1, None)]
            + [(1, 100, T(2024, 1, 2, 5)), (5, 5, T(2024, 1, 9))], key=str)
    t.replace(_df(spark, [(5,)], "user_id long"), days, _df(spark, []), ["user_id"])   # its day is empty now
    assert t.read(days).where("timestamp >= '2024-01-09'").count() == 0 and t.read().count() == 6


def test_days_can_be_replaced_without_reading_them(spark, monkeypatch):
    """All rows of some days are given: what is stored is not read, other days stay, and
    rows lie by key in each file."""
    root = scratch_dir(spark, "test_replace_days")
    t = AppendTable(spark, root, USERS, ["user_id", "timestamp"], date_of="timestamp")
    t.merge(_df(spark, [(u, u, T(2024, 1, d)) for u in (1, 2) for d in (1, 2, 3)]), 0)
    days = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (1, 2, 9)], "day date")
    new = [(u * 7 % 50, u, T(2024, 1, 2, h)) for u in range(50) for h in (3, 1)]
    monkeypatch.setattr(t, "_stored", lambda parts=None: pytest.fail("read"))
    for _ in range(2):
        t.replace(None, days, _df(spark, new).repartition(3))
    monkeypatch.undo()
    assert sorted(map(tuple, t.read().collect())) == sorted(new + [(u, u, T(2024, 1, 3)) for u in (1, 2)])
    for f in _files(f"{root}/day=2024-01-02"):
        keys = [tuple(r) for r in spark.read.parquet(str(f)).where("load_time IS NOT NULL")
                .coalesce(1).select("user_id", "timestamp").collect()]
        assert keys == sorted(keys)


def _damage(folder):
    """Overwrite every data file under a local folder with junk."""
    for f in pathlib.Path(folder.removeprefix("file:")).rglob("*.parquet"):
        f.write_bytes(b"junk" * 10)
        crc = f.parent / f".{f.name}.crc"
        if crc.exists():
            crc.write_bytes(b"")


def test_an_unreadable_table_is_not_an_empty_table(spark):
    """A restarted writer that cannot read what is stored fails; it does not begin anew."""
    root = scratch_dir(spark, "test_damage")
    rows = [(i, i, T(2024, 1, 1)) for i in range(3)]
    KeyedTable(spark, f"{root}/keyed", USERS, ["user_id"], "update").merge(_df(spark, rows), 0)
    _damage(f"{root}/keyed")
    again = KeyedTable(spark, f"{root}/keyed", USERS, ["user_id"], "update")
    with pytest.raises(Exception):
        again.read().collect()
    with pytest.raises(Exception):
        again.merge(_df(spark, rows), 1)
    app = AppendTable(spark, f"{root}/app", USERS, ["user_id", "timestamp"], date_of="timestamp")
    app.merge(_df(spark, rows), 0)
    _damage(f"{root}/app")
    with pytest.raises(Exception):
        AppendTable(spark, f"{root}/app", USERS, ["user_id", "timestamp"],
                    date_of="timestamp").merge(_df(spark, rows), 1)
    assert read_if_there(spark, "x int", f"{root}/nothing") is None


def test_null_times_lose_in_both_directions(spark):
    rows = [(1, 5, None), (1, 6, T(2024, 1, 1)), (1, 7, T(2024, 1, 3)), (2, 8, None)]
    for latest, want in ((False, 6), (True, 7)):
        out = pick_per_key(_df(spark, rows), ["user_id"], ["timestamp"], latest)
        assert _rows(out, "user_id", "device_id") == [(1, want), (2, 8)]
    for batches in ([[rows[0]], rows[1:]], [rows[1:], [rows[0]]]):
        assert _rows(_apply(spark, batches, "earliest_wins"), "user_id", "device_id") == [(1, 6), (2, 8)]


def test_null_keys_are_inserted_once(spark):
    rows = [(None, 1, T(2024, 1, 1)), (2, 2, None), (3, 3, T(2024, 1, 1))]
    for name, kw in (("a", {}), ("b", {"date_of": "timestamp"})):
        t = AppendTable(spark, f"{scratch_dir(spark, 'test_null_keys')}/{name}", USERS,
                        ["user_id", "timestamp"], **kw)
        t.merge(_df(spark, rows), 0)
        t.merge(_df(spark, rows), 1)
        assert t.read().count() == 3


def test_partition_column_comes_from_a_key(spark):
    with pytest.raises(ValueError):
        AppendTable(spark, "/nowhere", USERS, ["user_id"], date_of="timestamp")
    one = (1, 1, T(2024, 1, 1, 23, 59))
    two = (1, 1, T(2024, 1, 2, 0, 1))
    for batches in ([[one, two]], [[one], [two]], [[two], [one]]):
        t = AppendTable(spark, scratch_dir(spark, "test_midnight"), USERS,
                        ["user_id", "device_id", "timestamp"], date_of="timestamp")
        for i, b in enumerate(batches):
            t.merge(_df(spark, b), i)
        assert t.read().count() == 2
        day = spark.createDataFrame([(dt.date(2024, 1, 2),)], "day date")
        assert t.read(day).count() == 1


def test_files_of_a_batch_grow_with_the_batch(spark):
    """A small batch into a large table writes a few files, whatever the table's size."""
    root = scratch_dir(spark, "test_batch_files")
    app = AppendTable(spark, f"{root}/app", USERS, ["user_id", "timestamp"], date_of="timestamp")
    many = _df(spark, [(i, i, T(2024, 1, 1) + dt.timedelta(days=i % 60)) for i in range(3000)])
    app.merge(many, 0)
    before = _files(app.root)
    app.merge(_df(spark, [(10_000, 1, T(2024, 1, 5)), (5, 5, T(2024, 1, 6))]), 1)
    assert before <= _files(app.root) and 1 <= len(_files(app.root) - before) <= 8
    assert len({f.parent for f in before}) == 60


def test_a_table_without_dates_reads_the_batchs_hash_partitions(spark, monkeypatch):
    root = scratch_dir(spark, "test_hash_parts")
    t = AppendTable(spark, root, USERS, ["user_id"], ["timestamp", "device_id"], buckets=16)
    t.merge(_df(spark, [(i, i, T(2024, 1, 1)) for i in range(300)]), 0)
    opened, stored = [], AppendTable._stored
    monkeypatch.setattr(AppendTable, "_stored", lambda self, parts=None: opened.append(parts) or stored(self, parts))
    t.merge(_df(spark, [(7, 70, T(2024, 1, 2)), (900, 1, None)]), 1)
    assert len(opened) == 1 and 1 <= len(opened[0]) <= 2
    monkeypatch.undo()
    assert t.read().count() == 301 and _rows(t.read().where("user_id = 7"), "device_id") == [(7,)]


def test_only_touched_partitions_are_opened(spark):
    root = scratch_dir(spark, "test_touched")
    t = AppendTable(spark, root, USERS, ["user_id", "timestamp"], date_of="timestamp")
    t.merge(_df(spark, [(i, i, T(2024, 1, 1 + i)) for i in range(20)]), 0)
    one = t._stored([dt.date(2024, 1, 3), dt.date(2030, 1, 1)])
    assert len(one.inputFiles()) == 1 and t._stored([dt.date(2031, 1, 1)]) is None


def test_append_table_replay_adds_nothing(spark):
    root = scratch_dir(spark, "test_append")
    t = AppendTable(spark, root, USERS, ["user_id"], ["timestamp", "device_id"])
    b = _df(spark, [(1, 10, T(2024, 1, 1)), (1, 11, T(2024, 1, 2))])
    t.merge(b, 0)
    t.merge(b, 0)
    assert _rows(t.read(), "user_id", "device_id") == [(1, 10)]


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        merge_rows(None, _df(spark, [(1, 1, T(2024, 1, 1))]), ["user_id"], "nope")


from hypothesis import given, settings, strategies as st


@settings(max_examples=8, deadline=None)
@given(rows=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 50), st.integers(0, 9)),
                     min_size=1, max_size=25, unique_by=lambda r: (r[0], r[1], r[2])),
       cuts=st.lists(st.integers(0, 25), max_size=3))
def test_merge_independent_of_batch_split(spark, rows, cuts):
    """earliest/latest-wins and max are the same however rows are split into
    batches; insert-only always keeps exactly the set of keys."""
    ddl = "k int, t int, v int"
    bounds = sorted({0, len(rows), *[min(c, len(rows)) for c in cuts]})
    batches = [rows[a:b] for a, b in zip(bounds, bounds[1:]) if rows[a:b]]
    for mode, order in (("earliest_wins", ["t", "v"]), ("latest_wins", ["t", "v"]),
                        ("max", None), ("insert_only", ["t", "v"])):
        target = None
        for b in batches:
            target = merge_rows(target, spark.createDataFrame(b, ddl), ["k"], mode, order)
            target = spark.createDataFrame(target.collect(), ddl)
        got = sorted(map(tuple, target.collect()))
        keys = sorted({r[0] for r in rows})
        if mode == "insert_only":
            assert [g[0] for g in got] == keys
            continue
        if mode == "max":
            want = [(k, max(r[1] for r in rows if r[0] == k), max(r[2] for r in rows if r[0] == k))
                    for k in keys]
        else:
            pick = min if mode == "earliest_wins" else max
            want = [pick((r for r in rows if r[0] == k), key=lambda r: (r[1], r[2])) for k in keys]
        assert got == sorted(want), mode


@settings(max_examples=6, deadline=None)
@given(rows=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 50), st.integers(0, 9)),
                     min_size=1, max_size=20, unique_by=lambda r: (r[0], r[1], r[2])),
       cuts=st.lists(st.integers(0, 20), max_size=3), changes=st.booleans())
def test_keyed_table_equals_merging_by_hand(spark, rows, cuts, changes):
    """Merging into touched partitions gives the table of ``merge_rows``, and the changes
    told add up to it."""
    ddl = "k int, t int, v int"
    bounds = sorted({0, len(rows), *[min(c, len(rows)) for c in cuts]})
    batches = [rows[a:b] for a, b in zip(bounds, bounds[1:]) if rows[a:b]]
    for mode, order in (("update", ["t", "v"]), ("insert_only", ["t", "v"]),
                        ("latest_wins", ["t", "v"]), ("max", None)):
        t = KeyedTable(spark, scratch_dir(spark, "test_keyed") + "/t", ddl, ["k"], mode, order,
                       buckets=3, changes=changes)
        target = None
        for i, b in enumerate(batches):
            df = spark.createDataFrame(b, ddl)
            t.merge(df, i)
            target = merge_rows(target, df, ["k"], mode, order)
            target = spark.createDataFrame(target.collect(), ddl)
        want = sorted(map(tuple, target.collect()))
        assert sorted(map(tuple, t.read().collect())) == want, mode
        if changes:
            told = (spark.read.schema(t.changes_ddl).parquet(t.changes_path).groupBy("k", "t", "v")
                    .agg(F.sum("op").alias("n")).where("n != 0"))
            assert sorted((r.k, r.t, r.v, r.n) for r in told.collect()) == [(*w, 1) for w in want]


def test_named_partitions_are_read_without_a_join(spark):
    """Rows of named partitions come from their folders: no shuffle of all that is read."""
    t = AppendTable(spark, scratch_dir(spark, "test_named"), "k INT, at TIMESTAMP_NTZ", ["k", "at"], date_of="at")
    rows = spark.sql("SELECT id k, TIMESTAMP_NTZ'2024-01-01' + id * INTERVAL 1 DAY at FROM range(4)")
    t.merge(rows)
    days = spark.sql("SELECT DATE'2024-01-02' day UNION ALL SELECT DATE'2024-01-03' UNION ALL SELECT DATE'2024-01-02'")
    got = t.read(days)
    assert sorted(r.k for r in got.collect()) == [1, 2]
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_a_batch_is_reduced_to_its_keys_first(spark, monkeypatch):
    """What a merge keeps and compares is one row of a key, however many messages name it."""
    t = KeyedTable(spark, scratch_dir(spark, "test_reduced"), "k INT, v INT", ["k"], "latest_wins", ["v"], changes=True)
    sizes, placed = [], t._placed
    monkeypatch.setattr(t, "_placed", lambda df, schema: (sizes.append(df.count()), placed(df, schema))[1])
    for batch_id in (0, 1):
        t.merge(spark.range(600).selectExpr("CAST(id % 3 AS INT) k", f"CAST(id + {batch_id} AS INT) v"), batch_id)
    assert sizes == [3, 3]
    assert sorted(map(tuple, t.read().collect())) == [(0, 598), (1, 599), (2, 600)]
    told = spark.read.schema(t.changes_ddl).parquet(t.changes_path).groupBy("op").count().collect()
    assert sorted(map(tuple, told)) == [(-1, 3), (1, 6)]
