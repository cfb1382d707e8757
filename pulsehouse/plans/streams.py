"""Streaming plans over the driver tables (the registered queries, part 2).

Each plan runs a real Structured Streaming query with an ``availableNow``
trigger over data Spark derives from the driver tables, into a fresh folder
under the cluster's ``spark.checkpoint.dir``, and returns the sink read back
as a batch DataFrame. Multi-batch plans first write the source table as
files, as many as its size asks for, and read a share of them per trigger, so
the merges see several micro-batches (their results must not depend on batch
boundaries).
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsehouse.functions.envelope import decode_envelope, flatten, to_envelope
from pulsehouse.functions.time import epoch_double, epoch_seconds, to_instant, to_wall, week_part
from pulsehouse.operators.joins import open_or_paired, pair_actions
from pulsehouse.operators.maintenance import compact, compact_partitions, partition_files
from pulsehouse.operators.merge import AppendTable, KeyedTable
from pulsehouse.plans.batch import EVENT_DDL, PAYLOAD_DDL, READING, START, STOP
from pulsehouse.schemas import JSON_OPTIONS, REGISTRATION_CSV
from pulsehouse.session import scratch_dir
from pulsehouse.sources.files import csv_stream, parquet_stream, with_ingest_columns
from pulsehouse.sources.tables import read_table
from pulsehouse.streaming.finals import dropped, file_by_time, final_windows, late_rows
from pulsehouse.streaming.ingest import (CORRUPT, Observed, checked_csv_stream, csv_fault, expect,
                                         split_rejects)
from pulsehouse.streaming.layers import Lakehouse
from pulsehouse.streaming.runner import await_queries, start_stream

BATCHES = 4                # micro-batches of multi-batch plans
COMPACT_BYTES = 256 << 10  # size of a compacted file
BAD_EVERY = 50             # every so many messages has an epoch in microseconds


def staged(df: DataFrame, path: str, key: str, batches: int = BATCHES) -> int:
    """Write ``df`` as parquet files, at least one for each of ``batches``
    parts and more as their sizes ask for; returns the files per micro-batch."""
    part = F.pmod(F.xxhash64(key), F.lit(batches))
    (df.withColumn("__part", part).hint("rebalance", F.col("__part"))
     .write.mode("overwrite").partitionBy("__part").parquet(path))
    files = len(df.sparkSession.read.parquet(path).inputFiles())
    return max(1, -(-files // batches))


def _source(spark: SparkSession, d: str, root: str | None = None) -> DataFrame:
    """Events as a file stream: all at once, or from ``root`` in BATCHES parts."""
    if root is None:
        return parquet_stream(spark, d, EVENT_DDL, glob="events.parquet")
    path = f"{root}/source"
    n = staged(read_table(spark, d, "events"), path, "event_id")
    return parquet_stream(spark, path, EVENT_DDL, max_files=n)


def _registrations(ev: DataFrame) -> DataFrame:
    """events -> device registrations (user_id, device_id, mac_address, timestamp)."""
    return ev.select("user_id", F.col("event_id").alias("device_id"),
                     F.lpad(F.hex("event_id"), 12, "0").alias("mac_address"),
                     F.col("ts").alias("timestamp"))


USERS_DDL = "user_id LONG, device_id LONG, mac_address STRING, timestamp TIMESTAMP_NTZ"


def first_seen_insert_only_q(spark: SparkSession, d: str) -> DataFrame:
    """The keys of silver ``users`` as the reference builds it: stateful
    de-duplication on (user_id, device_id), then an insert-only merge on
    user_id, so a later batch hits users that are there (M1, J7, A7, T7). Every
    registration arrives twice. Which device stays depends on arrival."""
    root = scratch_dir(spark, "first_seen_insert_only")
    ev = _source(spark, d, root)
    regs = _registrations(ev.withColumn("again", F.explode(F.array(F.lit(0), F.lit(1)))))
    target = AppendTable(spark, f"{root}/users", USERS_DDL, keys=["user_id"],
                         order_cols=["timestamp", "device_id"])
    await_queries([start_stream(regs.dropDuplicates(["user_id", "device_id"]), f"{root}/_ckpt",
                                foreach_batch=target.merge, output_mode="update")])
    return target.read().groupBy("user_id").agg(F.count(F.lit(1)).alias("n_rows"))


def first_seen_earliest_wins_q(spark: SparkSession, d: str) -> DataFrame:
    """Silver ``users`` with earliest-wins over target and batch (M6 reversed):
    the same answer however the rows are split into micro-batches. The merge
    alone decides; de-duplication before it would keep the first to arrive.
    Devices repeat: an event's device is its number's last digit, and every
    tenth registration has no time."""
    root = scratch_dir(spark, "first_seen_earliest_wins")
    regs = _source(spark, d, root).select(
        "user_id", (F.col("event_id") % 10).alias("device_id"),
        F.lpad(F.hex(F.col("event_id") % 10), 12, "0").alias("mac_address"),
        F.when(F.col("event_id") % 10 != 3, F.col("ts")).alias("timestamp"))
    target = KeyedTable(spark, f"{root}/users", USERS_DDL, keys=["user_id"],
                      mode="earliest_wins", order_cols=["timestamp", "device_id"])
    await_queries([start_stream(regs, f"{root}/_ckpt", foreach_batch=target.merge)])
    return target.read()


PROFILE_DDL = ("user_id LONG, update_type STRING, score DOUBLE, k INT, offset LONG, "
               "timestamp TIMESTAMP_NTZ")


def latest_profile_q(spark: SparkSession, d: str) -> DataFrame:
    """Silver ``user_profile``: latest record per user wins (M6), payload
    struct flattened into columns (P8)."""
    root = scratch_dir(spark, "latest_profile")
    ev = _source(spark, d, root)
    upd = flatten(ev.select("user_id", F.col("event_type").alias("update_type"),
                            F.col("value").alias("score"),
                            F.from_json("props", PAYLOAD_DDL).alias("payload"),
                            F.col("event_id").alias("offset"),
                            F.col("ts").alias("timestamp")), "payload")
    target = KeyedTable(spark, f"{root}/profile", PROFILE_DDL, keys=["user_id"],
                      mode="latest_wins", order_cols=["timestamp", "offset"])
    await_queries([start_stream(upd, f"{root}/_ckpt", foreach_batch=target.merge)])
    return target.read()


PAIRS_DDL = "user_id LONG, session_id INT, start_time TIMESTAMP_NTZ, end_time TIMESTAMP_NTZ"


def pairs_streaming_q(spark: SparkSession, d: str) -> DataFrame:
    """Start/stop pairing over a stream in several micro-batches: one stateful
    aggregation per (user, session) in update mode (J4); a session that a later
    batch extends is stored again, and its last state counts."""
    root = scratch_dir(spark, "pairs_streaming")
    actions = _source(spark, d, root).select(
        "user_id", F.from_json("props", PAYLOAD_DDL)["k"].alias("session_id"), "ts", "event_type")
    pairs = pair_actions(actions, ["user_id", "session_id"], "ts", "event_type", START, STOP)
    target = KeyedTable(spark, f"{root}/pairs", PAIRS_DDL, keys=["user_id", "session_id"], mode="update")
    await_queries([start_stream(pairs, f"{root}/_ckpt", foreach_batch=target.merge,
                                output_mode="update")])
    return target.read()


SUMMARY_DDL = ("user_id LONG, event_type STRING, segment STRING, min_value DOUBLE, "
               "avg_value DOUBLE, max_value DOUBLE, n LONG")


def summary_stream_q(spark: SparkSession, d: str) -> DataFrame:
    """Gold summary as a stateful streaming aggregation in update mode, joined
    with a static dimension and upserted per micro-batch (A1, T5, T8, K3, M2)."""
    root = scratch_dir(spark, "summary_stream")
    ev = _source(spark, d, root)
    dims = read_table(spark, d, "customer", ["c_custkey", "c_mktsegment"]).select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"))
    agg = (ev.groupBy("user_id", "event_type")
           .agg(F.min("value").alias("min_value"), F.avg("value").alias("avg_value"),
                F.max("value").alias("max_value"), F.count("value").alias("n"))
           .join(dims, "user_id"))
    target = KeyedTable(spark, f"{root}/summary", SUMMARY_DDL,
                      keys=["user_id", "event_type"], mode="update")
    await_queries([start_stream(agg, f"{root}/_ckpt", foreach_batch=target.merge,
                                output_mode="update")])
    return target.read().withColumn("avg_value", F.round("avg_value", 6))


def csv_ingest_q(spark: SparkSession, d: str) -> DataFrame:
    """Bronze registrations: CSV landing zone -> incremental file stream with a
    declared schema -> append-only parquet table with ingest columns."""
    root = scratch_dir(spark, "csv_ingest")
    landing, bronze = f"{root}/landing", f"{root}/users_registered"
    ev = read_table(spark, d, "events", ["event_id", "user_id", "ts"])
    (_registrations(ev).select("user_id", "device_id", "mac_address",
                               epoch_double("timestamp").alias("registration_timestamp"))
     .write.option("header", "true").csv(landing))
    src = with_ingest_columns(csv_stream(spark, landing, REGISTRATION_CSV))
    await_queries([start_stream(src, f"{root}/_ckpt", path=bronze)])
    return spark.read.parquet(bronze).select("user_id", "device_id", "mac_address",
                                             "registration_timestamp")


def bus_ingest_q(spark: SparkSession, d: str) -> DataFrame:
    """Bronze bus dump: JSON envelopes -> ``Lakehouse.bronze_bus`` -> parquet
    partitioned by (topic, week_part); then the ``click`` branch is read back
    with a partition filter and its payload decoded (S3, P15, K6). Every
    BAD_EVERY-th message has its epoch in microseconds: such a message is kept,
    without a week."""
    root = scratch_dir(spark, "bus_ingest")
    ev = read_table(spark, d, "events", ["event_id", "ts", "user_id", "event_type", "props"])
    seconds = epoch_seconds("ts")
    env = to_envelope(ev, key="event_id", topic="event_type", partition="user_id",
                      offset="event_id", value_col="props", binary=False,
                      timestamp=F.when(F.col("event_id") % BAD_EVERY == 0, seconds * 1_000_000)
                      .otherwise(seconds))
    env.write.options(**JSON_OPTIONS).json(f"{root}/landing/bus")
    lh = Lakehouse(spark, root=f"{root}/tables", checkpoints=f"{root}/_checkpoints",
                   landing=f"{root}/landing", max_files=2)
    await_queries([lh.bronze_bus()])
    clicks = lh.read("bus_dump").where(F.col("topic") == READING)
    dec = flatten(decode_envelope(clicks, PAYLOAD_DDL, keep=["week_part"]), "value")
    return dec.select("key", "k", "topic", "offset", "timestamp", "week_part")


def compact_files_q(spark: SparkSession, d: str) -> DataFrame:
    """A named streaming JSON sink writes small part files per micro-batch (K2);
    compaction then rewrites them as few files (K5), read with a declared schema."""
    root = scratch_dir(spark, "compact_files")
    small = f"{root}/small"
    ev = _source(spark, d, root)
    await_queries([start_stream(ev, f"{root}/_ckpt", path=small, fmt="json",
                                query_name="events_json", options=JSON_OPTIONS)])
    out = compact(spark, small, f"{root}/compacted", EVENT_DDL, bytes_per_file=COMPACT_BYTES)
    return out.select("event_id", "ts", "user_id", "event_type", "value", "props")


def dedupe_stream_q(spark: SparkSession, d: str) -> DataFrame:
    """What stateful de-duplication lets through, before any merge (A7, T7): every
    registration arrives twice in each of two micro-batch orders, with ten devices a user."""
    root = scratch_dir(spark, "dedupe_stream")
    regs = _source(spark, d, root).select("user_id", (F.col("event_id") % 10).alias("device_id"),
                                          F.explode(F.array(F.lit(0), F.lit(1))).alias("again"))
    await_queries([start_stream(regs.dropDuplicates(["user_id", "device_id"]).drop("again"), f"{root}/_ckpt",
                                path=f"{root}/out")])
    return (spark.read.schema("user_id LONG, device_id LONG").parquet(f"{root}/out")
            .groupBy("user_id").agg(F.count(F.lit(1)).alias("n_rows")))


SHORT_EVERY, WORDY_EVERY, LONG_EVERY = 50, 70, 110    # of such events a line lacks a field, ...


def csv_rejects_q(spark: SparkSession, d: str) -> DataFrame:
    """Registrations of which some lines do not fit (S1): the accepted rows and, with their
    text and what is wrong, the rejected ones. Together they are the lines read."""
    root = scratch_dir(spark, "csv_rejects")
    n = F.col("event_id")
    line = F.concat_ws(",", F.when(n % WORDY_EVERY == 7, F.lit("bad")).otherwise(F.col("user_id").cast("string")), n,
                       F.lpad(F.hex(n), 12, "0"), F.when(n % SHORT_EVERY != 3, epoch_seconds("ts").cast("string")),
                       F.when((n % LONG_EVERY == 9) & (n % SHORT_EVERY != 3), F.lit("more")))
    (read_table(spark, d, "events", ["event_id", "user_id", "ts"]).select(line.alias("value"))
     .write.option("compression", "none").text(f"{root}/landing"))
    src = checked_csv_stream(spark, f"{root}/landing", REGISTRATION_CSV, header=False, glob="*.txt")
    fault = F.when(F.col(CORRUPT).isNotNull(), csv_fault(REGISTRATION_CSV))
    await_queries([start_stream(src, f"{root}/_ckpt", foreach_batch=split_rejects(
        f"{root}/accepted", f"{root}/rejects", fault, CORRUPT))])
    good = spark.read.parquet(f"{root}/accepted").select(
        "user_id", "device_id", "mac_address", "registration_timestamp",
        F.lit(None).cast("string").alias("text"), F.lit(None).cast("string").alias("reason"))
    bad = spark.read.parquet(f"{root}/rejects").select("text", "reason")
    return good.unionByName(bad, allowMissingColumns=True)


def observed_checks_q(spark: SparkSession, d: str) -> DataFrame:
    """Expectations counted while a stream writes (V1, V4): rows that break each rule, over
    all micro-batches, without reading the table again."""
    root = scratch_dir(spark, "observed_checks")
    ev = expect(_source(spark, d, root), "events", has_user="user_id IS NOT NULL", valued="value > 10",
                known_type="event_type IN ('click', 'view', 'purchase')", newer="ts >= '2024-01-01'")
    with Observed(spark) as seen:
        q = start_stream(ev, f"{root}/_ckpt", path=f"{root}/out")
        await_queries([q])
        seen.take_in(q)
    return seen.checks().groupBy("check").agg(F.sum("rows").alias("rows"), F.sum("broken").alias("broken"),
                                              F.bool_and("ok").alias("ok"))


def compact_partitions_q(spark: SparkSession, d: str) -> DataFrame:
    """A table partitioned by topic and week, written in small files by several
    micro-batches, compacted partition by partition (K5, K6): rows, and files after it. A
    second run finds nothing to do."""
    root = scratch_dir(spark, "compact_partitions")
    ev = (_source(spark, d, root).withColumn("topic", F.col("event_type")).withColumn("week_part", week_part("ts")))
    by, table = ["topic", "week_part"], f"{root}/bus"
    await_queries([start_stream(ev, f"{root}/_ckpt", partition_by=by, foreach_batch=lambda b, _: (
        b.write.mode("append").partitionBy(*by).parquet(table)))])
    ddl = f"{EVENT_DDL}, topic STRING, week_part STRING"
    first = compact_partitions(spark, table, ddl, by, COMPACT_BYTES)
    second = compact_partitions(spark, table, ddl, by, COMPACT_BYTES)
    rows = (spark.read.schema(ddl).parquet(table).groupBy(*by)
            .agg(F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("ids")))
    return (rows.join(partition_files(spark, table, by).drop("bytes"), by)
            .withColumn("rewritten", F.lit(first > 0)).withColumn("again", F.lit(second).cast("long")))


WITHIN, LATE = "2 HOURS", "1 hour"
LATER, KEPT = 40, "30 hours"    # one event in LATER comes late; rows are waited for so long


def open_sessions_q(spark: SparkSession, d: str) -> DataFrame:
    """Every ``view`` with the ``purchase`` events of its user in the two hours after it, or
    alone when there are none: an outer join of two streams with bounded state (J4). The
    events come in order of time, in several micro-batches; a last one moves the watermark
    past all of them."""
    root = scratch_dir(spark, "open_sessions")
    ev = read_table(spark, d, "events", ["event_id", "user_id", "event_type", "ts"])
    lo, hi, size = ev.agg(F.min("ts"), F.max("ts"), F.count(F.lit(1))).first()
    ev = ev.withColumn("ts", to_instant("ts"))
    files = max(1, -(-size // 2_000_000))
    for k in range(BATCHES + 1):
        a, b = (lo + (hi - lo) * i / BATCHES for i in (k, k + 1))
        part = ev.where((F.col("ts") >= F.lit(a).cast("timestamp")) & (F.col("ts") < F.lit(b).cast("timestamp")))
        if k == BATCHES:        # the last moment, and an event of each kind long after it
            end = spark.range(2).select(
                F.lit(-1).cast("long").alias("event_id"), F.lit(-1).cast("long").alias("user_id"),
                F.when(F.col("id") == 0, F.lit(START)).otherwise(STOP).alias("event_type"),
                F.lit(hi + datetime.timedelta(days=400)).cast("timestamp").alias("ts"))
            part = part.unionByName(end)
        part.repartition(files).write.mode("append").parquet(f"{root}/source")
    src = lambda: parquet_stream(spark, f"{root}/source", "event_id LONG, user_id LONG, event_type STRING, "  # noqa: E731
                                 "ts TIMESTAMP", max_files=files)
    starts = src().where(F.col("event_type") == START).select("event_id", "user_id", F.col("ts").alias("start_time"))
    stops = src().where(F.col("event_type") == STOP).select("user_id", F.col("ts").alias("end_time"))
    out = open_or_paired(starts, stops, ["user_id"], "start_time", "end_time", WITHIN, LATE)
    await_queries([start_stream(out, f"{root}/_ckpt", path=f"{root}/out")])
    return (spark.read.schema("event_id LONG, user_id LONG, start_time TIMESTAMP, end_time TIMESTAMP")
            .parquet(f"{root}/out").where("user_id >= 0")
            .select("event_id", "user_id", to_wall("start_time").alias("start_time"),
                    to_wall("end_time").alias("end_time")))


def final_windows_q(spark: SparkSession, d: str) -> DataFrame:
    """Events by hour and kind, each hour once when no more rows of it are taken (``final``),
    and the rows that came too late for theirs (``late``), T8. The events come in order of
    time in several deliveries, but one in LATER of them a delivery later."""
    root = scratch_dir(spark, "final_windows")
    ddl = "event_id LONG, event_type STRING, value DOUBLE, ts TIMESTAMP"
    ev = read_table(spark, d, "events", ["event_id", "event_type", "value", "ts"]).withColumn("ts", to_instant("ts"))
    us = F.unix_micros("ts")
    lo, hi, size = ev.agg(F.min(us), F.max(us), F.count(F.lit(1))).first()
    files = max(1, -(-size // 2_000_000))
    k = (F.expr(f"(unix_micros(ts) - {lo}) * {BATCHES} div {hi - lo + 1}")
         + F.when(F.pmod("event_id", F.lit(LATER)) == 7, 1).otherwise(0))
    for n in range(BATCHES + 1):
        ev.where(k == n).repartition(files).write.mode("append").parquet(f"{root}/source")
    src = parquet_stream(spark, f"{root}/source", ddl, max_files=files)
    await_queries([start_stream(src, f"{root}/_ckpt_rows", foreach_batch=file_by_time(root, "ts", KEPT))])
    groups = final_windows(spark, root, ddl, "ts", KEPT, "1 hour", ["event_type"],
                           F.count(F.lit(1)).alias("n"), F.max("value").alias("greatest"))
    query = start_stream(groups, f"{root}/_ckpt_groups", path=f"{root}/out")
    await_queries([query])
    if dropped(query):
        raise RuntimeError("rows on time were dropped")
    final = (spark.read.schema("window_start TIMESTAMP, event_type STRING, n LONG, greatest DOUBLE")
             .parquet(f"{root}/out").withColumn("kind", F.lit("final")))
    late = (late_rows(spark, root, ddl).groupBy(F.date_trunc("hour", "ts").alias("window_start"), "event_type")
            .agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("greatest")).withColumn("kind", F.lit("late")))
    return final.unionByName(late).select("kind", to_wall("window_start").alias("window_start"),
                                          "event_type", "n", "greatest")
