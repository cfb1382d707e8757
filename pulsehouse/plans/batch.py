"""Batch plans over the driver tables (the registered queries, part 1).

Stand-ins for the reference's data, fixed here once:
  events   -> bus messages / readings / start-stop actions
              (event_type = topic or action, props = JSON payload {"k": n},
               value = heart rate, user_id = user or device)
  orders   -> sessions and gym visits (o_custkey = device / user)
  lineitem -> readings of a session (l_orderkey = session)
  customer -> user dimension;  nation -> its lookup
Every plan reads whole tables; selections name only the columns used, so
the parquet scans are pruned to them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsehouse.functions.bins import age_bin, age_years, validity
from pulsehouse.functions.envelope import decode_envelope, flatten, to_envelope
from pulsehouse.functions.time import epoch_double, epoch_to_timestamp, to_wall, week_part
from pulsehouse.operators.joins import attach_readings, join_dimension, pair_actions
from pulsehouse.operators.maintenance import write_colocated
from pulsehouse.operators.merge import merge_rows
from pulsehouse.operators.quality import count_checks, rows_equal, tables_differ
from pulsehouse.operators.summaries import session_summary, visit_report
from pulsehouse.session import scratch_dir
from pulsehouse.sources.tables import read_table

# Fixed stand-in parameters (shared with the oracle SQL).
START, STOP = "view", "purchase"            # actions that open / close a session
READING = "click"                           # events that are heart-rate readings
VALID_BPM = "heartrate BETWEEN 1 AND 220"   # validity rule of a reading
VISIT_DAYS = 90                             # a visit lasts 90 days unless still open
BUCKET_ROWS = 2_000_000                     # rows of a bucket of a co-located table
OPEN_STATUS = "O"                           # open order = visit without logout
AGE_REF = "2024-02-29"                      # reference date of the age bins
AGE_TEST_EDGES = (23, 25, 27, 29)           # bins that split the stand-in ages
EVENT_DDL = ("event_id LONG, ts TIMESTAMP_NTZ, user_id LONG, event_type STRING, "
             "value DOUBLE, props STRING")
PAYLOAD_DDL = "k INT"


def _t(spark, d, name, cols=None) -> DataFrame:
    return read_table(spark, d, name, cols)


# -- step 1: gold session summary --------------------------------------------
def session_summary_q(spark: SparkSession, d: str) -> DataFrame:
    readings = _t(spark, d, "lineitem", ["l_orderkey", "l_quantity"]).select(
        F.col("l_orderkey").alias("session_id"), F.col("l_quantity").alias("heartrate"))
    sessions = _t(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderdate"]).select(
        F.col("o_orderkey").alias("session_id"), F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("end_time"))
    dims = _t(spark, d, "customer", ["c_custkey", "c_mktsegment", "c_nationkey"]).select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation_key"))
    out = session_summary(readings, sessions, dims, ["session_id"], "user_id")
    return out.select("user_id", "session_id", "end_time", "segment", "nation_key",
                      "min_bpm", "avg_bpm", "max_bpm", "num_recordings")


# -- step 2: gym-visit report --------------------------------------------------
def visit_minutes_q(spark: SparkSession, d: str) -> DataFrame:
    orders = _t(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderpriority",
                                     "o_orderdate", "o_orderstatus"])
    # completed sessions: first and last reading of each order (one aggregation)
    windows = (_t(spark, d, "lineitem", ["l_orderkey", "l_shipdate"])
               .groupBy("l_orderkey")
               .agg(F.min("l_shipdate").alias("start_time"),
                    F.max("l_shipdate").alias("end_time")))
    # bridge: session -> device (the reference's completed_workouts x users)
    sessions = windows.join(
        orders.select(F.col("o_orderkey").alias("l_orderkey"),
                      F.col("o_custkey").alias("mac_address")), "l_orderkey"
    ).withColumnRenamed("l_orderkey", "session_id")
    visits = orders.select(
        F.col("o_custkey").alias("mac_address"), F.col("o_orderpriority").alias("gym"),
        F.col("o_orderkey").alias("visit_id"), F.col("o_orderdate").alias("login"),
        F.when(F.col("o_orderstatus") != OPEN_STATUS,
               F.col("o_orderdate") + F.expr(f"INTERVAL {VISIT_DAYS} DAYS")).alias("logout"))
    return visit_report(visits, sessions, key="mac_address",
                        keep=["gym", "mac_address", "visit_id", "session_id"],
                        order_by=["date", "gym", "mac_address", "session_id"])


# -- step 3: envelopes, calendar columns, epoch conversions --------------------
def _events(spark, d, cols=None) -> DataFrame:
    return _t(spark, d, "events", cols)


def envelope_decode_q(spark: SparkSession, d: str) -> DataFrame:
    ev = _events(spark, d, ["event_id", "ts", "user_id", "event_type", "props"])
    env = to_envelope(ev, key="event_id", topic="event_type", partition="user_id",
                      offset="event_id", timestamp="ts", value_col="props")
    dec = flatten(decode_envelope(env, PAYLOAD_DDL), "value")
    return dec.select("key", "k", "topic", "partition", "offset", "timestamp")


def topic_week_counts_q(spark: SparkSession, d: str) -> DataFrame:
    ev = _events(spark, d, ["ts", "event_type"])
    return (ev.select(F.col("event_type").alias("topic"), week_part("ts").alias("week_part"))
            .groupBy("topic", "week_part").agg(F.count(F.lit(1)).alias("n")))


def epoch_to_timestamp_q(spark: SparkSession, d: str) -> DataFrame:
    ev = _events(spark, d, ["event_id", "ts"])
    reg = ev.select("event_id", epoch_double("ts").alias("registration_timestamp"))
    return reg.select("event_id", "registration_timestamp",
                      to_wall(epoch_to_timestamp("registration_timestamp"))
                      .alias("registered_at"))


def envelope_encode_q(spark: SparkSession, d: str) -> DataFrame:
    ev = _events(spark, d)
    env = to_envelope(ev, key="user_id", topic="event_type", offset="event_id",
                      timestamp="ts")
    dec = flatten(decode_envelope(env, EVENT_DDL), "value")
    return dec.select("key", "event_id", "ts", "user_id", "event_type", "value", "props")


# -- step 4: merges -------------------------------------------------------------
def visit_upsert_q(spark: SparkSession, d: str) -> DataFrame:
    """Gym logins merged on (device, gym, login): a later non-NULL logout wins.
    Open logins (no logout yet) arrive first, closed ones in a second batch."""
    li = _t(spark, d, "lineitem", ["l_suppkey", "l_returnflag", "l_shipdate",
                                   "l_linestatus", "l_quantity"])
    logins = li.select(
        F.col("l_suppkey").alias("mac_address"), F.col("l_returnflag").alias("gym"),
        F.col("l_shipdate").alias("login"),
        F.when(F.col("l_linestatus") != OPEN_STATUS,
               F.col("l_shipdate") + F.make_dt_interval(
                   F.lit(0), F.col("l_quantity").cast("int"))).alias("logout"),
        F.col("l_linestatus"))
    keys = ["mac_address", "gym", "login"]
    first = logins.where(F.col("l_linestatus") == OPEN_STATUS).drop("l_linestatus")
    second = logins.where(F.col("l_linestatus") != OPEN_STATUS).drop("l_linestatus")
    target = merge_rows(None, first, keys, "max")
    return merge_rows(target, second, keys, "max")


# -- step 5: sessions and readings ----------------------------------------------
def _actions(spark, d) -> DataFrame:
    ev = _events(spark, d, ["user_id", "ts", "event_type", "props"])
    return ev.select("user_id", "ts", "event_type",
                     F.from_json("props", PAYLOAD_DDL)["k"].alias("k"))


def start_stop_pairs_q(spark: SparkSession, d: str) -> DataFrame:
    s = pair_actions(_actions(spark, d), ["user_id", "k"], "ts", "event_type", START, STOP)
    return s.select("user_id", F.col("k").alias("session_id"), "start_time", "end_time")


def _readings(spark, d) -> DataFrame:
    ev = _events(spark, d, ["user_id", "ts", "event_type", "value"])
    return ev.where(F.col("event_type") == READING).select(
        "user_id", F.col("ts").alias("time"), F.col("value").alias("heartrate"))


def readings_in_sessions_q(spark: SparkSession, d: str) -> DataFrame:
    """Readings attached to sessions (J5, P16); the rule itself, not the flag,
    is the filter, so it reaches the scan."""
    out = attach_readings(_readings(spark, d), start_stop_pairs_q(spark, d), ["user_id"],
                          valid_col=VALID_BPM)
    return out.select("user_id", "session_id", "start_time", "end_time", "time",
                      "heartrate")


def readings_bucketed_q(spark: SparkSession, d: str) -> DataFrame:
    """The same with the flag stored in the row and a lowest level of a day."""
    flagged = _readings(spark, d).withColumn("valid", validity(VALID_BPM))
    out = attach_readings(flagged, start_stop_pairs_q(spark, d), ["user_id"],
                          bucket_seconds=86_400)
    return out.select("user_id", "session_id", "start_time", "end_time", "time",
                      "heartrate")


# -- step 6: bins and flags -----------------------------------------------------
def age_bins_q(spark: SparkSession, d: str) -> DataFrame:
    profile = (_t(spark, d, "orders", ["o_custkey", "o_orderdate"])
               .groupBy(F.col("o_custkey").alias("user_id"))
               .agg(F.to_date(F.min("o_orderdate")).alias("dob")))
    users = _t(spark, d, "customer", ["c_custkey", "c_mktsegment", "c_nationkey"]).select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("n_nationkey"))
    nations = _t(spark, d, "nation", ["n_nationkey", "n_name"])
    bins = profile.select(
        "user_id",
        age_bin(age_years("dob", F.lit(AGE_REF)), AGE_TEST_EDGES).alias("age"))
    out = join_dimension(bins.join(users, "user_id"), nations, ["n_nationkey"])
    return out.select("user_id", "age", "segment", F.col("n_name").alias("nation"))


def validity_flag_q(spark: SparkSession, d: str) -> DataFrame:
    ev = _events(spark, d, ["user_id", "ts", "value"])
    r = ev.select(F.col("user_id").alias("device_id"), F.col("ts").alias("time"),
                  F.col("value").alias("heartrate"))
    return r.withColumn("valid", validity(VALID_BPM))


# -- step 8: checks ---------------------------------------------------------------
def count_checks_q(spark: SparkSession, d: str) -> DataFrame:
    ev = _events(spark, d, ["event_type"])
    users = _t(spark, d, "orders", ["o_custkey"]).select("o_custkey").distinct()
    return count_checks(spark, [
        ("valid_le_readings", validity_flag_q(spark, d), _events(spark, d, ["event_id"]), "valid", "<="),
        ("readings_in_sessions_le_readings", readings_in_sessions_q(spark, d),
         ev.where(F.col("event_type") == READING), "true", "<="),
        ("sessions_le_starts", start_stop_pairs_q(spark, d),
         ev.where(F.col("event_type") == START), "true", "<="),
        ("bins_equal_users", age_bins_q(spark, d), users),
    ])


def rows_equal_q(spark: SparkSession, d: str) -> DataFrame:
    """Golden-file check (V3, S11): the summary computed join-first is written
    as parquet, read back and compared as a multiset with the aggregate-first
    plan."""
    li = _t(spark, d, "lineitem", ["l_orderkey", "l_quantity"])
    o = _t(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    c = _t(spark, d, "customer", ["c_custkey", "c_mktsegment", "c_nationkey"])
    naive = (li.join(o, li.l_orderkey == o.o_orderkey)
             .join(c, o.o_custkey == c.c_custkey)
             .groupBy(F.col("o_custkey").alias("user_id"),
                      F.col("l_orderkey").alias("session_id"),
                      F.col("o_orderdate").alias("end_time"),
                      F.col("c_mktsegment").alias("segment"),
                      F.col("c_nationkey").alias("nation_key"))
             .agg(F.min("l_quantity").alias("min_bpm"), F.avg("l_quantity").alias("avg_bpm"),
                  F.max("l_quantity").alias("max_bpm"),
                  F.count("l_quantity").alias("num_recordings")))
    golden = scratch_dir(spark, "golden")
    naive.write.mode("overwrite").parquet(golden)
    return rows_equal(session_summary_q(spark, d), spark.read.parquet(golden))


def _damaged(ev: DataFrame) -> DataFrame:
    """Events of which some have another value, some are gone and some come twice."""
    n = F.col("event_id")
    return (ev.where(n % 1009 != 5).withColumn("value", F.when(n % 997 == 3, F.col("value") + 1).otherwise(F.col("value")))
            .withColumn("user_id", F.when(n % 1201 != 8, F.col("user_id")))
            .withColumn("again", F.explode(F.when(n % 1013 == 7, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
            .drop("again"))


def tables_differ_q(spark: SparkSession, d: str) -> DataFrame:
    """Two tables that differ in some rows, told by digests of key ranges and compared row
    by row only in the ranges that differ (V3)."""
    ev = _t(spark, d, "events", ["event_id", "user_id", "event_type", "value"])
    golden = scratch_dir(spark, "tables_differ")
    _damaged(ev).write.parquet(golden)
    return tables_differ(ev, spark.read.parquet(golden), F.floor(F.col("event_id") / 100))


def colocated_visits_q(spark: SparkSession, d: str) -> DataFrame:
    """Visits and users of each device from tables written by device: grouped and joined
    without an exchange (J2, K6)."""
    root = scratch_dir(spark, "colocated")
    visits = _t(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderdate"]).select(
        F.col("o_custkey").alias("device"), F.col("o_orderkey").alias("visit_id"), F.col("o_orderdate").alias("login"))
    users = _t(spark, d, "customer", ["c_custkey", "c_mktsegment"]).select(
        F.col("c_custkey").alias("device"), F.col("c_mktsegment").alias("segment"))
    buckets = max(4, -(-visits.count() // BUCKET_ROWS))
    mine = root.rsplit("/", 1)[1]
    by_device = write_colocated(visits, f"visits_{mine}", ["device"], buckets, f"{root}/visits", ["login"])
    dimension = write_colocated(users, f"users_{mine}", ["device"], buckets, f"{root}/users")
    each = by_device.groupBy("device").agg(F.count(F.lit(1)).alias("n"), F.max("login").alias("newest"),
                                           F.max_by("visit_id", F.struct("login", "visit_id")).alias("last_visit"))
    return dimension.join(each, "device", "left").select(
        "device", "segment", F.coalesce("n", F.lit(0)).cast("long").alias("n"), "newest", "last_visit")
