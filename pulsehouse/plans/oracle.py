"""DuckDB SQL equal in meaning to each registered plan (the correctness gate).

Tables are the driver's pre-registered views. Column names equal the
Spark plans' aliases. Shared pieces are written once as CTE text.
"""

from __future__ import annotations

K = "CAST(json_extract(props, '$.k') AS INTEGER)"
EPOCH_S = "CAST(floor(epoch({c})) AS BIGINT)"

PAIRS = f"""
  SELECT user_id, session_id, start_time, end_time FROM (
    SELECT user_id, {K} AS session_id,
           min(ts) FILTER (WHERE event_type = 'view') AS start_time,
           max(ts) FILTER (WHERE event_type = 'purchase') AS end_time
    FROM events WHERE event_type IN ('view', 'purchase')
    GROUP BY user_id, {K}) p
  WHERE end_time >= start_time"""

READINGS_IN_SESSIONS = f"""
  WITH s AS ({PAIRS}),
  r AS (SELECT user_id, ts AS time, value AS heartrate FROM events
        WHERE event_type = 'click' AND COALESCE(value BETWEEN 1 AND 220, false))
  SELECT s.user_id, s.session_id, s.start_time, s.end_time, r.time, r.heartrate
  FROM r JOIN s ON r.user_id = s.user_id AND r.time BETWEEN s.start_time AND s.end_time"""

SESSION_SUMMARY = """
  SELECT o.o_custkey AS user_id, l.l_orderkey AS session_id, o.o_orderdate AS end_time,
         c.c_mktsegment AS segment, c.c_nationkey AS nation_key,
         min(l.l_quantity) AS min_bpm, avg(l.l_quantity) AS avg_bpm,
         max(l.l_quantity) AS max_bpm, count(l.l_quantity) AS num_recordings
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON c.c_custkey = o.o_custkey
  GROUP BY o.o_custkey, l.l_orderkey, o.o_orderdate, c.c_mktsegment, c.c_nationkey"""

AGE = ("year(DATE '2024-02-29') - year(dob) - CASE WHEN month(DATE '2024-02-29') < month(dob) "
       "OR (month(DATE '2024-02-29') = month(dob) AND day(DATE '2024-02-29') < day(dob)) "
       "THEN 1 ELSE 0 END")

AGE_BINS = f"""
  WITH p AS (SELECT o_custkey AS user_id, CAST(min(o_orderdate) AS DATE) AS dob
             FROM orders GROUP BY o_custkey),
  a AS (SELECT user_id, {AGE} AS age FROM p)
  SELECT a.user_id,
         CASE WHEN age IS NULL OR age < 0 THEN 'invalid' WHEN age < 23 THEN 'under 23'
              WHEN age < 25 THEN '23-24' WHEN age < 27 THEN '25-26'
              WHEN age < 29 THEN '27-28' ELSE '29+' END AS age,
         c.c_mktsegment AS segment, n.n_name AS nation
  FROM a JOIN customer c ON c.c_custkey = a.user_id
  JOIN nation n ON n.n_nationkey = c.c_nationkey"""

ORACLE: dict[str, str] = {
    "session_summary": SESSION_SUMMARY,

    "visit_minutes": f"""
  WITH w AS (SELECT l_orderkey, min(l_shipdate) AS start_time, max(l_shipdate) AS end_time
             FROM lineitem GROUP BY l_orderkey),
  s AS (SELECT o.o_custkey AS mac_address, w.l_orderkey AS session_id, w.start_time, w.end_time
        FROM w JOIN orders o ON o.o_orderkey = w.l_orderkey),
  v AS (SELECT o_custkey AS mac_address, o_orderpriority AS gym, o_orderkey AS visit_id,
               o_orderdate AS login,
               CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 90 DAY END AS logout
        FROM orders)
  SELECT CAST(v.login AS DATE) AS date, v.gym, s.mac_address, v.visit_id, s.session_id,
         round(({EPOCH_S.format(c='v.logout')} - {EPOCH_S.format(c='v.login')}) / 60, 2)
           AS minutes_in_gym,
         round(({EPOCH_S.format(c='s.end_time')} - {EPOCH_S.format(c='s.start_time')}) / 60, 2)
           AS minutes_exercising
  FROM v JOIN s ON v.mac_address = s.mac_address AND s.start_time BETWEEN v.login AND v.logout
  ORDER BY date, gym, mac_address, session_id""",

    "envelope_decode": f"""
  SELECT CAST(event_id AS VARCHAR) AS key, {K} AS k, event_type AS topic,
         user_id AS "partition", event_id AS "offset", {EPOCH_S.format(c='ts')} AS "timestamp"
  FROM events""",

    "topic_week_counts": """
  SELECT event_type AS topic, strftime(ts, '%G-%V') AS week_part, count(*) AS n
  FROM events GROUP BY event_type, strftime(ts, '%G-%V')""",

    "epoch_to_timestamp": """
  SELECT event_id, epoch_us(ts) / 1e6 AS registration_timestamp, ts AS registered_at
  FROM events""",

    "envelope_encode": """
  SELECT CAST(user_id AS VARCHAR) AS key, event_id, ts, user_id, event_type, value, props
  FROM events""",

    "visit_upsert": """
  SELECT l_suppkey AS mac_address, l_returnflag AS gym, l_shipdate AS login,
         max(CASE WHEN l_linestatus <> 'O'
                  THEN l_shipdate + to_hours(CAST(l_quantity AS BIGINT)) END) AS logout
  FROM lineitem GROUP BY l_suppkey, l_returnflag, l_shipdate""",

    "start_stop_pairs": PAIRS,
    "readings_in_sessions": READINGS_IN_SESSIONS,
    "readings_bucketed": READINGS_IN_SESSIONS,
    "age_bins": AGE_BINS,

    "validity_flag": """
  SELECT user_id AS device_id, ts AS time, value AS heartrate,
         COALESCE(value BETWEEN 1 AND 220, false) AS valid
  FROM events""",

    "count_checks": f"""
  SELECT 'valid_le_readings' AS "check", (SELECT count(*) FROM events) AS expected,
         (SELECT count(*) FROM events WHERE value BETWEEN 1 AND 220) AS actual,
         (SELECT count(*) FROM events WHERE value BETWEEN 1 AND 220)
           <= (SELECT count(*) FROM events) AS ok
  UNION ALL
  SELECT 'readings_in_sessions_le_readings',
         (SELECT count(*) FROM events WHERE event_type = 'click'),
         (SELECT count(*) FROM ({READINGS_IN_SESSIONS}) x),
         (SELECT count(*) FROM ({READINGS_IN_SESSIONS}) x)
           <= (SELECT count(*) FROM events WHERE event_type = 'click')
  UNION ALL
  SELECT 'sessions_le_starts', (SELECT count(*) FROM events WHERE event_type = 'view'),
         (SELECT count(*) FROM ({PAIRS}) y),
         (SELECT count(*) FROM ({PAIRS}) y)
           <= (SELECT count(*) FROM events WHERE event_type = 'view')
  UNION ALL
  SELECT 'bins_equal_users', (SELECT count(DISTINCT o_custkey) FROM orders),
         (SELECT count(*) FROM ({AGE_BINS}) z),
         (SELECT count(*) FROM ({AGE_BINS}) z) = (SELECT count(DISTINCT o_custkey) FROM orders)""",

    "rows_equal": "SELECT CAST(0 AS BIGINT) AS missing, CAST(0 AS BIGINT) AS extra",
}

_FIRST_SEEN = """
  SELECT user_id, device_id, lpad(hex(device_id), 12, '0') AS mac_address, "timestamp" FROM (
    SELECT user_id, event_id % 10 AS device_id, CASE WHEN event_id % 10 <> 3 THEN ts END AS "timestamp",
           row_number() OVER (PARTITION BY user_id
             ORDER BY CASE WHEN event_id % 10 <> 3 THEN ts END NULLS LAST, event_id % 10) AS rn
    FROM events) f
  WHERE rn = 1"""

ORACLE.update({
    "first_seen_insert_only": """
  SELECT user_id, CAST(1 AS BIGINT) AS n_rows FROM events GROUP BY user_id""",
    "first_seen_earliest_wins": _FIRST_SEEN,

    "latest_profile": f"""
  SELECT user_id, update_type, score, k, "offset", "timestamp" FROM (
    SELECT user_id, event_type AS update_type, value AS score, {K} AS k,
           event_id AS "offset", ts AS "timestamp",
           row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
    FROM events) p
  WHERE rn = 1""",

    "pairs_streaming": PAIRS,

    "summary_stream": """
  SELECT e.user_id, e.event_type, c.c_mktsegment AS segment, min(e.value) AS min_value,
         round(avg(e.value), 6) AS avg_value, max(e.value) AS max_value, count(e.value) AS n
  FROM events e JOIN customer c ON c.c_custkey = e.user_id
  GROUP BY e.user_id, e.event_type, c.c_mktsegment""",

    "csv_ingest": """
  SELECT user_id, event_id AS device_id, lpad(hex(event_id), 12, '0') AS mac_address,
         epoch_us(ts) / 1e6 AS registration_timestamp
  FROM events""",

    "bus_ingest": f"""
  SELECT CAST(event_id AS VARCHAR) AS key, {K} AS k, event_type AS topic,
         event_id AS "offset",
         {EPOCH_S.format(c='ts')} * CASE WHEN event_id % 50 = 0 THEN 1000000 ELSE 1 END AS "timestamp",
         CASE WHEN event_id % 50 <> 0 THEN strftime(ts, '%G-%V') END AS week_part
  FROM events WHERE event_type = 'click'""",

    "compact_files": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
})

_LAYER_SESSIONS = """
  SELECT o.o_custkey AS user_id, CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS workout_id,
         CAST(o.o_orderkey AS INTEGER) AS session_id, w.s AS start_time, w.e AS end_time
  FROM (SELECT l_orderkey, min(l_shipdate) AS s, max(l_shipdate) AS e
        FROM lineitem GROUP BY l_orderkey) w
  JOIN orders o ON o.o_orderkey = w.l_orderkey"""

ORACLE.update({
    "layer_waves": f"""
  WITH sess AS ({_LAYER_SESSIONS}),
  r_all AS (SELECT o.o_custkey AS device_id, l.l_shipdate + to_minutes(l.l_linenumber) AS time,
                   l.l_quantity * 4 - 20 AS heartrate, l.l_orderkey * 8 + l.l_linenumber AS off
            FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey),
  r AS (SELECT device_id, time, heartrate FROM (
          SELECT *, row_number() OVER (PARTITION BY device_id, time ORDER BY off, heartrate) AS rn
          FROM r_all) x WHERE rn = 1),
  bpm AS (SELECT s.user_id, s.workout_id, s.session_id, r.heartrate
          FROM r JOIN customer c ON c.c_custkey = r.device_id
          JOIN sess s ON s.user_id = c.c_custkey AND r.time BETWEEN s.start_time AND s.end_time
          WHERE r.heartrate > 0)
  SELECT workout_id, session_id, user_id, min(heartrate) AS min_bpm, avg(heartrate) AS avg_bpm,
         max(heartrate) AS max_bpm, count(heartrate) AS num_recordings
  FROM bpm GROUP BY workout_id, session_id, user_id""",

    "gym_summary": f"""
  WITH sess AS ({_LAYER_SESSIONS}),
  g AS (SELECT lpad(hex(o_custkey), 12, '0') AS mac_address,
               CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS gym, o_orderdate AS login,
               max(CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 90 DAY END) AS logout
        FROM orders GROUP BY 1, 2, 3),
  w AS (SELECT lpad(hex(c.c_custkey), 12, '0') AS mac_address, s.workout_id, s.session_id,
               s.start_time, s.end_time
        FROM sess s JOIN customer c ON c.c_custkey = s.user_id)
  SELECT CAST(g.login AS DATE) AS date, g.gym, g.mac_address, w.workout_id, w.session_id,
         round(({EPOCH_S.format(c='g.logout')} - {EPOCH_S.format(c='g.login')}) / 60, 2)
           AS minutes_in_gym,
         round(({EPOCH_S.format(c='w.end_time')} - {EPOCH_S.format(c='w.start_time')}) / 60, 2)
           AS minutes_exercising
  FROM g JOIN w ON g.mac_address = w.mac_address AND w.start_time BETWEEN g.login AND g.logout
  ORDER BY date, gym, mac_address, session_id""",
})

_PROFILES = f"""
  SELECT * FROM (
    SELECT o_custkey AS user_id,
           CASE WHEN o_orderkey % 31 <> 0 THEN DATE '1940-01-01'
             + CAST(trunc(fmod(o_totalprice, 25000)) AS INTEGER) END AS dob,
           o_orderstatus AS sex, o_orderpriority AS gender, CAST(o_orderkey AS VARCHAR) AS first_name,
           CAST(o_custkey AS VARCHAR) AS last_name, 'street ' || o_orderkey AS street_address,
           o_orderpriority AS city, o_orderstatus AS state, CAST(o_orderkey % 100000 AS INTEGER) AS zip,
           CASE WHEN o_orderkey % 89 <> 0 THEN date_trunc('second', o_orderdate) END AS "timestamp",
           row_number() OVER (PARTITION BY o_custkey ORDER BY
             CASE WHEN o_orderkey % 89 <> 0 THEN date_trunc('second', o_orderdate) END DESC NULLS LAST,
             o_orderkey DESC) AS rn
    FROM orders) p
  WHERE rn = 1"""

_FIRST_DEVICES = """
  SELECT * FROM (
    SELECT o_custkey AS user_id, o_custkey * 2 + o_orderkey % 2 AS device_id,
           CASE WHEN o_orderkey % 97 <> 0 THEN o_orderdate END AS registered,
           row_number() OVER (PARTITION BY o_custkey
             ORDER BY CASE WHEN o_orderkey % 97 <> 0 THEN o_orderdate END NULLS LAST,
             o_custkey * 2 + o_orderkey % 2) AS rn
    FROM orders) r
  WHERE rn = 1"""

ORACLE.update({
    "user_profile_layer": f"""
  SELECT user_id, dob, sex, gender, first_name, last_name, street_address, city, state, zip,
         "timestamp" FROM ({_PROFILES}) q""",

    "user_bins_layer": f"""
  SELECT p.user_id,
         CASE WHEN age IS NULL OR age < 0 THEN 'invalid' WHEN age < 18 THEN 'under 18'
              WHEN age < 25 THEN '18-24' WHEN age < 35 THEN '25-34' WHEN age < 45 THEN '35-44'
              WHEN age < 55 THEN '45-54' WHEN age < 65 THEN '55-64' WHEN age < 75 THEN '65-74'
              WHEN age < 85 THEN '75-84' WHEN age < 95 THEN '85-94' ELSE '95+' END AS age,
         gender, city, state, device_id, registered
  FROM (SELECT *, {AGE} AS age FROM ({_PROFILES}) q) p JOIN ({_FIRST_DEVICES}) f ON f.user_id = p.user_id""",

    "layer_checks": """
  WITH n AS (SELECT count(*) AS n, count(DISTINCT o_custkey) AS u FROM orders)
  SELECT 'users_registered_rows' AS "check", 2 * n AS expected, 2 * n AS actual, true AS ok FROM n
  UNION ALL SELECT 'user_info_rows', n, n, true FROM n
  UNION ALL SELECT 'workout_rows', 0, 0, true
  UNION ALL SELECT 'users_rows', 2 * n, u, false FROM n
  UNION ALL SELECT 'user_profile_rows', u, u, true FROM n
  UNION ALL SELECT 'user_bins_rows', u, u, true FROM n
  UNION ALL SELECT 'user_bins_le_users', u, u, true FROM n
  UNION ALL SELECT 'user_bins_le_profiles', u, u, true FROM n
  UNION ALL SELECT 'heart_rate_le_messages', 0, 0, true
  UNION ALL SELECT 'sessions_twice_le_workouts', 0, 0, true""",
})

ORACLE["layer_changes"] = """
  WITH sess AS (
    SELECT CAST(o.o_custkey AS INTEGER) AS user_id,
           CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS workout_id,
           CAST(o.o_orderkey AS INTEGER) AS session_id,
           w.s - CASE WHEN o.o_orderkey % 5 = 0 THEN INTERVAL 10 DAY ELSE INTERVAL 0 DAY END AS start_time,
           CASE WHEN o.o_orderkey % 2 = 0 THEN w.e
                ELSE w.s + to_seconds((epoch_us(w.e) // 1000000 - epoch_us(w.s) // 1000000) // 2) END AS end_time
    FROM (SELECT l_orderkey, min(l_shipdate) AS s, max(l_shipdate) AS e FROM lineitem GROUP BY l_orderkey) w
    JOIN orders o ON o.o_orderkey = w.l_orderkey),
  r AS (
    SELECT * FROM (
      SELECT o.o_custkey * 2 + (l.l_linenumber // 2) % 2 AS device_id,
             l.l_shipdate + to_minutes(l.l_linenumber) AS time, l.l_quantity * 4 - 20 AS heartrate,
             row_number() OVER (PARTITION BY o.o_custkey * 2 + (l.l_linenumber // 2) % 2,
                                             l.l_shipdate + to_minutes(l.l_linenumber)
                                ORDER BY l.l_linenumber % 2, l.l_orderkey * 8 + l.l_linenumber, l.l_quantity) AS rn
      FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey) x WHERE rn = 1),
  bpm AS (
    SELECT s.*, r.time, r.heartrate
    FROM r JOIN customer c ON r.device_id = c.c_custkey * 2 + CASE WHEN c.c_custkey % 3 = 0 THEN 1 ELSE 0 END
    JOIN sess s ON s.user_id = c.c_custkey AND r.time BETWEEN s.start_time AND s.end_time
    WHERE r.heartrate > 0)
  SELECT *, min(heartrate) OVER w AS min_bpm, round(avg(heartrate) OVER w, 6) AS avg_bpm,
         max(heartrate) OVER w AS max_bpm, count(heartrate) OVER w AS num_recordings
  FROM bpm WINDOW w AS (PARTITION BY user_id, workout_id, session_id)"""

_DAMAGED = """
  SELECT event_id, CASE WHEN event_id % 1201 <> 8 THEN user_id END AS user_id, event_type,
         CASE WHEN event_id % 997 = 3 THEN value + 1 ELSE value END AS value
  FROM events, range(2) t(again) WHERE event_id % 1009 <> 5 AND (again = 0 OR event_id % 1013 = 7)"""
_EVENTS4 = "SELECT event_id, user_id, event_type, value FROM events"

ORACLE.update({
    "tables_differ": f"""
  SELECT part, CAST(sum(missing) AS BIGINT) AS missing, CAST(sum(extra) AS BIGINT) AS extra FROM (
    SELECT CAST(floor(event_id / 100) AS BIGINT) AS part, 1 AS missing, 0 AS extra
    FROM (({_DAMAGED}) EXCEPT ALL ({_EVENTS4})) a
    UNION ALL
    SELECT CAST(floor(event_id / 100) AS BIGINT), 0, 1 FROM (({_EVENTS4}) EXCEPT ALL ({_DAMAGED})) b) c
  GROUP BY part""",

    "dedupe_stream": """
  SELECT user_id, count(DISTINCT event_id % 10) AS n_rows FROM events GROUP BY user_id""",

    "csv_rejects": f"""
  WITH l AS (
    SELECT event_id, user_id, event_id % 70 = 7 AS wordy, event_id % 50 = 3 AS short,
           event_id % 110 = 9 AND event_id % 50 <> 3 AS long, {EPOCH_S.format(c='ts')} AS s,
           lpad(hex(event_id), 12, '0') AS mac FROM events)
  SELECT CASE WHEN ok THEN user_id END AS user_id, CASE WHEN ok THEN event_id END AS device_id,
         CASE WHEN ok THEN mac END AS mac_address,
         CASE WHEN ok THEN CAST(s AS DOUBLE) END AS registration_timestamp,
         CASE WHEN NOT ok THEN concat_ws(',', CASE WHEN wordy THEN 'bad' ELSE CAST(user_id AS VARCHAR) END,
           event_id, mac, CASE WHEN NOT short THEN s END, CASE WHEN long THEN 'more' END) END AS text,
         CASE WHEN short THEN '3 of 4 fields' WHEN long THEN 'too many fields'
              WHEN wordy THEN 'no value for user_id' END AS reason
  FROM (SELECT *, NOT (wordy OR short OR long) AS ok FROM l) m""",

    "observed_checks": """
  WITH e AS (
    SELECT 'events.has_user' AS "check", user_id IS NOT NULL AS ok FROM events
    UNION ALL SELECT 'events.valued', value > 10 FROM events
    UNION ALL SELECT 'events.known_type', event_type IN ('click', 'view', 'purchase') FROM events
    UNION ALL SELECT 'events.newer', ts >= TIMESTAMP '2024-01-01' FROM events)
  SELECT "check", count(*) AS rows, count(*) FILTER (WHERE ok IS NOT TRUE) AS broken,
         count(*) FILTER (WHERE ok IS NOT TRUE) = 0 AS ok FROM e GROUP BY "check\"""",

    "compact_partitions": """
  SELECT event_type AS topic, strftime(ts, '%G-%V') AS week_part, count(*) AS rows,
         CAST(sum(event_id) AS BIGINT) AS ids, CAST(1 AS BIGINT) AS files, true AS rewritten, CAST(0 AS BIGINT) AS again
  FROM events GROUP BY 1, 2""",

    "open_sessions": """
  SELECT a.event_id, a.user_id, a.ts AS start_time, b.ts AS end_time
  FROM events a LEFT JOIN events b ON b.event_type = 'purchase' AND b.user_id = a.user_id
    AND b.ts BETWEEN a.ts AND a.ts + INTERVAL 2 HOUR
  WHERE a.event_type = 'view'""",

    "final_windows": """
  WITH e AS (SELECT *, epoch_us(ts) AS us, epoch_us(date_trunc('hour', ts)) AS hour_us FROM events),
  b AS (SELECT min(us) AS lo, max(us) - min(us) + 1 AS wide FROM e),
  d AS (SELECT e.*, (us - lo) * 4 // wide + CASE WHEN event_id % 40 = 7 THEN 1 ELSE 0 END AS k FROM e, b),
  m AS (SELECT g.k, max(d.us) AS newest FROM range(5) g(k) JOIN d ON d.k <= g.k GROUP BY g.k),
  s AS (SELECT d.*, coalesce(us < newest - 30 * 3600000000, false) AS late FROM d LEFT JOIN m ON m.k = d.k - 1),
  w AS (SELECT max(us) - 30 * 3600000000 AS mark FROM s WHERE NOT late)
  SELECT CASE WHEN late THEN 'late' ELSE 'final' END AS kind, date_trunc('hour', ts) AS window_start,
         event_type, count(*) AS n, max(value) AS greatest
  FROM s, w WHERE late OR hour_us + 3600000000 <= mark GROUP BY ALL""",

    "colocated_visits": """
  SELECT c_custkey AS device, c_mktsegment AS segment, count(o_orderkey) AS n, max(o_orderdate) AS newest,
         arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_visit
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2""",
})
