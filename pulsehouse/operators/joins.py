"""Joins (J1-J7): dimension joins, interval joins, start/stop pairing.

Scale notes
-----------
* No join is hinted to broadcast: which side is small is left to AQE, which
  knows the real size of a side after its shuffle
  (``spark.sql.adaptive.autoBroadcastJoinThreshold``).
* ``interval_join`` (equi key + ``point BETWEEN lo AND hi``): keys with at most
  ``FEW`` ranges are joined by the key alone, where a point is compared with
  that many ranges and nothing is copied (a key hot in points is split by AQE).
  Keys with more get a time-bucketed plan with bucket widths w, k*w, k*k*w, ...
  A range goes to the one level at which it covers at most k + 1 buckets, and
  is copied to those; a point falls in one bucket of each level in use. That
  join runs on (key, level, bucket), so a hot key (say a third of all rows) is
  spread over many join groups, and no range, however long, is copied more than
  k + 1 times. The range check stays as the residual predicate, so results are
  exact; a (point, range) pair meets in exactly one bucket of one level.
* Start/stop pairing is one partial+final aggregation (map-side combine),
  never a self-join that would emit all pairs of a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsehouse.functions.time import epoch_seconds


def join_dimension(facts: DataFrame, dim: DataFrame, on: list[str] | str,
                   how: str = "inner") -> DataFrame:
    """Fact x dimension equi-join (J1, J2, J6); rows without a match are
    dropped for ``inner``."""
    return facts.join(dim, on=on, how=how)


def _qualified_join(left: DataFrame, right: DataFrame, keys: list[str],
                    extra: Column | None, how: str = "inner") -> DataFrame:
    """Join on equal ``keys`` plus an extra condition; keys appear once."""
    l, r = left.alias("__l"), right.alias("__r")
    cond = None
    for k in keys:
        c = F.col(f"__l.{k}") == F.col(f"__r.{k}")
        cond = c if cond is None else cond & c
    if extra is not None:
        cond = extra if cond is None else cond & extra
    out = [F.col(f"__l.{c}") for c in left.columns]
    out += [F.col(f"__r.{c}") for c in right.columns if c not in keys]
    return l.join(r, cond, how).select(*out)


# Levels of bucket widths: 60 s, 16 min, about 4 h, 3 days, 45 days, 2 years, ...
# up to the whole span of a timestamp.
BASE_SECONDS, WIDER, LEVELS = 60, 16, 10
# Ranges of a key up to which its points are compared with all of them.
FEW = 100


def _level(length: Column, base: int) -> Column:
    """Lowest level whose width times ``WIDER`` is at least the length in seconds."""
    out = F.lit(LEVELS - 1)
    for k in reversed(range(LEVELS - 1)):
        out = F.when(length <= base * WIDER ** (k + 1), F.lit(k)).otherwise(out)
    return out


def _width(level: Column, base: int) -> Column:
    return F.element_at(F.array(*[F.lit(base * WIDER ** k) for k in range(LEVELS)]), level + 1)


def _bucket(ts, width: Column) -> Column:
    # floor division in whole numbers: a bucket's edges are exact at any level
    s = epoch_seconds(ts)
    return ((s - F.pmod(s, width)) / width).cast("long")


def interval_join(points: DataFrame, ranges: DataFrame, on: list[str], point: str,
                  lo: str, hi: str, strategy: str = "bucketed",
                  bucket_seconds: int = BASE_SECONDS) -> DataFrame:
    """Inner join: equal ``on`` keys and ``points.point BETWEEN ranges.lo AND ranges.hi``.

    Both ends inclusive; a NULL bound never matches (SQL BETWEEN semantics).
    ``strategy="range"`` leaves the plan to Catalyst (hash join on the keys,
    range as a residual condition): fine when no key is hot.
    ``strategy="bucketed"`` (default) adds a level and a time bucket to the
    join key of keys with more than ``FEW`` ranges (see the module's text);
    ``bucket_seconds`` is the width of the lowest level. Whether there are such
    keys, and which levels they use, is read from the ranges first: one
    aggregation by key, and for these keys one to at most ``LEVELS`` numbers.
    The exploded sides carry a sort-merge hint: Catalyst's size estimate does
    not grow through ``explode``, so without it the planner could broadcast a
    side far larger than it believes. Non-key column names of the two sides
    must differ.
    """
    between = F.col(f"__l.{point}").between(F.col(f"__r.{lo}"), F.col(f"__r.{hi}"))
    if strategy == "range":
        return _qualified_join(points, ranges, on, between)
    if strategy != "bucketed":
        raise ValueError(f"unknown interval join strategy {strategy!r}")
    real = ranges.where(F.col(hi) >= F.col(lo))
    many = real.groupBy(*on).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > FEW).select(*on)
    if many.isEmpty():
        return _qualified_join(points, real, on, between)
    few = _qualified_join(points, real.join(many, on, "left_anti").select(*real.columns), on, between)
    base = int(bucket_seconds)
    real = real.join(many, on, "left_semi").select(*real.columns).withColumn(
        "__level", _level(epoch_seconds(hi) - epoch_seconds(lo), base))
    used = real.agg(F.sort_array(F.collect_set("__level"))).first()[0]
    width = _width(F.col("__level"), base)
    r = real.withColumn("__bucket", F.explode(F.sequence(
        _bucket(lo, width), _bucket(hi, width)))).hint("merge")
    levels = F.array(*[F.lit(k) for k in used]).cast("array<int>")
    p = (points.join(many, on, "left_semi").select(*points.columns)
         .withColumn("__level", F.explode(levels)).withColumn("__bucket", _bucket(point, width)))
    out = _qualified_join(p, r, on + ["__level", "__bucket"], between).drop("__level", "__bucket")
    return few.unionByName(out)


def pair_actions(events: DataFrame, keys: list[str], time_col: str, action_col: str,
                 start_value: str, stop_value: str, start_name: str = "start_time",
                 end_name: str = "end_time") -> DataFrame:
    """Start/stop actions -> one completed session per key.

    start = earliest start action, end = latest stop action; a key is emitted
    only once it has a stop at or after its start (a start without a stop is
    not a session yet). One aggregation, so it also runs over a stream in
    update mode: a session appears with its stop and again when it changes.
    """
    a, t = F.col(action_col), F.col(time_col)
    sessions = (events.where(a.isin(start_value, stop_value))
                .groupBy(*keys)
                .agg(F.min(F.when(a == start_value, t)).alias(start_name),
                     F.max(F.when(a == stop_value, t)).alias(end_name)))
    return sessions.where(F.col(end_name) >= F.col(start_name))


def open_or_paired(starts: DataFrame, stops: DataFrame, keys: list[str], start_col: str,
                   stop_col: str, within: str, late: str) -> DataFrame:
    """Starts with their stops, or alone (J4 as an outer join of two streams).

    ``keys``, ``start_col``, ``stop_col``: every start with each stop of its keys that comes
    at or after it and no more than ``within`` later; a start whose time for that has gone
    by without one comes with a NULL stop. Both times are instants. State is bounded: a
    start leaves it when the watermark (``late`` behind the newest time of both streams) is
    ``within`` past it, a stop when it is past the stop. This is a report of sessions that
    are open or were closed in time; ``pair_actions`` has no such bound and pairs all rows.
    """
    a, b = starts.withWatermark(start_col, late).alias("__a"), stops.withWatermark(stop_col, late).alias("__b")
    cond = F.col(f"__b.{stop_col}").between(F.col(f"__a.{start_col}"),
                                            F.col(f"__a.{start_col}") + F.expr(f"INTERVAL {within}"))
    for k in keys:
        cond = cond & (F.col(f"__a.{k}") == F.col(f"__b.{k}"))
    return a.join(b, cond, "left_outer").select(*[F.col(f"__a.{c}") for c in starts.columns],
                                                F.col(f"__b.{stop_col}"))


def attach_readings(readings: DataFrame, sessions: DataFrame, on: list[str],
                    time_col: str = "time", start_col: str = "start_time",
                    end_col: str = "end_time", valid_col: str | None = "valid",
                    bridge: DataFrame | None = None, bridge_on: list[str] | None = None,
                    strategy: str = "bucketed", bucket_seconds: int = BASE_SECONDS) -> DataFrame:
    """Readings inside sessions (J5): optional bridge (device -> user), then
    ``time BETWEEN start AND end`` per user. Only valid readings are attached
    (filter applied before the joins so it reaches the scan; give a predicate
    in ``valid_col`` instead of the stored flag to let it reach the files'
    value ranges). A bridge is joined to the sessions, which are fewer than the
    readings, so that these are shuffled once."""
    r = readings
    if valid_col is not None:
        r = r.where(F.expr(valid_col)).drop("valid")
    if bridge is not None and set(on) <= set(bridge.columns) and not set(bridge.columns) - set(on) & set(sessions.columns):
        out = interval_join(r, join_dimension(sessions, bridge, on), bridge_on, time_col, start_col, end_col,
                            strategy=strategy, bucket_seconds=bucket_seconds)
        rest = [c for cols in (r.columns, bridge.columns, sessions.columns) for c in cols if c not in bridge_on]
        return out.select(*bridge_on, *dict.fromkeys(rest))
    if bridge is not None:
        r = join_dimension(r, bridge, bridge_on)
    return interval_join(r, sessions, on, time_col, start_col, end_col,
                         strategy=strategy, bucket_seconds=bucket_seconds)
