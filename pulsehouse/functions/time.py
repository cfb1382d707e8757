"""Time conversions.

All are built-in Catalyst expressions (stay inside whole-stage codegen).
Driver tables carry ``timestamp_ntz``; the helpers accept both kinds.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_micros_ntz(ts) -> Column:
    """Epoch microseconds of a ``timestamp_ntz`` (wall clock read as UTC).
    A ``timestamp`` input is compared with the epoch in the session time zone
    (UTC in this library's sessions)."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), _c(ts))


def epoch_seconds(ts) -> Column:
    """Whole epoch seconds, floored like ``ts::long`` (-0.5 s -> -1).

    ``unix_timestamp`` truncates toward zero before 1970, so the floor is
    taken exactly in integer arithmetic on the microseconds.
    """
    m = epoch_micros_ntz(ts)
    return ((m - F.pmod(m, F.lit(1_000_000))) / F.lit(1_000_000)).cast("long")


def epoch_double(ts) -> Column:
    """Epoch seconds with microsecond fraction, as the sources write them."""
    return epoch_micros_ntz(ts) / F.lit(1_000_000.0)


# Epoch seconds of 0001-01-01 00:00:00 and 9999-12-31 23:59:59 UTC.
_FIRST_SECOND, _LAST_SECOND = -62_135_596_800, 253_402_300_799


def epoch_to_timestamp(x) -> Column:
    """Epoch seconds (double/long) -> TIMESTAMP; NaN, junk and numbers outside
    the years 1 to 9999 (such as an epoch in microseconds) -> NULL (P3).

    ``try_cast`` instead of ``cast`` so one bad value cannot fail a stream
    under ANSI mode; it saturates instead of failing on large numbers, hence
    the range.
    """
    x = _c(x)
    return F.when(x.between(_FIRST_SECOND, _LAST_SECOND), x.try_cast("timestamp"))


def to_instant(ts) -> Column:
    """``timestamp_ntz`` -> ``timestamp`` (needed before watermarks)."""
    return _c(ts).cast("timestamp")


def to_wall(ts) -> Column:
    """``timestamp`` -> ``timestamp_ntz`` (how results are compared and stored)."""
    return _c(ts).cast("timestamp_ntz")


def minutes_between(start, end, scale: int = 2) -> Column:
    """round((end::long - start::long) / 60, 2)."""
    return F.round((epoch_seconds(end) - epoch_seconds(start)) / F.lit(60.0), scale)


def week_part(d) -> Column:
    """ISO week label ``YYYY-ww`` of a date/timestamp.

    The pattern letters ``YYYY-ww`` are rejected by Spark >= 3, so the label
    is built from the ISO week-year and week number.
    """
    d = F.to_date(_c(d))
    return F.concat(F.extract(F.lit("YEAROFWEEK"), d).cast("string"), F.lit("-"),
                    F.lpad(F.weekofyear(d).cast("string"), 2, "0"))
