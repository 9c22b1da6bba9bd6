"""Event-time helpers that do not depend on the session time zone.

Test tables hold zone-less timestamps (``timestamp_ntz``); watermarks need an
instant (``timestamp``).  We read the wall clock as UTC in both directions, so
window bounds and watermarks come out the same whatever the session zone is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utc_micros(c) -> Column:
    """Microseconds since the epoch of a zone-less timestamp read as UTC."""
    # From its fields: a difference of timestamps is one of instants, and in a zone with
    # clock changes some wall-clock times are none.
    t = _c(c)
    seconds = F.unix_date(F.to_date(t)).cast("long") * 86400 + F.hour(t) * 3600 + F.minute(t) * 60
    return seconds * 1000000 + (F.extract(F.lit("SECOND"), t) * 1000000).cast("long")


def to_utc_instant(c) -> Column:
    """``timestamp_ntz`` -> ``timestamp`` (wall clock read as UTC)."""
    return F.timestamp_micros(utc_micros(c))


def from_utc_micros(c) -> Column:
    """``timestamp`` -> ``timestamp_ntz`` (instant shown as UTC wall clock)."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(c)), F.expr(_EPOCH_NTZ))


def epoch_millis(c) -> Column:
    return F.timestamp_diff("MILLISECOND", F.expr(_EPOCH_NTZ), _c(c))


# The JVM's ``Timestamp.valueOf`` text: one- or two-digit month, day and time
# fields, optional fraction of up to nine digits.
EVENT_TS_FORMAT = "yyyy-M-d H:m:s[.SSSSSSSSS]"


def parse_event_line(c, fmt: str = EVENT_TS_FORMAT) -> tuple[Column, Column]:
    """``"<timestamp>,<word>"`` -> (timestamp_ntz or null, word or null)."""
    parts = F.split(F.trim(_c(c)), ",", -1)
    # The text is read as UTC, whatever the session zone is: a zone with clock
    # changes has wall-clock times that do not exist or occur twice.
    ts = F.try_to_timestamp(F.concat(F.get(parts, 0), F.lit("Z")), F.lit(fmt + "X"))
    return from_utc_micros(ts), F.get(parts, 1)
