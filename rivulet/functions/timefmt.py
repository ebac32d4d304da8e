"""Time conversions and renderings.

All of these are built-in Spark expressions, so they stay inside whole-stage
codegen. The session time zone is expected to be UTC (see ``rivulet.session``).
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: formats that must equal the reference's output ---------
LOG_TIME_FORMAT = "dd/MM/yyyy:HH:mm:ss"  # apache log time token
DATE_TOSTRING_FORMAT = "EEE MMM dd HH:mm:ss zzz yyyy"  # java.util.Date.toString
# ---------------------------------------------------------------------------

_UNIT_MS = {
    "ms": 1, "millisecond": 1, "milliseconds": 1,
    "s": 1000, "sec": 1000, "second": 1000, "seconds": 1000,
    "min": 60_000, "minute": 60_000, "minutes": 60_000,
    "h": 3_600_000, "hour": 3_600_000, "hours": 3_600_000,
    "d": 86_400_000, "day": 86_400_000, "days": 86_400_000,
}


def duration_ms(d) -> int:
    """'5 minutes' / timedelta / int seconds -> milliseconds."""
    if isinstance(d, _dt.timedelta):
        return int(d.total_seconds() * 1000)
    if isinstance(d, (int, float)):
        return int(d * 1000)
    m = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]+)\s*", d)
    if not m or m.group(2).lower() not in _UNIT_MS:
        raise ValueError(f"unsupported duration: {d!r}")
    return int(m.group(1)) * _UNIT_MS[m.group(2).lower()]


def duration_str(d) -> str:
    """Duration as a Spark interval string ('N milliseconds')."""
    return f"{duration_ms(d)} milliseconds"


def from_epoch_seconds(c) -> Column:
    """Epoch seconds (long) -> TIMESTAMP (the reference's ``ts * 1000L``)."""
    return F.timestamp_seconds(F.col(c) if isinstance(c, str) else c)


def from_epoch_millis(c) -> Column:
    return F.timestamp_millis(F.col(c) if isinstance(c, str) else c)


def to_epoch_millis(c) -> Column:
    return F.unix_millis(F.col(c) if isinstance(c, str) else c)


def event_time(c) -> Column:
    """Any timestamp column (incl. TIMESTAMP_NTZ, which watermarks refuse) as TIMESTAMP."""
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp")


def parse_log_time(c, fmt: str = LOG_TIME_FORMAT) -> Column:
    """Parse the log time token; a malformed token gives NULL, never an error."""
    return F.try_to_timestamp(F.col(c) if isinstance(c, str) else c, F.lit(fmt))


def sql_timestamp_string(c) -> Column:
    """``java.sql.Timestamp.toString``: 'yyyy-MM-dd HH:mm:ss.f', fraction trimmed, at least one digit."""
    c = F.col(c) if isinstance(c, str) else c
    frac = F.regexp_replace(F.date_format(c, "SSSSSS"), "0+$", "")
    return F.concat(
        F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit("."),
        F.when(frac == "", F.lit("0")).otherwise(frac),
    )


def date_string(c) -> Column:
    """``java.util.Date.toString``: 'Sun Nov 26 09:00:00 UTC 2017'."""
    return F.date_format(F.col(c) if isinstance(c, str) else c, DATE_TOSTRING_FORMAT)
