"""Scalar column functions: time conversions, hashing, report rendering."""

from rivulet.functions.hashing import poly_hash, poly_hash_sql
from rivulet.functions.reports import (
    HOT_ITEMS_STYLE,
    HOT_URLS_STYLE,
    ReportStyle,
    blacklist_message,
    login_warning_message,
    ranked_report,
)
from rivulet.functions.timefmt import (
    date_string,
    duration_ms,
    duration_str,
    event_time,
    from_epoch_millis,
    from_epoch_seconds,
    parse_log_time,
    sql_timestamp_string,
    to_epoch_millis,
)

__all__ = [
    "HOT_ITEMS_STYLE", "HOT_URLS_STYLE", "ReportStyle", "blacklist_message", "date_string", "duration_ms",
    "duration_str", "event_time", "from_epoch_millis", "from_epoch_seconds", "login_warning_message",
    "parse_log_time", "poly_hash", "poly_hash_sql", "ranked_report", "sql_timestamp_string", "to_epoch_millis",
]
