"""Text renderings of results: ranked window reports (F7) and messages (F8)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.timefmt import date_string, duration_ms


@dataclass(frozen=True)
class ReportStyle:
    header: str  # text before the rendered window end
    line: str  # format_string pattern with (rank, key, count)
    footer: str


# --- fixed values: report texts that must equal the reference's output ----
HOT_ITEMS_STYLE = ReportStyle(header="time：", line="No%d:商品ID=%s浏览量=%d\n", footer="=" * 23)
HOT_URLS_STYLE = ReportStyle(header="时间：", line="NO%d:url=%s 访问量=%d\n", footer="=" * 26)
BLACKLIST_MESSAGE = "click over %d times today."
LOGIN_WARNING_MESSAGE = "login fail in %s second for %d times."
# ---------------------------------------------------------------------------


def blacklist_message(max_count: int) -> Column:
    return F.lit(BLACKLIST_MESSAGE % max_count)


def seconds_text(within) -> str:
    """A duration in seconds as the messages print it: '2', '0.5', '21600'."""
    return f"{duration_ms(within) / 1000:.3f}".rstrip("0").rstrip(".")


def login_warning_message(n_col, within="2 seconds") -> Column:
    return F.format_string(LOGIN_WARNING_MESSAGE, F.lit(seconds_text(within)), F.col(n_col) if isinstance(n_col, str) else n_col)


def report_line(style: ReportStyle, rank, key, count) -> Column:
    return F.format_string(style.line, rank, key.cast("string"), count)


def report_text(style: ReportStyle, window_end, lines: Column) -> Column:
    """A window's report from its lines in rank order."""
    return F.concat(F.lit(style.header), date_string(window_end), F.lit("\n"), F.array_join(lines, ""), F.lit(style.footer))


def ranked_report(
    top: DataFrame,
    style: ReportStyle,
    window_end: str = "window_end",
    rank: str = "rank",
    key: str = "key",
    count: str = "count",
) -> DataFrame:
    """One text block per window end from already ranked rows.

    ``top`` holds at most N rows per window end, so the per-window list
    gathered here is bounded by N. Streams take their reports from
    ``operators.topn.report_stream``, which needs no further aggregation.
    """
    if top.isStreaming:
        raise ValueError("ranked rows of a stream cannot be grouped again; use hot_items_report or hot_urls_report")
    line = report_line(style, F.col(rank), F.col(key), F.col(count))
    lines = F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), line.alias("l"))))
    return top.groupBy(window_end).agg(
        report_text(style, F.col(window_end), F.transform(lines, lambda x: x["l"])).alias("report"))
