"""DuckDB SQL for the registered streaming forms and hooks (``rivulet.plans.streams``), written independently of them."""

from __future__ import annotations

from rivulet.plans.catalog import AD_CAP
from rivulet.plans.oracle import _ADS_RANKED, _K, _LOGIN_EPISODES, DAY_US, H_US, LOGIN_W_US, ORACLE_SQL

_CLOSE_US = 2 * H_US
_LATE_US = 3 * DAY_US
_SLICES = 4


def _both_windows(src: str, size_us: int, slide_us: int) -> str:
    """Rows of ``src`` (with ``us``) by the end, in ms, of their tumbling and sliding windows."""
    n = size_us // slide_us
    return f"""SELECT 'tumbling' AS windows, (us // {size_us} + 1) * {size_us // 1000} AS window_end, * EXCLUDE us FROM {src}
      UNION ALL SELECT 'sliding', unnest(generate_series(us // {slide_us} + 1, us // {slide_us} + {n})) * {slide_us // 1000}, * EXCLUDE us FROM {src}"""


STREAM_ORACLE_SQL: dict[str, str] = {
    "stream_unique_visitors_running": ORACLE_SQL["unique_visitors_running"],
    "stream_url_changelog": ORACLE_SQL["hot_urls"],
    "stream_lateness_split": f"""
WITH e AS (SELECT event_id, epoch_us(ts) AS us, coalesce(event_id % {_SLICES}, 0) AS s FROM events),
m AS (SELECT s, max(max(us)) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM e GROUP BY s)
SELECT event_id, coalesce(us < newest - {_LATE_US}, false) AS late FROM e JOIN m USING (s)""",
    "stream_page_views": f"""
WITH pv AS (SELECT epoch_us(ts) // 1000000 * 1000000 AS us FROM events WHERE event_type = 'view')
SELECT us // {H_US} * {H_US // 1000} AS window_start, (us // {H_US} + 1) * {H_US // 1000} AS window_end, count(*) AS pv
FROM pv WHERE (us // {H_US} + 1) * {H_US} <= (SELECT max(us) FROM pv) - {_CLOSE_US} GROUP BY us // {H_US}""",
    "stream_unique_visitors_upsert": ORACLE_SQL["unique_visitors_bitmap"],
    "stream_unique_visitors_state": ORACLE_SQL["unique_visitors_bitmap"],
    "stream_ad_clicks": f"""
SELECT user_id, ad_id, province, ts, seq, CASE WHEN rn <= {AD_CAP + 1} THEN 'pass' ELSE 'warn' END AS kind,
  CASE WHEN rn > {AD_CAP + 1} THEN 'click over {AD_CAP} times today.' END AS msg
FROM ({_ADS_RANKED}) WHERE rn <= {AD_CAP + 2}""",
    "stream_login_fail_warnings": f"""
SELECT * EXCLUDE t0 FROM ({_LOGIN_EPISODES.replace("FROM closed", ", t0 FROM closed")})
WHERE t0 + {LOGIN_W_US} < (SELECT max(epoch_us(ts)) // 1000 * 1000 FROM events) - {_CLOSE_US}""",
    "custom_average": f"""
WITH src AS (SELECT epoch_us(ts) AS us, {_K} AS item_id, epoch_us(ts) // 1000000 AS s FROM events WHERE event_type = 'view'),
w AS ({_both_windows("src", DAY_US, 2 * H_US)})
SELECT windows, window_end, item_id, CAST(sum(s) // count(s) AS DOUBLE) AS avg_ts FROM w GROUP BY ALL""",
    "custom_quantiles": f"""
WITH v AS (SELECT epoch_us(ts) AS us, event_type, CAST(round(value * 100) AS BIGINT) AS v FROM events),
src AS (SELECT us, event_type, CASE WHEN abs(v) < 128 THEN v
          ELSE CAST(sign(v) AS BIGINT) * ((abs(v) >> (length(bin(abs(v))) - 7)) << (length(bin(abs(v))) - 7)) END AS b FROM v),
w AS ({_both_windows("src", H_US, H_US // 12)}),
c AS (SELECT windows, window_end, event_type, b, count(b) AS n FROM w GROUP BY ALL),
r AS (SELECT *, sum(n) OVER (PARTITION BY windows, window_end, event_type ORDER BY b) AS up,
             CAST(sum(n) OVER (PARTITION BY windows, window_end, event_type) AS DOUBLE) AS total FROM c)
SELECT windows, window_end, event_type, min(b) FILTER (WHERE up >= greatest(1, ceil(CAST(0.5 AS DOUBLE) * total))) AS p50,
  min(b) FILTER (WHERE up >= greatest(1, ceil(CAST(0.99 AS DOUBLE) * total))) AS p99
FROM r GROUP BY windows, window_end, event_type""",
    "custom_windows": f"""
WITH src AS (SELECT ['wechat', 'weibo', 'appstore', 'huaweistore'][{_K} % 4 + 1] AS channel, CAST(user_id AS VARCHAR) AS user_id,
               epoch_us(ts) AS us, event_id AS seq FROM events),
x AS (SELECT *, unnest(generate_series(us // 1200000000 + 1, us // 1200000000 + 3)) AS slot FROM src),
y AS (SELECT *, us - lag(us) OVER (PARTITION BY channel, slot ORDER BY us, seq) AS gap FROM x)
SELECT channel, (slot - 3) * 1200000 AS window_start, slot * 1200000 AS window_end, count(*) AS n, coalesce(max(gap), 0) AS longest_gap_us,
  first(user_id ORDER BY us, seq) AS first_user, last(user_id ORDER BY us, seq) AS last_user
FROM y GROUP BY channel, slot""",
}
