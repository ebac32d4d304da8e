"""DuckDB SQL for each registered query (the correctness oracle).

Written independently of the Spark plans: window bounds by integer epoch
arithmetic, sliding windows by ``generate_series`` expansion (the textbook
form the Spark side avoids), running counts and caps by window functions, and
the login episode rule by a recursive CTE that folds each user's rows one at
a time. Table ``events`` is a pre-registered view.
"""

from __future__ import annotations

from rivulet.functions.hashing import poly_hash_sql
from rivulet.plans.catalog import AD_CAP, LOGIN_MAX_FAILS

H_US = 3_600_000_000
DAY_US = 86_400_000_000
LOGIN_W_US = 6 * H_US

_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
_DATE_TEXT = "strftime(make_timestamp({us}), '%a %b %d %H:%M:%S UTC %Y')"
_PROVINCE = "['beijing', 'guangdong', 'hebei', 'henan', 'jiangsu', 'shanghai', 'zhejiang'][user_id % 7 + 1]"
_AD_ID = "CAST(list_position(['click', 'error', 'purchase', 'signup', 'view'], event_type) AS BIGINT)"
_URL = f"'/' || event_type || '/' || CAST({_K} AS VARCHAR)"
_IP = "'10.' || CAST((user_id // 65536) % 256 AS VARCHAR) || '.' || CAST((user_id // 256) % 256 AS VARCHAR) || '.' || CAST(user_id % 256 AS VARCHAR)"


def _tumbling(measure: str, name: str, size_us: int = H_US, value: str = "user_id") -> str:
    return f"""
SELECT w * {size_us // 1000} AS window_start, (w + 1) * {size_us // 1000} AS window_end, {measure} AS {name}
FROM (SELECT epoch_us(ts) // {size_us} AS w, {value} AS v FROM events WHERE event_type = 'view')
GROUP BY w"""


def _top(key_expr: str, key: str, where: str, slide_us: int, n_slots: int, top: int, sec_precision: bool) -> str:
    t = "(epoch_us(ts) // 1000000) * 1000000" if sec_precision else "epoch_us(ts)"
    return f"""
WITH src AS (SELECT {key_expr} AS {key}, {t} // {slide_us} AS p FROM events {where}),
c AS (SELECT {key}, slot, count(*) AS cnt
      FROM (SELECT {key}, unnest(generate_series(p + 1, p + {n_slots})) AS slot FROM src)
      GROUP BY {key}, slot),
r AS (SELECT *, row_number() OVER (PARTITION BY slot ORDER BY cnt DESC, {key} ASC) AS rk FROM c)
SELECT slot * {slide_us // 1000} AS window_end, CAST(rk AS INTEGER) AS "rank", {key}, cnt AS "count"
FROM r WHERE rk <= {top}"""


def _report(top_sql: str, header: str, line_fmt: str, key: str, footer_len: int) -> str:
    return f"""
WITH t AS ({top_sql})
SELECT window_end,
  '{header}' || {_DATE_TEXT.format(us='window_end * 1000')} || chr(10)
  || string_agg(printf('{line_fmt}', "rank", CAST({key} AS VARCHAR), "count") || chr(10), '' ORDER BY "rank")
  || repeat('=', {footer_len}) AS report
FROM t GROUP BY window_end"""


def _sliding_text(src: str, keys: list[str], slide_us: int, n_slots: int, select: str) -> str:
    k = ", ".join(keys)
    kc = (k + ", ") if keys else ""
    return f"""
WITH src AS ({src}),
c AS (SELECT {kc}slot, count(*) AS cnt
      FROM (SELECT {kc}unnest(generate_series(p + 1, p + {n_slots})) AS slot FROM src)
      GROUP BY {kc}slot)
SELECT {select} FROM c"""


_HOT_ITEMS = _top(_K, "item_id", "WHERE event_type = 'view'", 300_000_000, 12, 3, False)
_HOT_URLS = _top(_URL, "url", "", 5_000_000, 12, 5, True)

_MARKETING_SRC = ("SELECT ['wechat', 'weibo', 'appstore', 'huaweistore'][" + _K + " % 4 + 1] AS channel, "
                  "upper(event_type) AS behavior, epoch_us(ts) // 10000000 AS p FROM events WHERE event_type <> 'signup'")
_MARKETING_SELECT = ("(slot - 360) * 10000 AS window_start, slot * 10000 AS window_end, "
                     "{channel} AS channel, {behavior} AS behavior, cnt AS \"count\"")

_ADS_RANKED = f"""
SELECT user_id, {_AD_ID} AS ad_id, {_PROVINCE} AS province, epoch_us(ts) // 1000000 AS ts, event_id AS seq,
  epoch_us(ts) AS us,
  row_number() OVER (PARTITION BY user_id, {_AD_ID}, CAST(ts AS DATE) ORDER BY ts, event_id) AS rn
FROM events"""

_LOGIN_ROWS = "SELECT user_id, event_id AS seq, epoch_us(ts) AS us, coalesce(event_type = 'error', false) AS fail FROM events"

_LOGIN_BURSTS = f"""
WITH l AS ({_LOGIN_ROWS}),
s AS (SELECT *, sum(CASE WHEN fail THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY us, seq
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seg FROM l),
c AS (SELECT *, count(CASE WHEN fail THEN 1 END) OVER w AS n, max(CASE WHEN fail THEN us END) OVER w AS last_us
      FROM s WINDOW w AS (PARTITION BY user_id, seg ORDER BY us RANGE BETWEEN CURRENT ROW AND {LOGIN_W_US} FOLLOWING))
SELECT user_id, us // 1000000 AS first_fail_time, last_us // 1000000 AS last_fail_time, seq AS first_seq,
  n AS fail_count
FROM c WHERE fail AND n >= {LOGIN_MAX_FAILS}"""

# one row of state per (user, step): open episode (t0, s0, n, tl) and what closed at this step (e_*)
_W, _N = LOGIN_W_US, LOGIN_MAX_FAILS
_LOGIN_EPISODES = f"""
WITH RECURSIVE l AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY us, seq) AS rn FROM ({_LOGIN_ROWS})
),
st AS (
  SELECT user_id, rn,
    CASE WHEN fail THEN us END AS t0, CASE WHEN fail THEN seq END AS s0,
    CASE WHEN fail THEN 1 ELSE 0 END AS n, CASE WHEN fail THEN us END AS tl,
    NULL::BIGINT AS e_t0, NULL::BIGINT AS e_s0, NULL::BIGINT AS e_tl, NULL::BIGINT AS e_n
  FROM l WHERE rn = 1
  UNION ALL
  SELECT st.user_id, l.rn,
    CASE WHEN st.t0 IS NOT NULL AND l.us <= st.t0 + {_W} THEN (CASE WHEN l.fail THEN st.t0 END)
         ELSE (CASE WHEN l.fail THEN l.us END) END,
    CASE WHEN st.t0 IS NOT NULL AND l.us <= st.t0 + {_W} THEN (CASE WHEN l.fail THEN st.s0 END)
         ELSE (CASE WHEN l.fail THEN l.seq END) END,
    CASE WHEN st.t0 IS NOT NULL AND l.us <= st.t0 + {_W} THEN (CASE WHEN l.fail THEN st.n + 1 ELSE 0 END)
         ELSE (CASE WHEN l.fail THEN 1 ELSE 0 END) END,
    CASE WHEN l.fail THEN l.us END,
    CASE WHEN st.t0 IS NOT NULL AND l.us > st.t0 + {_W} AND st.n >= {_N} THEN st.t0 END,
    CASE WHEN st.t0 IS NOT NULL AND l.us > st.t0 + {_W} AND st.n >= {_N} THEN st.s0 END,
    CASE WHEN st.t0 IS NOT NULL AND l.us > st.t0 + {_W} AND st.n >= {_N} THEN st.tl END,
    CASE WHEN st.t0 IS NOT NULL AND l.us > st.t0 + {_W} AND st.n >= {_N} THEN st.n END
  FROM st JOIN l ON l.user_id = st.user_id AND l.rn = st.rn + 1
),
closed AS (
  SELECT user_id, e_t0 AS t0, e_s0 AS s0, e_tl AS tl, e_n AS n FROM st WHERE e_t0 IS NOT NULL
  UNION ALL
  SELECT st.user_id, t0, s0, tl, n FROM st
  JOIN (SELECT user_id, max(rn) AS rn FROM l GROUP BY user_id) last USING (user_id, rn)
  WHERE t0 IS NOT NULL AND n >= {_N}
)
SELECT user_id, t0 // 1000000 AS first_fail_time, tl // 1000000 AS last_fail_time, s0 AS first_seq,
  CAST(n AS BIGINT) AS fail_count, printf('login fail in {_W // 1000000} second for %d times.', n) AS msg
FROM closed"""


ORACLE_SQL: dict[str, str] = {
    "page_views": _tumbling("count(*)", "pv"),
    "unique_visitors": _tumbling("count(DISTINCT v)", "uv"),
    "unique_visitors_sketch": f"SELECT *, true AS within_bound FROM ({_tumbling('count(DISTINCT v)', 'uv')})",
    "page_views_printed": f"""
SELECT strftime(make_timestamp(w * {H_US}), '%Y-%m-%d %H:%M:%S.0') AS window_start,
  strftime(make_timestamp((w + 1) * {H_US}), '%Y-%m-%d %H:%M:%S.0') AS window_end, count(*) AS pv
FROM (SELECT epoch_us(ts) // {H_US} AS w FROM events WHERE event_type = 'view') GROUP BY w""",
    "parse_ad_clicks": f"""
SELECT user_id, {_AD_ID} AS ad_id, {_PROVINCE} AS province, {_PROVINCE} AS city, epoch_us(ts) // 1000000 AS ts,
  event_id AS seq, (epoch_us(ts) // 1000000) * 1000 AS event_time
FROM events""",
    "parse_rejects": f"""
SELECT 'access_log' AS parser, count(*) AS n_lines, count(*) FILTER (WHERE ts IS NULL) AS n_rejects FROM events
UNION ALL SELECT 'ad_clicks', count(*), count(*) FILTER (WHERE user_id IS NULL OR event_type IS NULL OR ts IS NULL) FROM events
UNION ALL SELECT 'logins', count(*), count(*) FILTER (WHERE user_id IS NULL OR ts IS NULL) FROM events
UNION ALL SELECT 'user_behavior', count(*), count(*) FILTER (WHERE user_id IS NULL OR {_K} IS NULL OR ts IS NULL) FROM events""",
    "parse_logins": f"""
SELECT user_id, {_IP} AS ip, CASE WHEN event_type = 'error' THEN 'fail' ELSE 'success' END AS event_type,
  epoch_us(ts) // 1000000 AS ts, event_id AS seq, (epoch_us(ts) // 1000000) * 1000 AS event_time
FROM events""",
    "unique_visitors_bitmap": _tumbling("count(DISTINCT v)", "uv", value=poly_hash_sql("user_id")),
    "unique_visitors_bitmap_shards": f"""
SELECT w * {H_US // 1000} AS window_start, (w + 1) * {H_US // 1000} AS window_end,
  CASE WHEN off = 0 THEN 0 ELSE (off - 1) // 32768 + 1 END AS shard, count(DISTINCT off) AS uv
FROM (SELECT epoch_us(ts) // {H_US} AS w, {poly_hash_sql("user_id")} AS off FROM events WHERE event_type = 'view')
GROUP BY w, shard""",
    "unique_visitors_running": f"""
WITH pv AS (SELECT event_id AS seq, epoch_us(ts) AS us, epoch_us(ts) // {H_US} AS w,
              {poly_hash_sql("user_id")} AS off FROM events WHERE event_type = 'view'),
f AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY w, off ORDER BY us, seq) = 1 THEN 1 ELSE 0 END AS first
      FROM pv)
SELECT seq, w * {H_US // 1000} AS window_start, (w + 1) * {H_US // 1000} AS window_end,
  CAST(sum(first) OVER (PARTITION BY w ORDER BY us, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)
    AS uv
FROM f""",
    "hot_items": _HOT_ITEMS,
    "hot_items_report": _report(_HOT_ITEMS, "time：", "No%d:商品ID=%s浏览量=%d", "item_id", 23),
    "hot_urls": _HOT_URLS,
    "hot_urls_report": _report(_HOT_URLS, "时间：", "NO%d:url=%s 访问量=%d", "url", 26),
    "item_average_time": f"""
SELECT (w + 1) * {DAY_US // 1000} AS window_end, item_id, CAST(sum(s) // count(s) AS DOUBLE) AS avg_ts
FROM (SELECT epoch_us(ts) // {DAY_US} AS w, {_K} AS item_id, epoch_us(ts) // 1000000 AS s
      FROM events WHERE event_type = 'view')
GROUP BY w, item_id""",
    "marketing_total": _sliding_text(
        _MARKETING_SRC, [], 10_000_000, 360,
        _MARKETING_SELECT.format(channel="'app marketing'", behavior="'total'")),
    "marketing_by_channel": _sliding_text(
        _MARKETING_SRC, ["channel", "behavior"], 10_000_000, 360,
        _MARKETING_SELECT.format(channel="channel", behavior="behavior")),
    "ad_clicks_capped": f"SELECT user_id, ad_id, province, ts, seq FROM ({_ADS_RANKED}) WHERE rn <= {AD_CAP + 1}",
    "ad_blacklist": f"""
SELECT user_id, ad_id, ts, 'click over {AD_CAP} times today.' AS msg FROM ({_ADS_RANKED}) WHERE rn = {AD_CAP + 2}""",
    "ad_clicks_by_province": _sliding_text(
        f"SELECT province, us // 5000000 AS p FROM ({_ADS_RANKED}) WHERE rn <= {AD_CAP + 1}",
        ["province"], 5_000_000, 720,
        "slot * 5000 AS window_end, province, cnt AS \"count\""),
    "login_fail_warnings": _LOGIN_EPISODES,
    "login_fail_bursts": _LOGIN_BURSTS,
    "parse_access_log": f"""
SELECT {_IP} AS ip, CAST(user_id AS VARCHAR) AS user_id, (epoch_us(ts) // 1000000) * 1000 AS event_time,
  CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END AS method, {_URL} AS url
FROM events""",
    "parse_user_behavior": f"""
SELECT user_id, {_K} AS item_id, CAST({_K} // 10 AS INTEGER) AS category_id,
  CASE WHEN event_type = 'view' THEN 'pv' ELSE event_type END AS behavior, epoch_us(ts) // 1000000 AS ts
FROM events""",
}
