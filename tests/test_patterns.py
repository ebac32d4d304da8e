
from conftest import SF01, fixture_path
from pyspark.sql import functions as F

from rivulet.operators.patterns import click_cap, login_fail_bursts, login_fail_episodes
from rivulet.plans import jobs
from rivulet.sources import parse_ad_clicks, parse_logins, tables


def _ads(spark):
    # file order as the tie-breaker, like the reference's arrival order
    return parse_ad_clicks(spark.read.text(fixture_path("ad_clicks.csv"))).rows.withColumn(
        "seq", F.monotonically_increasing_id())


def _logins(spark):
    return parse_logins(spark.read.text(fixture_path("logins.csv"))).rows.withColumn(
        "seq", F.monotonically_increasing_id())


def test_click_cap_golden(spark):
    res = click_cap(_ads(spark), max_count=100)
    assert res.passed.count() == 123
    w = [tuple(r) for r in res.warnings.collect()]
    assert w == [(937166, 1715, 1511661702, "click over 100 times today.")]
    hot = res.passed.where("user_id = 937166 AND ad_id = 1715").count()
    assert hot == 101


def test_click_cap_pass_plus_dropped_is_input(spark):
    ads = tables.ad_clicks(tables.events(spark, SF01))
    for cap in (0, 1, 2):
        res = click_cap(ads, max_count=cap)
        per_key = ads.groupBy("user_id", "ad_id", F.to_date("event_time").alias("d")).count()
        expected_pass = per_key.select(F.sum(F.least(F.col("count"), F.lit(cap + 1)))).first()[0]
        expected_warn = per_key.where(F.col("count") >= cap + 2).count()
        assert res.passed.count() == expected_pass
        assert res.warnings.count() == expected_warn


def test_ads_by_province_golden(spark):
    res = jobs.ad_clicks_by_province(_ads(spark), max_count=100)
    stats = {r.province: (r.n, r.mx) for r in res.by_province.groupBy("province").agg(
        F.count("*").alias("n"), F.max("count").alias("mx")).collect()}
    assert stats == {"beijing": (1460, 102), "guangdong": (828, 5), "hebei": (720, 1), "henan": (735, 3),
                     "jiangsu": (730, 4), "shanghai": (780, 2), "zhejiang": (735, 5)}
    assert res.by_province.count() == 5988


def test_login_episode_golden(spark):
    got = [tuple(r) for r in login_fail_episodes(_logins(spark), within="2 seconds", min_fails=2)
           .select("user_id", "first_fail_time", "last_fail_time", "msg").collect()]
    assert got == [(1035, 1558430842, 1558430844, "login fail in 2 second for 3 times.")]


def test_login_bursts_golden(spark):
    got = sorted((r.user_id, r.first_fail_time % 1000, r.fail_count)
                 for r in login_fail_bursts(_logins(spark), within="2 seconds", min_fails=2).collect())
    assert got == [(1035, 842, 3), (1035, 843, 2), (1036, 842, 2)]


def _python_episodes(rows, w_us, n_min):
    """Plain fold of the chosen rule, per user in (time, seq) order."""
    out = []
    by_user = {}
    for r in rows:
        by_user.setdefault(r.user_id, []).append(r)
    for u, rs in by_user.items():
        rs.sort(key=lambda r: (r.us, r.seq))
        ep = None
        for r in rs:
            if ep and r.us > ep[0] + w_us:
                if ep[2] >= n_min:
                    out.append((u, ep[0], ep[3], ep[1], ep[2]))
                ep = None
            if r.event_type == "fail":
                ep = (r.us, r.seq, 1, r.us) if ep is None else (ep[0], ep[1], ep[2] + 1, r.us)
            else:
                ep = None
        if ep and ep[2] >= n_min:
            out.append((u, ep[0], ep[3], ep[1], ep[2]))
    return sorted(out)


def test_login_episodes_match_plain_fold_with_small_blocks(spark):
    logins = tables.logins(tables.events(spark, SF01))
    rows = logins.select("user_id", "event_type", "seq", F.unix_micros("event_time").alias("us")).collect()
    expected = _python_episodes(rows, 6 * 3600 * 10**6, 2)
    for block in ("1 day", "2 hours"):  # runs crossing many block boundaries
        got = sorted((r.user_id, r.first_fail_time, r.last_fail_time, r.first_seq, r.fail_count) for r in
                     login_fail_episodes(logins, within="6 hours", min_fails=2, block=block).collect())
        assert got == [(u, t0 // 10**6, tl // 10**6, s0, n) for u, t0, tl, s0, n in expected]
        assert len(got) == 122


def test_login_bursts_blocks_do_not_change_result(spark):
    logins = tables.logins(tables.events(spark, SF01))
    base = sorted(tuple(r) for r in login_fail_bursts(logins, within="6 hours").collect())
    for block in ("6 hours", "13 hours", "3 days"):
        assert sorted(tuple(r) for r in login_fail_bursts(logins, within="6 hours", block=block).collect()) == base
    assert len(base) == 158


def _synthetic_logins(spark, rows):
    """rows: (user, seconds as float, type, seq) -> LoginEvent-shaped frame."""
    import pandas as pd

    pdf = pd.DataFrame(rows, columns=["user_id", "t", "event_type", "seq"])
    pdf["event_time"] = pd.to_datetime((pdf["t"] * 1e6).round().astype("int64"), unit="us")
    return spark.createDataFrame(pdf[["user_id", "event_type", "event_time", "seq"]])


def _check_against_fold(spark, rows, within_s, n_min, run_block):
    df = _synthetic_logins(spark, rows)
    plain = df.select("user_id", "event_type", "seq", F.unix_micros("event_time").alias("us")).collect()
    expected = _python_episodes(plain, int(within_s * 1e6), n_min)
    got = sorted((r.user_id, r.first_fail_time, r.last_fail_time, r.first_seq, r.fail_count) for r in
                 login_fail_episodes(df, within=f"{int(within_s * 1000)} milliseconds", min_fails=n_min,
                                     block="1 hour", run_block=run_block).collect())
    assert got == [(u, t0 // 10**6, tl // 10**6, s0, n) for u, t0, tl, s0, n in expected]
    return got


def test_long_runs_split_into_blocks_periodic(spark):
    """Fails every 1.5 s with W = 2 s: one run for minutes, chains from different entries never merge."""
    rows = [(1, 1000 + 1.5 * i, "fail", i) for i in range(400)]
    rows += [(1, 1000 + 1.5 * 400 + 0.5, "success", 400)]  # trailing success cancels the last episode
    rows += [(2, 5000 + 0.7 * i, "fail", 1000 + i) for i in range(300)]
    got = _check_against_fold(spark, rows, 2, 2, "5 seconds")
    assert len(got) > 200


def test_long_runs_split_into_blocks_random(spark):
    import random

    for seed in range(3):
        rnd = random.Random(seed)
        rows, t, seq = [], 0.0, 0
        for _ in range(1500):
            t += rnd.choice([0.0, 0.2, 0.9, 1.3, 2.0, 2.0, 3.5])  # ties, exact-W gaps, breaks
            kind = "success" if rnd.random() < 0.03 else "fail"
            rows.append((rnd.choice([7, 8]), 10_000 + t, kind, seq))
            seq += 1
        _check_against_fold(spark, rows, 2, 2, "4100 milliseconds")
        _check_against_fold(spark, rows, 2, 3, "1 minute")
