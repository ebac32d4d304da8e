import pytest

from rivulet.sources import kafka_available, read_kafka, read_lines, write_kafka
from conftest import fixture_path


def test_read_lines_batch(spark):
    assert read_lines(spark, fixture_path("logins.csv")).count() == 51


def test_kafka_is_gated(spark):
    if kafka_available(spark):
        pytest.skip("connector present")
    with pytest.raises(RuntimeError):
        read_kafka(spark, "localhost:9092", "hotItems")
    with pytest.raises(RuntimeError):
        write_kafka(read_lines(spark, fixture_path("logins.csv")), "localhost:9092", "hotItems")


def test_read_lines_stream(spark, scratch):
    import os
    import shutil

    src = os.path.join(scratch, "in")
    os.makedirs(src)
    shutil.copy(fixture_path("logins.csv"), os.path.join(src, "a.csv"))
    stream = read_lines(spark, src, streaming=True, max_files_per_trigger=1)
    assert stream.isStreaming and stream.columns == ["value"]
    q = (stream.writeStream.format("memory").queryName("t_lines")
         .option("checkpointLocation", os.path.join(scratch, "ckpt")).start())
    q.processAllAvailable()
    q.stop()
    assert spark.table("t_lines").count() == 51


def test_events_with_nulls_are_parsed_or_counted_as_rejects(spark, scratch):
    import duckdb

    from rivulet.plans.catalog import QUERIES
    from rivulet.plans.oracle import ORACLE_SQL

    rows = [(1, "2024-01-01 00:00:07", 70000, "view", '{"k": 3}'), (2, "2024-01-01 00:01:00", None, "view", '{"k": 3}'),
            (3, "2024-01-01 00:02:00", 7, None, '{"k": 3}'), (4, "2024-01-01 00:03:00", 7, "error", "{}"),
            (5, None, 7, "click", '{"k": 1}'), (6, "2024-01-01 00:04:00", 8, "click", None)]
    ev = spark.createDataFrame(rows, "event_id long, t string, user_id long, event_type string, props string")
    ev.selectExpr("event_id", "cast(t AS timestamp_ntz) AS ts", "user_id", "event_type", "1.0D AS value", "props").coalesce(1).write.parquet(
        f"{scratch}/events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{scratch}/events.parquet/*.parquet')")
    got = {r.parser: (r.n_lines, r.n_rejects) for r in QUERIES["parse_rejects"](spark, scratch).collect()}
    assert got == {"access_log": (6, 1), "ad_clicks": (6, 3), "logins": (6, 2), "user_behavior": (6, 4)}
    assert got == {p: (n, bad) for p, n, bad in con.execute(ORACLE_SQL["parse_rejects"]).fetchall()}
    for name in ("access_log", "ad_clicks", "logins", "user_behavior"):
        n, bad = got[name]
        assert QUERIES[f"parse_{name}"](spark, scratch).count() == n - bad
    log = {r.url: r.user_id for r in QUERIES["parse_access_log"](spark, scratch).where("url = '/view/3' and user_id = ''").collect()}
    assert log == {"/view/3": ""}  # the view without a user still counts for its page
