from conftest import fixture_path

from rivulet.sources import parse_ad_clicks, parse_apache_log, parse_logins, parse_user_behavior


def _lines(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def test_fixture_files_parse_fully(spark):
    ads = parse_ad_clicks(spark.read.text(fixture_path("ad_clicks.csv")))
    logins = parse_logins(spark.read.text(fixture_path("logins.csv")))
    assert ads.rows.count() == 143 and ads.rejects.count() == 0
    assert logins.rows.count() == 51 and logins.rejects.count() == 0
    fails = logins.rows.where("event_type = 'fail'").count()
    assert (fails, 51 - fails) == (11, 40)


def test_bad_lines_are_quarantined(spark):
    lines = ["543462, 1715, 2, pv , 1511658000", "1,2,3,pv", "x,2,3,pv,1511658000", "1,2,3,pv,1511658000,extra"]
    p = parse_user_behavior(_lines(spark, lines))
    rows = p.rows.orderBy("user_id").collect()
    assert [(r.user_id, r.item_id, r.category_id, r.behavior, r.ts) for r in rows] == [
        (1, 2, 3, "pv", 1511658000), (543462, 1715, 2, "pv", 1511658000)]
    assert sorted(r.value for r in p.rejects.collect()) == ["1,2,3,pv", "x,2,3,pv,1511658000"]
    assert all(r.event_time is not None and r.seq is not None for r in p.rows.collect())


def test_apache_log(spark):
    lines = ["83.149.9.216 - - 17/05/2015:10:05:03 +0000 GET /presentations/logstash",
             "83.149.9.216 - - 32/05/2015:10:05:03 +0000 GET /bad-date",
             "short line"]
    p = parse_apache_log(_lines(spark, lines))
    rows = p.rows.collect()
    assert len(rows) == 1 and rows[0].url == "/presentations/logstash" and rows[0].method == "GET"
    assert str(rows[0].event_time) == "2015-05-17 10:05:03"
    assert p.rejects.count() == 2


def test_marketing_lines_use_epoch_millis(spark):
    from rivulet.sources import parse_marketing

    p = parse_marketing(_lines(spark, ["u-1, CLICK, wechat, 1511658000123", "u-2,INSTALL,weibo,notatime"]))
    rows = p.rows.collect()
    assert [(r.user_id, r.behavior, r.channel, r.ts) for r in rows] == [("u-1", "CLICK", "wechat", 1511658000123)]
    assert str(rows[0].event_time) == "2017-11-26 01:00:00.123000"
    assert p.rejects.count() == 1
