"""Physical-plan properties the design relies on (checked on the executed plans)."""

from conftest import SF001

from rivulet.plans import catalog


def _plan(df, final=False) -> str:
    qe = df._jdf.queryExecution()
    if final:
        qe.toRdd().count()  # run it, so the adaptive plan is final
    text = qe.executedPlan().toString()
    if final and "== Final Plan ==" in text:  # keep the final section only
        text = text.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    return text


def test_filters_and_pruning_reach_the_scan(spark):
    plan = _plan(catalog.q_page_views(spark, SF001))
    assert "In(event_type, [pv,view])" in plan and "PushedFilters" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in plan
    plan = _plan(catalog.q_marketing_total(spark, SF001))
    assert "Not(EqualTo(event_type,signup))" in plan


def test_top_n_and_cap_limit_before_the_shuffle(spark):
    for q in (catalog.q_hot_items, catalog.q_ad_clicks_capped, catalog.q_ad_blacklist):
        plan = _plan(q(spark, SF001))
        assert "WindowGroupLimit" in plan and "Partial" in plan, q.__name__


def test_wide_sliding_windows_do_not_expand_rows(spark):
    plan = _plan(catalog.q_marketing_by_channel(spark, SF001), final=True)
    assert "Expand" not in plan
    assert "ReusedExchange" in plan  # the deltas shuffle feeds both the block totals and the rows
    assert plan.count("FileScan parquet") == 1


def test_running_distinct_sums_inside_parts(spark):
    plan = _plan(catalog.q_unique_visitors_running(spark, SF001), final=True)
    assert plan.count("FileScan parquet") == 2  # of the written parts: rows, and sums of parts
    assert "hashpartitioning(_win" in plan and "_part" in plan

def test_parse_is_not_pushed_into_the_scan(spark):
    plan = _plan(catalog.q_parse_access_log(spark, SF001))
    assert "DataFilters: []" in plan
    assert "Generate inline" in plan


def test_no_unchecked_broadcast(spark):
    """No query asks for a broadcast; AQE may still pick one from runtime sizes (its own size check)."""
    for name, q in catalog.QUERIES.items():
        logical = q(spark, SF001)._jdf.queryExecution().analyzed().toString()
        assert "broadcast" not in logical.lower(), name


def test_login_episodes_scan_once(spark):
    plan = _plan(catalog.q_login_fail_warnings(spark, SF001), final=True)
    assert "events.parquet" not in plan  # read once, for the written runs that both passes share
