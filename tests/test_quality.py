import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks import catalog
from marketmill.operators import articles as N
from marketmill.operators import quality as Q
from marketmill.operators import runlog as L

SF = "/root/testdata/sf0.001"


def by_attempts(attempts, confirm_empty):
    """The verdict as a loop over the attempts of one day."""
    empties = 0
    for _, http_ok, retryable, stat, tables, rows in sorted(attempts):
        if not http_ok:
            if retryable:
                continue
            return "unknown_failure"
        if stat != "OK":
            if not confirm_empty:
                return "unknown_failure"
            empties += 1
            if empties == 2:
                return "no_data"
            continue
        return "success" if tables > 8 and rows >= 1105 else "unknown_failure"
    return "unknown_failure"


@pytest.mark.parametrize("confirm_empty", [True, False])
def test_landing_status_matches_the_loop(spark, confirm_empty):
    rng = random.Random(1)
    days = {
        f"d{i}": [(a, rng.random() < 0.8, rng.random() < 0.5, rng.choice(["OK", "none", None]), rng.choice([8, 9]), rng.choice([1104, 1105])) for a in (1, 2, 3, 4, 5) if rng.random() < 0.6]
        for i in range(300)
    }
    rows = [(d, *a) for d, attempts in days.items() for a in attempts]
    got = Q.landing_status(spark.createDataFrame(rows, "dt string, attempt int, http_ok boolean, retryable boolean, stat string, n_tables int, n_rows int"), confirm_empty)
    assert {r.dt: r.status for r in got.collect()} == {d: by_attempts([x for x in a if x[0] <= 3], confirm_empty) for d, a in days.items() if a}


def test_rules(spark):
    rows = spark.createDataFrame(
        [("TWSE", 1, 10.0, 9.0, 9.5, 9.5), ("TPEx", None, 5.0, 9.0, 9.5, 9.5), ("TPEx", 1, 5.0, 9.0, 9.5, 9.5), ("X", 1, None, None, None, None)],
        "market string, trade_value bigint, high_price double, low_price double, open_price double, close_price double",
    )
    assert Q.failing(rows, Q.high_not_highest()).count() == 1
    assert Q.failing(rows, Q.low_not_lowest()).count() == 1
    assert Q.failing(rows, Q.not_accepted("market", ["TWSE", "TPEx"])).count() == 1
    assert Q.failing(rows, Q.is_missing("trade_value")).count() == 1
    assert Q.failing(rows, Q.out_of_range("high_price", 0, 10)).count() == 0
    assert Q.failing(rows, Q.out_of_range("high_price", 0, 10, inclusive=False)).count() == 1
    assert Q.failing(rows, Q.out_of_range("high_price", 6, where=F.col("trade_value").isNotNull())).count() == 1
    verdict = Q.verdicts("t", rows, [Q.Rule("r", "market", Q.is_missing("market")), Q.Rule("v", "trade_value", Q.is_missing("trade_value"))])
    assert [(r.rule, r.failing_rows, r.passed) for r in verdict.collect()] == [("r", 0, True), ("v", 1, False)]
    keys = spark.createDataFrame([("a",), ("a",), (None,), (None,)], "k string")
    assert [tuple(r) for r in Q.repeated_keys(keys, "k").collect()] == [("a", 2)]
    assert Q.duplicate_rows(keys, "k").count() == 2


def test_landing_status_of_single_answers(spark):
    answers = spark.createDataFrame([(False, 3), (True, 0), (True, 1)], "http_ok boolean, n_tables int")
    assert [r.status for r in Q.landing_status_of_answer(answers).collect()] == ["unknown_failure", "no_data", "success"]


def test_freshness_bounds(spark):
    loads = spark.createDataFrame([("a", datetime(2026, 1, 1)), ("b", datetime(2026, 1, 1, 18)), ("c", datetime(2026, 1, 2)), ("a", datetime(2025, 1, 1))], "source string, loaded_at timestamp_ntz")
    got = {r.source: (r.age_hours, r.state) for r in Q.freshness(loads, datetime(2026, 1, 3, 1)).collect()}
    assert got == {"a": (49.0, "error"), "b": (31.0, "warn"), "c": (25.0, "pass")}
    unknown = loads.unionByName(spark.createDataFrame([("e", None)], "source string, loaded_at timestamp_ntz"))
    states = {r.source: r.state for r in Q.freshness(unknown, datetime(2026, 1, 3, 1), ["a", "d"]).collect()}
    assert states == {"a": "error", "b": "warn", "c": "pass", "d": "error", "e": "error"}


def test_contracts(spark):
    payloads = spark.createDataFrame([(["a", "b"],), (["b", "a"],), (["a", "c"],), (None,)], "fields array<string>")
    got = Q.field_contract(payloads, ["a", "b"]).collect()
    assert [(r.fields_match, r.missing_fields, r.extra_fields) for r in got] == [(True, "", ""), (False, "", ""), (False, "b", "c"), (False, "a,b", "")]
    bodies = spark.createDataFrame([('{"k": {"a": null, "b": 1}}',), ('{"k": {"a": 1}}',), ('{"x": 1}',), ("oops",), (None,)], "body string")
    got = Q.payload_contract(bodies, "body", "k", ["a", "b"]).collect()
    assert [(r.has_block, r.missing_keys, r.contract_ok) for r in got] == [(True, "", True), (True, "b", False), (False, "a,b", False), (False, "a,b", False), (False, "a,b", False)]


def test_run_log(spark):
    runs = spark.createDataFrame(
        [(datetime(2026, 1, 1), "d", "t", "success", datetime(2026, 1, 1, 0, 0), datetime(2026, 1, 1, 0, 1)), (datetime(2026, 1, 1), "d", "t", "failed", None, None)],
        "run_timestamp timestamp_ntz, dag_id string, task_id string, status string, start_time timestamp_ntz, end_time timestamp_ntz",
    ).select("*", F.lit(None).cast("date").alias("target_date"), F.lit(None).cast("bigint").alias("row_count"))
    log = L.run_rows(runs)
    assert [r.duration_seconds for r in log.collect()] == [60.0, None]
    summary = L.success_summary(log, datetime(2026, 1, 31))
    assert [tuple(r) for r in summary.collect()] == [("d", "t", 2, 1, 50.0, 60.0)]
    assert L.success_summary(log, datetime(2026, 2, 1)).isEmpty()


def test_first_article_per_id_prefers_the_earlier_source(spark):
    ddl = "article_id string, position int, title string"
    one = spark.createDataFrame([("a", 2, "late"), ("a", 1, "early")], ddl)
    two = spark.createDataFrame([("a", 0, "other"), ("b", 0, "new")], ddl)
    assert sorted((r.article_id, r.title) for r in N.first_per_id(one, two).collect()) == [("a", "early"), ("b", "new")]


# -- plans -------------------------------------------------------------------

def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["fact_stock_daily", "market_obt", "missing_anti", "clean_gap_scan", "completeness_b", "sentiment_asof", "industry_return_pct", "job_articles", "job_quality_gates", "job_dashboard_overview"])
def test_no_nested_loops_and_no_python(spark, name):
    plan = plan_of(catalog.QUERIES[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert bad not in plan


def test_completeness_of_all_ids_joins_by_market(spark):
    plan = plan_of(catalog.QUERIES["completeness_a"](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_indicators_share_one_exchange(spark):
    plan = plan_of(catalog.QUERIES["fact_stock_daily"](spark, SF))
    assert plan.count("Exchange hashpartitioning(stock_id") == 1
    assert plan.count("Sort [stock_id") == 1


def test_dashboards_read_stored_marts(spark):
    for name in ("stock_info", "industry_ranking_latest", "job_dashboard_overview"):
        plan = plan_of(catalog.QUERIES[name](spark, SF))
        assert "events.parquet" not in plan and "lineitem.parquet" not in plan
    assert "PartitionFilters: [isnotnull(trade_date" in plan_of(catalog.QUERIES["scalar_latest_filter"](spark, SF))


def test_a_date_filter_prunes_folders_of_the_clean_lake(spark):
    recent = catalog._lake_quotes(spark, SF).where(F.col("trade_date") >= F.lit("1998-07-10").cast("date"))
    pruned = re.search(r"PartitionFilters: \[([^\]]*)\]", plan_of(recent)).group(1)
    assert "dt" in pruned and "1998-07-10" in pruned


def test_market_filter_reaches_the_scan(spark):
    plan = plan_of(catalog.QUERIES["scan_clean_partitioned"](spark, SF))
    assert "EqualTo(market,TWSE)" in plan


@pytest.mark.parametrize("name", ["sentiment_dedup_day", "article_dedup", "landing_status", "dq_unique", "completeness_a", "industry_daily_price", "unparseable_scan", "job_quality_gates"])
def test_groups_combine_before_the_shuffle(spark, name):
    """A key with a third of all rows reaches the reducers as partial results."""
    assert "partial_" in plan_of(catalog.QUERIES[name](spark, SF))
