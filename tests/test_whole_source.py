"""Queries that read all of their source."""

from pyspark.sql import functions as F

from checks import projection as P
from checks.catalog import QUERIES, _stored_history
from checks.oracle import statements

SF = "/root/testdata/sf0.001"
STORED = ("industry_vs_sentiment", "scalar_latest_filter", "industry_ranking_latest", "best_worst_industry", "stock_info", "job_quality_gates", "job_dashboard_overview")


def test_stored_marts_hold_every_day_of_lineitem(spark):
    bars, fact = P.bars(spark, SF), _stored_history(spark, SF).stock_fact
    assert fact.count() == bars.count()
    days = lambda df: df.agg(F.count_distinct("trade_date")).first()[0]
    assert days(fact) == days(bars) > 1000


def test_questions_of_stored_marts_are_asked_over_lineitem():
    sql = statements()
    for name in STORED:
        assert f"{name}_all_days" in QUERIES
        assert "lineitem" in sql[f"{name}_all_days"]


def test_history_scans_read_both_exchanges(spark):
    def days(name):
        return {r.dt for r in QUERIES[name](spark, SF).select("dt").distinct().collect()}

    assert len(days("scan_quotes_history_b")) > 20
    assert days("scan_quotes_history_b") == days("scan_quotes_history")
