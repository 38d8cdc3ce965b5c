"""Queries over raw texts keep no copy of them, whatever the size of the table."""

import os
from datetime import datetime

import pytest

from checks import projection as P
from checks.catalog import QUERIES

COLUMNS = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
DAY = datetime(1998, 7, 1)
ROWS = [
    (1, 5, 2, 1, 3.0, 1234.5, 0.05, 0.02, "A", "O", DAY),
    (17, 5, 3, 2, 3.0, 1234.5, 0.05, 0.0, "R", "O", DAY),  # prices are placeholders
    (13, 5, 4, 3, 3.0, 1234.5, 0.05, 0.02, "N", "O", DAY),  # numbers end in a blank
    (23, 5, 5, 1, 3.0, 10.0, 0.05, 0.02, "N", "F", DAY),  # a payload without data
    (2, 5, 6, 6, 3.0, 10.0, 0.05, 0.02, "A", "O", DAY),  # a second row, cut off
    (None, None, 8, None, None, None, None, None, None, None, DAY),
    (3, None, None, 1, 3.0, 10.0, None, None, None, None, None),
]


@pytest.fixture(params=[0, P.SMALL], ids=["large", "small"])
def folder(request, spark, tmp_path, monkeypatch):
    monkeypatch.setattr(P, "SMALL", request.param)
    spark.createDataFrame(ROWS, COLUMNS).coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(k, 1.0) for k in range(2, 7)], "s_suppkey long, s_acctbal double").write.parquet(str(tmp_path / "supplier.parquet"))
    return request.param, str(tmp_path)


def answer(spark, name, folder):
    """The rows of a query that wrote nothing and, over a large table, moved no raw text."""
    small, sf = folder
    root = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    found = QUERIES[name](spark, sf)
    rows = found.collect()
    assert (set(os.listdir(root)) if os.path.isdir(root) else set()) == before
    if not small and name in ("explode_flatten", "clean_quotes_b", "unify_b"):
        assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    return rows


def test_explode_flatten(spark, folder):
    rows = answer(spark, "explode_flatten", folder)
    got = {}
    for r in rows:
        got.setdefault(r.stock_id, []).append((r.open_price, r.trade_volume, r.pe_ratio))
    assert got["2"] == [("1,234.50", "3,000", "20.00")]
    assert got["3"] == [("---", "---", "-")]
    assert got["4"] == [("1,234.50 ", "3,000 ", "20.00")]
    assert "5" not in got
    assert got["6"] == [("10.00", "3,000", "20.00"), ("10.00", "3,000", None)]
    assert got["8"] == [(None, None, None)]
    assert len(rows) == 7


def test_clean_quotes_b(spark, folder):
    rows = {r.stock_id: r for r in answer(spark, "clean_quotes_b", folder)}
    assert len(rows) == len(ROWS)
    assert (rows["2"].close_price, rows["2"].open_price, rows["2"].issued_shares, rows["2"].change_amount) == (1235.5, 1234.5, 5000, 5.0)
    assert (rows["3"].close_price, rows["3"].trade_volume, rows["3"].high_price, rows["3"].change_amount) == (None, None, 1239.5, -5.0)
    assert (rows["4"].close_price, rows["4"].trade_volume) == (1235.5, 3000)
    assert (rows["8"].close_price, rows["8"].trade_volume, rows["8"].dt) == (None, None, "1998-07-01")


def test_unify_b(spark, folder):
    rows = {r.stock_id: r for r in answer(spark, "unify_b", folder)}
    assert len(rows) == len(ROWS) and {r.market for r in rows.values()} == {"TPEx"}
    assert (rows["2"].close_price, rows["2"].average_price, rows["2"].pe_ratio) == (1235.5, 1236.5, None)


def test_count_by_market(spark, folder):
    assert {tuple(r) for r in answer(spark, "count_by_market", folder)} == {("TWSE", len(ROWS)), ("TPEx", len(ROWS))}


def test_merge_markets(spark, folder):
    rows = {r.stock_id: r.market for r in answer(spark, "merge_markets", folder)}
    assert rows == {"2": "TWSE", "3": "TPEx", "4": "TWSE", "5": "TPEx", "6": "TWSE"}


def test_merge_three_sources(spark, folder):
    rows = answer(spark, "merge_three_sources", folder)
    known = [r for r in rows if r.stock_id == "2"]
    # From exchange A's text, and from the history, whose prices are a third.
    assert sorted(r.open_price for r in known) == [411.5, 1234.5]
