"""Bucketed tables plan without shuffles; questions about the newest day open one folder."""

import random
from datetime import timedelta

import pytest

from marketmill import schemas as S
from marketmill.operators import indicators as I
from marketmill.operators import industry as G
from marketmill.operators import quality as Q
from marketmill.plans import marts
from marketmill.session import scratch_path
from marketmill.sources import tables

from tests.test_marts import D0, frame, quote


def plan(df):
    """What ran, with adaptive execution settled."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucketed_tables_need_no_exchange(spark, no_broadcast):
    rng = random.Random(4)
    quotes = frame(spark, [quote(f"s{k}", d, round(rng.uniform(1, 9), 2)) for k in range(30) for d in range(25)])
    universe = spark.createDataFrame([(f"s{k}", "01", "TWSE") for k in range(30)], "stock_id string, industry_code string, market string")
    root = scratch_path(spark, "tables")
    layer = f"layer_{root[-8:]}"
    bars = tables.publish(quotes, layer, "quotes", root, buckets=4, sort=("trade_date",))
    listed = tables.publish(universe, layer, "universe", root, buckets=4)
    assert bars.count() == 750 and sorted(bars.collect()) == sorted(quotes.select(*bars.columns).collect())
    fact = I.stock_fact(bars)
    for df in (fact, G.join_universe(bars, listed), Q.repeated_keys(bars, "stock_id", "trade_date")):
        assert "Exchange" not in plan(df)
    assert "Exchange" in plan(I.stock_fact(quotes))
    assert sorted(map(str, fact.collect())) == sorted(map(str, I.stock_fact(quotes).collect()))
    # Publishing again replaces the table.
    more = tables.publish(quotes.where("stock_id < 's2'"), layer, "quotes", root, buckets=4)
    assert more.count() < 750 and spark.table(f"{layer}.quotes").count() == more.count()


def test_newest_days_are_noted_by_refreshes(spark):
    universe = spark.createDataFrame([("a", "c", "s", "01", D0, "TWSE"), ("b", "c", "s", "02", D0, "TPEx")], S.UNIVERSE)
    seed = spark.createDataFrame([("01", "one"), ("02", "two")], "industry_code string, industry_name string")
    mood = spark.createDataFrame([(D0, 50.0, "neutral")], "index_date date, fear_greed_score double, fear_greed_rating string")
    root = scratch_path(spark, "marts")
    assert marts.latest_day(spark, root, "TWSE") is None
    last = {}
    for end in (5, 9, 12):
        # The second market stops trading after the sixth day.
        rows = [quote("a", d, 10.0 + d) for d in range(end + 1)] + [quote("b", d, 20.0 + d, market="TPEx") for d in range(min(end, 6) + 1)]
        marts.refresh_marts(spark, frame(spark, rows), universe, seed, mood, root)
        last = {"TWSE": D0 + timedelta(days=end), "TPEx": D0 + timedelta(days=min(end, 6))}
        assert {m: marts.latest_day(spark, root, m) for m in last} == last
    for market, day in last.items():
        rows = marts.latest_industries(spark, root, market)
        assert [(r.trade_date, r.market) for r in rows.collect()] == [(day, market)]
        assert "PartitionFilters: [isnotnull(trade_date" in rows._jdf.queryExecution().executedPlan().toString()
    assert marts.latest_industries(spark, root, "none").isEmpty()
