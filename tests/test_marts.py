"""Indicators, industry prices, coverage and incremental refresh against plain-Python brute force."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marketmill import schemas as S
from marketmill.operators import backlog as B
from marketmill.operators import calendar as C
from marketmill.operators import coverage as V
from marketmill.operators import indicators as I
from marketmill.operators import industry as G
from marketmill.operators import sentiment as M
from marketmill.plans import incremental as R
from marketmill.plans import marts, state
from marketmill.session import scratch_path
from marketmill.sources import sinks

D0 = date(2026, 1, 1)
TYPES = {"trade_date": "date", "stock_id": "string", "market": "string", "trade_volume": "bigint", "trade_value": "bigint", "transaction_count": "bigint"}
QUOTE_DDL = ", ".join(f"{c} {TYPES.get(c, 'double')}" for c in I.FACT_COLUMNS)


def quote(stock, day, close, value=100, volume=10, market="TWSE"):
    known = {"trade_date": D0 + timedelta(days=day), "stock_id": stock, "market": market, "close_price": close, "trade_value": value, "trade_volume": volume}
    return tuple(known.get(c) for c in I.FACT_COLUMNS)


def frame(spark, rows):
    return spark.createDataFrame(rows, QUOTE_DDL)


def brute_fact(closes):
    """(ma5, ma20, rsi14) per position of one instrument's closes."""
    out, gains, losses = [], [], []
    for i, close in enumerate(closes):
        before = closes[i - 1] if i else None
        change = close - before if close is not None and before is not None else 0.0
        gains.append(max(change, 0.0))
        losses.append(max(-change, 0.0))
        def mean(xs):
            xs = [x for x in xs if x is not None]
            return sum(xs) / len(xs) if xs else None
        g, l = mean(gains[max(0, i - 13): i + 1]), mean(losses[max(0, i - 13): i + 1])
        out.append((mean(closes[max(0, i - 4): i + 1]), mean(closes[max(0, i - 19): i + 1]), 100.0 if l == 0 else 100 - 100 / (1 + g / l)))
    return out


def test_stock_fact_matches_brute_force(spark):
    rng = random.Random(3)
    series = {s: [None if rng.random() < 0.1 else round(rng.uniform(10, 20), 2) for _ in range(45)] for s in ("a", "b")}
    series["flat"], series["one"] = [5.0] * 3, [7.0]
    rows = [quote(s, i, c) for s, closes in series.items() for i, c in enumerate(closes)]
    rng.shuffle(rows)
    got = {(r.stock_id, (r.trade_date - D0).days): r for r in I.stock_fact(frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    for s, closes in series.items():
        for i, expected in enumerate(brute_fact(closes)):
            r = got[s, i]
            assert (r.ma5, r.ma20, r.rsi14) == tuple(None if e is None else pytest.approx(e, abs=1e-9) for e in expected)


def test_series_follows_an_instrument_across_markets(spark):
    rows = [quote("a", 0, 10.0, market="TPEx"), quote("a", 1, 20.0)]
    got = I.stock_fact(frame(spark, rows)).orderBy("trade_date").collect()
    assert [r.ma5 for r in got] == [10.0, 15.0]


def test_industry_price_and_guarded_return(spark):
    universe = spark.createDataFrame([("a", "01"), ("b", "01")], "stock_id string, industry_code string")
    rows = [
        quote("a", 0, 10.0, value=None, volume=1), quote("b", 0, 20.0, value=None, volume=3),
        quote("a", 1, 10.0, value=None, volume=1),
        quote("a", 2, 12.0, value=5), quote("b", 2, 12.0, value=None, volume=5),
        quote("a", 3, 12.0, value=5), quote("a", 4, 15.0, value=5),
        quote("a", 5, 15.0, value=0), quote("x", 5, 15.0), quote("b", 5, None),
    ]
    daily = G.industry_daily(frame(spark, rows), universe)
    got = G.with_daily_return(daily).orderBy("trade_date").collect()
    assert [((r.trade_date - D0).days, r.weighted_avg_price, r.stock_count, r.weighting_method, r.daily_return_pct) for r in got] == [
        (0, 17.5, 2, "trade_volume", None), (1, 10.0, 1, "trade_volume", -42.86), (2, 12.0, 2, "mixed", None),
        (3, 12.0, 1, "trade_value", None), (4, 15.0, 1, "trade_value", 25.0),
    ]


def listed(spark, rows):
    return spark.createDataFrame(rows, "market string, stock_id string, company_name string, listing_date date")


def random_market(rng):
    universe = [(m, f"{m[1]}{i}", f"n{i}", None if i == 3 else D0 + timedelta(days=rng.randrange(-5, 15))) for m in S.MARKETS for i in range(12)]
    quotes = {(m, s, D0 + timedelta(days=d)) for m, s, _, _ in universe for d in range(20) if d % 7 < 5 and rng.random() < 0.6}
    quotes |= {("TWSE", "noise", D0 + timedelta(days=2)), ("TWSE", "P1", D0 + timedelta(days=3))}
    return universe, quotes


def test_coverage_matches_brute_force(spark):
    universe, quotes = random_market(random.Random(11))
    q = spark.createDataFrame([(m, d, s) for m, s, d in quotes] * 2, "market string, dt date, stock_id string")
    u = listed(spark, universe)
    days = {(m, d) for m, _, d in quotes}
    listed_on = {(m, d): {s for um, s, _, ld in universe if um == m and ld and ld <= d} for m, d in days}
    present = {(m, d): {s for qm, s, qd in quotes if (qm, qd) == (m, d)} for m, d in days}

    assert {(r.market, r.dt): r.expected_count for r in V.listed_as_of(q, u).collect()} == {k: len(v) for k, v in listed_on.items()}
    missing = {(k[0], k[1], s) for k in days for s in listed_on[k] - present[k]}
    got = V.missing_instruments(q, u).collect()
    assert sorted((r.market, r.dt, r.stock_id) for r in got) == sorted(missing)
    gaps = V.clean_gap_scan(q, u, threshold=1).collect()
    assert {(r.market, r.dt, r.gap) for r in gaps} == {(*k, len(listed_on[k]) - len(present[k])) for k in days if len(listed_on[k]) - len(present[k]) > 1}
    assert [r.gap for r in gaps] == sorted((r.gap for r in gaps), reverse=True)
    scan = V.raw_gap_scan(q, u, min_missing=3).collect()
    assert {(r.market, r.dt): (r.actual_count, r.missing_count) for r in scan} == {k: (len(present[k]), len(listed_on[k] - present[k])) for k in days if len(listed_on[k] - present[k]) >= 3}
    order = {m: sorted(d for dm, d in days if dm == m) for m, _ in days}
    spans = V.absence_intervals(q, u).collect()
    inside = [(r.market, d, r.stock_id) for r in spans for d in order[r.market] if r.first_day <= d <= r.last_day]
    assert sorted(inside) == sorted(missing) and sum(r.days_absent for r in spans) == len(missing)
    asked = [k for k in sorted(days)][::3] + [("TWSE", D0 - timedelta(days=900))]
    some = V.missing_on(q, u, spark.createDataFrame(asked * 2, "market string, dt date")).collect()
    assert sorted((r.market, r.dt, r.stock_id) for r in some) == sorted(x for x in missing if x[:2] in asked)


@pytest.mark.parametrize("official_only", [False, True])
def test_completeness(spark, official_only):
    official = spark.createDataFrame([("TWSE", f"{i:02d}") for i in range(20)] * 2 + [("TPEx", "z")], "market string, stock_id string")
    rows = [(D0, f"{i:02d}") for i in range(19)] + [(D0 + timedelta(days=1), f"{i:02d}") for i in range(5)]
    rows += [(D0 + timedelta(days=1), f"noise{i}") for i in range(15)] + [(D0 + timedelta(days=2), "noise")]
    rows += [(D0 + timedelta(days=3), "other")]
    quotes = spark.createDataFrame([("TPEx" if s == "other" else "TWSE", d, s) for d, s in rows], "market string, dt date, stock_id string")
    requested = B.requested_days(spark, "2026-01-01", "2026-01-04")
    rows = V.completeness(requested, quotes, official, S.MARKET_A, official_only, start="2026-01-01", end="2026-01-04").collect()
    got = {(r.dt - D0).days: r for r in rows}
    gone = lambda day: sorted(r.missing_id for r in rows if (r.dt - D0).days == day and r.missing_id)
    assert got[0].passed and got[0].ratio == 0.95 and gone(0) == []
    assert got[1].passed is (not official_only) and got[1].present == (5 if official_only else 20)
    if official_only:
        assert gone(1) == [f"{i:02d}" for i in range(5, 20)]
    assert not got[2].passed and got[2].present == (0 if official_only else 1)
    assert got[3].passed and not got[3].landed


def test_sentiment_as_of_and_one_per_day(spark):
    hour = 3_600_000.0
    records = spark.createDataFrame([(0.0, 10.0, "fear"), (5 * hour, 20.004, "greed"), (50 * hour, 30.0, "fear")], "x double, y double, rating string")
    daily = M.one_per_day(records, "UTC")
    assert sorted(tuple(r) for r in daily.collect()) == [("1970-01-01", 20.0, "greed"), ("1970-01-03", 30.0, "fear")]
    targets = spark.createDataFrame([("1969-12-31",), ("1970-01-02",), ("1970-01-02",), ("1970-01-09",)], "dt string")
    assert sorted(tuple(r) for r in M.as_of(daily, targets).collect()) == [
        ("1969-12-31", None, None), ("1970-01-02", 20.0, "greed"), ("1970-01-09", 30.0, "fear"),
    ]
    assert [tuple(r) for r in M.on_day(records, "1970-01-02", "UTC").collect()] == [("1970-01-02", 20.0, "greed")]
    assert M.on_day(records, "1969-12-31", "UTC").isEmpty()


def test_range_presets():
    anchor = date(2026, 7, 9)
    assert [C.range_start(p, anchor) for p in C.RANGE_PRESETS] == [
        date(2026, 7, 8), date(2026, 7, 4), date(2026, 6, 9), date(2026, 1, 8), date(2026, 1, 1), date(2025, 7, 9), date(2021, 7, 10), date(2024, 7, 1),
    ]


def test_in_range(spark):
    quotes = frame(spark, [quote("a", d, 1.0) for d in range(40)])
    assert C.in_range(quotes, "5D", D0 + timedelta(days=39)).count() == 6
    assert C.in_range(quotes, "ALL", D0, history_start=D0 + timedelta(days=30)).count() == 10


def test_backlog(spark):
    days = lambda *ds: spark.createDataFrame([(D0 + timedelta(days=d),) for d in ds], "dt date")
    requested = B.requested_days(spark, "2026-01-01", "2026-01-05")
    assert sorted((r.dt - D0).days for r in B.backlog_days(requested, days(0, 0), days(1)).collect()) == [2, 3, 4]
    outcomes = {r.outcome: r.days for r in B.day_outcomes(requested, days(0, 0, 1), days(1, 2)).collect()}
    assert outcomes == {"skipped": 2, "no_trading": 1, "to_do": 2}


def history_rows():
    """A daily series, one with long holes, a sparse one and a late listing."""
    rng = random.Random(5)
    days = {"daily": range(200), "holes": [d for d in range(200) if d % 40 < 8], "sparse": range(0, 200, 23), "late": range(196, 200), "gone": range(50)}
    return [quote(s, d, round(rng.uniform(10, 99), 2)) for s, ds in days.items() for d in ds]


def test_incremental_stock_fact_equals_a_rebuild(spark):
    quotes, path = frame(spark, history_rows()), scratch_path(spark, "fact")
    for end in (150, 185, 199):
        R.refresh_stock_fact(spark, quotes.where(F.col("trade_date") <= F.lit(D0 + timedelta(days=end))), path, lookback_days=6)
    whole = I.stock_fact(quotes)
    key = lambda r: (r.stock_id, r.trade_date)
    built = sorted(spark.read.schema(whole.schema).parquet(path).select(*whole.columns).collect(), key=key)
    assert built == sorted(whole.collect(), key=key)


def test_carried_rows_are_those_before_the_start(spark):
    quotes, path = frame(spark, history_rows()), scratch_path(spark, "state")
    for day in (150, 190):
        start = D0 + timedelta(days=day)
        got = state.rows_from(quotes, start, ["stock_id"], 19, path).collect()
        before = {s: sorted((r.trade_date - D0).days for r in got if r.stock_id == s and r.trade_date < start) for s in ("daily", "holes", "sparse", "late", "gone")}
        assert before["daily"] == list(range(day - 19, day)) and before["gone"] == list(range(31, 50)) and before["late"] == []
        assert before["sparse"] == list(range(0, day, 23)) and before["holes"] == [d for d in range(day) if d % 40 < 8][-19:]
        assert sum(r.trade_date >= start for r in got) == quotes.where(F.col("trade_date") >= F.lit(start)).count()


def test_slots_keep_an_older_snapshot():
    """A year of daily refreshes with a late day, for which no snapshot is old enough: the others find one, and the oldest is never too old."""
    found: list[state.Snapshot] = []
    made, day = 0, 0
    for k in range(365):
        day = k
        start = D0 + timedelta(days=day if k != 200 else 150)
        base = max((s for s in state.valid(found) if s.as_of <= start), key=lambda s: (s.as_of, s.made), default=None)
        slot, made = state.next_slot(found, base, start), made + 1
        assert base is None or slot != base.slot
        found = [s for s in found if s.slot != slot] + [state.Snapshot(slot, start, made)]
        good = state.valid(found)
        assert len(found) <= state.SLOTS and good[-1].as_of == start
        if k > 5:
            assert base is not None or k == 200
            assert (start - good[0].as_of).days <= state.ANCHOR_DAYS + 1
    assert state.valid([state.Snapshot(0, D0 + timedelta(days=9), 1), state.Snapshot(1, D0, 2)]) == [state.Snapshot(1, D0, 2)]


def test_a_refresh_never_opens_old_days(spark):
    """The source loses its old day folders after the first build; refreshes still equal a rebuild of the whole."""
    import shutil

    quotes = frame(spark, history_rows() + [quote(None, d, 5.0 + d % 7) for d in range(0, 200, 3)])
    lake, path = scratch_path(spark, "lake"), scratch_path(spark, "fact")
    whole = I.stock_fact(quotes)
    key = lambda r: (r.stock_id or "", r.trade_date)
    digests = scratch_path(spark, "digests")
    for end, oldest in ((150, 0), (170, 144), (185, 164), (199, 179)):
        sinks.replace_partitions(quotes.where(F.col("trade_date") <= F.lit(D0 + timedelta(days=end))), lake, "trade_date")
        for day in range(oldest):
            shutil.rmtree(f"{lake}/trade_date={D0 + timedelta(days=day)}", ignore_errors=True)
        source = spark.read.schema(QUOTE_DDL).parquet(lake)
        state.note_digests(source, digests, ["stock_id", "trade_date"], 6)
        R.refresh_stock_fact(spark, source, path, lookback_days=6)
    built = spark.read.schema(whole.schema).parquet(path).select(*whole.columns).collect()
    assert sorted(built, key=key) == sorted(whole.collect(), key=key)
    noted = {r.trade_date: (r.n_rows, r.n_keys, r.n_repeated) for r in state.noted_digests(spark, digests).collect()}
    assert noted == {r.trade_date: (r.n_rows, r.n_keys, r.n_repeated) for r in state.key_digests(quotes, ["stock_id", "trade_date"]).collect()}


def test_late_days_go_back_to_an_older_snapshot_or_to_all_rows(spark):
    rows = [(s, d) for s in ("a", "b", None) for d in range(80)]
    late = {("a", 40), ("b", 12), (None, 41)}
    of = lambda keep: frame(spark, [quote(s, d, 10.0 + (d * 7) % 11 + len(s or "")) for s, d in rows if keep(s, d)])
    path = scratch_path(spark, "fact")
    for end, since, missing in ((50, None, late), (60, None, late), (70, None, late), (72, 40, {("b", 12)}), (75, None, {("b", 12)}), (79, 12, set())):
        source = of(lambda s, d: d <= end and (s, d) not in missing)
        R.refresh_stock_fact(spark, source, path, lookback_days=4, since=None if since is None else D0 + timedelta(days=since))
        whole = I.stock_fact(source)
        built = spark.read.schema(whole.schema).parquet(path).select(*whole.columns)
        assert sorted(map(str, built.collect())) == sorted(map(str, whole.collect()))


def test_digests_find_repeated_keys_of_the_days_that_are_read(spark):
    path, keys = scratch_path(spark, "digests"), ["stock_id", "trade_date"]
    first = [quote(s, d, 1.0) for s in ("a", "b", None) for d in range(40)]
    assert state.note_digests(frame(spark, first), path, keys, 5).where("n_repeated > 0").isEmpty()
    again = frame(spark, first + [quote("a", 41, 1.0), quote("a", 41, 2.0), quote("b", 3, 1.0)])
    assert [(r.trade_date - D0).days for r in state.note_digests(again, path, keys, 5).where("n_repeated > 0").collect()] == [41]
    assert sorted((r.trade_date - D0).days for r in state.note_digests(again, path, keys, 5, since=D0 + timedelta(days=3)).where("n_repeated > 0").collect()) == [3, 41]
    mended = state.note_digests(frame(spark, first), path, keys, 5, full=True)
    assert mended.count() == 40 and mended.where("n_repeated > 0 or n_rows <> n_keys").isEmpty()
    twice = frame(spark, [quote("a", 1, 1.0), quote("a", 1, 2.0)])
    universe = spark.createDataFrame([("a", "c", "s", "01", D0, "TWSE")], S.UNIVERSE)
    with pytest.raises(ValueError, match="quotes"):
        marts.refresh_marts(spark, twice, universe, None, None, scratch_path(spark, "marts"))


def test_incremental_industry_fact_equals_a_rebuild(spark):
    quotes = frame(spark, history_rows())
    universe = spark.createDataFrame([(s, "01" if s < "h" else "02") for s in ("daily", "holes", "sparse", "late", "gone")], "stock_id string, industry_code string")
    names = spark.createDataFrame([("01", "one")], "industry_code string, industry_name string")
    daily_path, fact_path = scratch_path(spark, "daily"), scratch_path(spark, "industry")
    whole_daily = G.industry_daily(quotes, universe)
    for end in (150, 185, 199):
        R.refresh_industry_daily(spark, quotes.where(F.col("trade_date") <= F.lit(D0 + timedelta(days=end))), universe, daily_path)
        R.refresh_industry_fact(spark, spark.read.schema(whole_daily.schema).parquet(daily_path), names, fact_path)
    whole = G.industry_fact(whole_daily, names)
    key = lambda r: (r.trade_date, r.industry_code, r.market)
    built = spark.read.schema(whole.schema).parquet(fact_path).select(*whole.columns)
    assert sorted(built.collect(), key=key) == sorted(whole.collect(), key=key)


def test_late_days_and_null_industries_equal_a_rebuild(spark):
    """A null industry keeps its history; a day before the lookback reaches the facts when it is named."""
    days = [(s, d) for s in ("a", "bb", "ccc") for d in range(60)]
    universe = spark.createDataFrame([("a", "01"), ("bb", None), ("ccc", None)], "stock_id string, industry_code string")
    names = spark.createDataFrame([("01", "one")], "industry_code string, industry_name string")
    rows = lambda keep: frame(spark, [quote(s, d, 99.0 if (s, d) == ("a", 20) else 10.0 + d + len(s)) for s, d in days if keep(s, d)])
    first, every = rows(lambda s, d: d < 57 and (s, d) != ("a", 20)), rows(lambda s, d: True)
    paths = [scratch_path(spark, n) for n in ("daily", "industry", "stock")]
    whole_daily = G.industry_daily(every, universe)
    for quotes, since in ((first, None), (every, D0 + timedelta(days=20))):
        R.refresh_industry_daily(spark, quotes, universe, paths[0], since=since)
        R.refresh_industry_fact(spark, spark.read.schema(whole_daily.schema).parquet(paths[0]), names, paths[1], since=since)
        R.refresh_stock_fact(spark, quotes, paths[2], since=since)
    for path, whole in ((paths[1], G.industry_fact(whole_daily, names)), (paths[2], I.stock_fact(every))):
        built = spark.read.schema(whole.schema).parquet(path).select(*whole.columns)
        assert sorted(map(str, built.collect())) == sorted(map(str, whole.collect()))


def test_marts_refuse_a_universe_that_would_fan_out(spark):
    twice = spark.createDataFrame([("a",), ("a",)], "stock_id string")
    with pytest.raises(ValueError):
        marts.require_unique("universe", twice, "stock_id")
    marts.require_unique("universe", twice.distinct(), "stock_id")


def test_replaced_partitions_leave_the_others(spark):
    path = scratch_path(spark, "lake")
    first = spark.createDataFrame([("d1", 1), ("d2", 1)], "dt string, v int")
    sinks.replace_partitions(first, path)
    for _ in range(2):
        sinks.replace_partitions(spark.createDataFrame([("d2", 2), ("d3", 2)], "dt string, v int"), path)
    read = spark.read.schema("v int, dt string").parquet(path)
    assert sorted((r.dt, r.v) for r in read.collect()) == [("d1", 1), ("d2", 2), ("d3", 2)]
    # Loading a day that has no rows clears it.
    sinks.load_day(read.where("false"), path, "d3")
    spark.catalog.refreshByPath(path)
    assert {r.dt for r in spark.read.schema("v int, dt string").parquet(path).collect()} == {"d1", "d2"}


def test_rows_are_counted_while_they_are_written(spark):
    from marketmill.operators import runlog

    path = scratch_path(spark, "observed")
    rows = [(f"2026-01-0{d}", m, k) for d in (1, 2, 3) for m in S.MARKETS for k in range(4 * d + (m == "TPEx")) if (d, m) != (2, "TPEx")] + [("2026-01-01", "other", 1)]
    quotes = spark.createDataFrame(rows, "dt string, market string, v int")
    counts = sinks.replace_observed(quotes, path, ["2026-01-01", "2026-01-02", "2026-01-09"], S.MARKETS)
    assert counts == {("2026-01-01", "TWSE"): 4, ("2026-01-01", "TPEx"): 5, ("2026-01-02", "TWSE"): 8}
    assert spark.read.schema("market string, v int, dt string").parquet(path).count() == len(rows)
    ran = datetime(2026, 1, 1, 17)
    mine = runlog.observed_runs(spark, counts, "d", "t", ran, ran + timedelta(seconds=9))
    theirs = runlog.partition_runs(quotes.where("dt < '2026-01-03' and market <> 'other'"), "d", "t", ran, ran + timedelta(seconds=9))
    assert mine.schema.simpleString() == theirs.schema.simpleString() and sorted(mine.collect()) == sorted(theirs.collect())
