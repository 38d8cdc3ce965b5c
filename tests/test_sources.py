"""The raw lake as it is laid out by the fetchers: small hand-written files."""

import json
from datetime import datetime

import pytest

from marketmill import __main__ as cli
from marketmill import schemas as S
from marketmill.operators import quotes as Q
from marketmill.plans import cleaning
from marketmill.sources import aside, raw, sinks


def put(root, path, content):
    file = root / path
    file.parent.mkdir(parents=True, exist_ok=True)
    file.write_text(json.dumps(content, ensure_ascii=False, indent=2), encoding="utf-8")


def row_a(stock_id, close):
    cells = dict.fromkeys(S.RAW_ROW_A.names, "1") | {"stock_id": stock_id, "close_price": close, "change_symbol_raw": "<p>-</p>"}
    return list(cells.values())


def row_b(stock_id, close):
    cells = dict.fromkeys(S.RAW_ROW_B.names, "2") | {"stock_id": stock_id, "close_price": close}
    return list(cells.values())


@pytest.fixture
def lake(tmp_path):
    for day, close in (("2026-07-08", "10.00"), ("2026-07-09", "1,100.50")):
        put(tmp_path, f"quotes_a/dt={day}/data.json", {"fields": S.RAW_FIELDS_A, "data": [row_a("0050", close), row_a("9999", "---")], "fields_match_expected": True})
        put(tmp_path, f"quotes_b/dt={day}/data.json", {"fields": S.RAW_FIELDS_B, "data": [row_b("6488", "690.00")], "fields_match_expected": True, "actual_trade_date": day})
    put(tmp_path, "quotes_a/dt=2026-07-10/_no_data_marker.json", {"status": "confirmed_no_trading_day"})
    put(tmp_path, "instrument_history/stock_id=0051/data.json", [
        {"stock_id": "0051", "market": "TPEx", "trade_date": "2026-07-08", "open": 1.005, "high": float("nan"), "low": 1.0, "close": 1.239, "volume": 7},
        {"stock_id": "0051", "market": "TPEx", "trade_date": "2026-07-07", "open": 1.0, "high": 1.0, "low": 1.0, "close": 1.0, "volume": 0},
    ])
    for day, code in (("2026-07-01", "99"), ("2026-07-08", "01")):
        for source, market in cleaning.SOURCE_LISTS.items():
            put(tmp_path, f"{market}/dt={day}/data.json", [
                {S.LIST_ID: "0050", S.LIST_COMPANY: "c", S.LIST_SHORT_NAME: "s", S.LIST_INDUSTRY: code, S.LIST_LISTING_DATE[source]: "20000101", "其他": "x"}])
    put(tmp_path, "sentiment.json", {
        "fear_and_greed": {"score": 50.1, "rating": "neutral", "timestamp": "t"},
        "fear_and_greed_historical": {"data": [{"x": 0.0, "y": 44.444, "rating": "fear"}, {"x": 86400000.0 * 3, "y": 60.0, "rating": "greed"}]},
    })
    return tmp_path


def test_readers_keep_text_keys(spark, lake):
    history = Q.flatten_payloads(raw.quotes_history(spark, str(lake), "quotes_a"), S.RAW_ROW_A)
    assert sorted((r.dt, r.stock_id) for r in history.collect()) == [(d, s) for d in ("2026-07-08", "2026-07-09") for s in ("0050", "9999")]
    day = raw.quotes_day(spark, str(lake), "quotes_a", "2026-07-09")
    assert [(r.dt, len(r.data), r.fields) for r in day.collect()] == [("2026-07-09", 2, S.RAW_FIELDS_A)]
    records = raw.instrument_history(spark, str(lake), "instrument_history").collect()
    assert {r.stock_id for r in records} == {"0051"}
    newest = raw.universe_snapshot(spark, str(lake), "universe_a", S.MARKET_A).collect()
    assert [(r[S.LIST_ID], r[S.LIST_INDUSTRY], r.dt) for r in newest] == [("0050", "01", "2026-07-08")]


def test_a_missing_snapshot_is_an_error(spark, lake):
    with pytest.raises(ValueError):
        raw.universe_snapshot(spark, str(lake), "universe_c", S.MARKET_A)


def test_landed_keys_open_no_file(spark, lake):
    plan = raw.landed_keys(spark, str(lake), "quotes_a")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string>" in plan


def test_backlog_over_the_lake(spark, lake):
    root = str(lake)
    assert sorted(r.dt for r in raw.landed_keys(spark, root, "quotes_a").collect()) == ["2026-07-08", "2026-07-09"]
    assert [r.stock_id for r in raw.landed_keys(spark, root, "instrument_history", "stock_id").collect()] == ["0051"]
    days = lambda: [str(r.dt) for r in cleaning.backlog(spark, root, "quotes_a", "2026-07-07", "2026-07-11").orderBy("dt").collect()]
    # The folder of 2026-07-10 holds nothing but a marker.
    assert [r.dt for r in raw.marked_days(spark, root, "quotes_a").collect()] == ["2026-07-10"]
    assert days() == ["2026-07-07", "2026-07-11"]
    sinks.mark_no_data(spark.createDataFrame([("2026-07-11",)], "dt string"), root, "quotes_a")
    assert days() == ["2026-07-07"]
    assert sorted(r.dt for r in raw.landed_keys(spark, root, "quotes_a").collect()) == ["2026-07-08", "2026-07-09"]


def test_run_log_never_fails_the_caller(spark):
    rows = spark.createDataFrame([(datetime(2026, 1, 1), "ok")], "run_timestamp timestamp_ntz, status string")
    with pytest.warns(UserWarning):
        assert sinks.append_run_log(rows, "nofs://nowhere/log").count() == 1


def test_shipped_seed_keeps_leading_zeros(spark):
    from pathlib import Path

    import marketmill

    codes = raw.seed_codes(spark, str(Path(marketmill.__file__).parent / "seeds" / "industry_names.csv")).collect()
    assert len(codes) == 36 and codes[0].industry_code == "01"


def test_jobs_from_the_command_line(spark, lake, tmp_path):
    put(lake, "sentiment_history/range=full/data.json", json.loads((lake / "sentiment.json").read_text()))

    def job(name, *more):
        return cli.run(spark, cli._arguments([name, "--lake", str(lake), "--clean", str(tmp_path / "c"), "--marts", str(tmp_path / "m"), *more]))

    # The shared list of both markets would fan out, so exchange B gets its own instrument.
    put(lake, "universe_b/dt=2026-07-09/data.json", [
        {S.LIST_ID: "6488", S.LIST_COMPANY: "c", S.LIST_SHORT_NAME: "s", S.LIST_INDUSTRY: "24", S.LIST_LISTING_DATE[S.MARKET_B]: "20110101"}])
    for name in ("universe", "backfill", "sentiment-history"):
        job(name)
    job("clean-day", "--date", "2026-07-09")
    job("marts")
    wide = spark.read.parquet(str(tmp_path / "m" / "marts_market_obt"))
    named = {(r.stock_id, r.industry_name is not None) for r in wide.collect()}
    assert named == {("0050", True), ("0051", False), ("6488", True)}
    verdict = {(r.table_name, r.rule, r.column_name): r.failing_rows for r in job("gates", "--date", "2026-07-08").collect()}
    assert verdict["fact_stock_daily", "not_future", "trade_date"] == 2
    assert [str(r.dt) for r in job("backlog", "--start", "2026-07-06", "--end", "2026-07-10").collect()] == ["2026-07-06", "2026-07-07"]
    assert job("gaps").isEmpty()


def test_jobs_end_to_end(spark, lake, tmp_path):
    root, out = str(lake), str(tmp_path / "clean")
    official = spark.createDataFrame([("0050",), ("6488",)], "stock_id string")
    cleaning.backfill_quotes(spark, root, official, out)
    rows = {(r.dt, r.stock_id): r for r in raw.clean_quotes(spark, out).collect()}
    assert set(rows) == {("2026-07-08", "0050"), ("2026-07-09", "0050"), ("2026-07-08", "0051"), ("2026-07-07", "0051")}
    old = rows["2026-07-08", "0051"]
    assert (old.open_price, old.high_price, old.close_price, old.trade_value, old.trade_volume) == (1.01, None, 1.24, None, 7)
    assert rows["2026-07-09", "0050"].close_price == 1100.5 and rows["2026-07-09", "0050"].change_amount == -1.0

    cleaning.clean_day(spark, root, official, official, "2026-07-09", out)
    rows = {(r.dt, r.stock_id): r.market for r in raw.clean_quotes(spark, out).collect()}
    assert rows["2026-07-09", "6488"] == "TPEx" and len(rows) == 5

    mood = str(tmp_path / "mood")
    cleaning.sentiment_history(spark, f"{root}/sentiment.json", "UTC", mood)
    cleaning.sentiment_day(spark, f"{root}/sentiment.json", "1970-01-02", "UTC", mood)
    assert sorted(tuple(r) for r in raw.clean_sentiment(spark, mood).select("dt", "score").collect()) == [
        ("1970-01-01", 44.44), ("1970-01-02", 44.44), ("1970-01-04", 60.0)]
    with pytest.raises(ValueError):
        cleaning.sentiment_day(spark, f"{root}/sentiment.json", "1969-12-31", "UTC", mood)

    cleaning.universe(spark, root, str(tmp_path / "universe"))
    assert sorted((r.stock_id, r.industry_code, r.market) for r in raw.clean_universe(spark, str(tmp_path / "universe")).collect()) == [
        ("0050", "01", "TPEx"), ("0050", "01", "TWSE")]


def damage(lake):
    """A cut-off day, a day that does not fit, an empty file, a cut-off history."""
    good = (lake / "quotes_a/dt=2026-07-09/data.json").read_text(encoding="utf-8")
    (lake / "quotes_a/dt=2026-07-09/data.json").write_text(good[: len(good) // 2], encoding="utf-8")
    put(lake, "quotes_a/dt=2026-07-11/data.json", {"fields": S.RAW_FIELDS_A, "data": 7})
    (lake / "quotes_a/dt=2026-07-12").mkdir()
    (lake / "quotes_a/dt=2026-07-12/data.json").write_text("")
    history = (lake / "instrument_history/stock_id=0051/data.json").read_text()
    (lake / "instrument_history/stock_id=0052").mkdir()
    (lake / "instrument_history/stock_id=0052/data.json").write_text(history[:-40])
    return good


def test_broken_files_fail_or_are_set_aside(spark, lake, tmp_path):
    good, root, table = damage(lake), str(lake), str(tmp_path / "aside")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        raw.quotes_history(spark, root, "quotes_a").collect()
    checked = raw.checked_quotes(spark, root, "quotes_a")
    found = {r.key: r for r in checked.rejects.collect()}
    assert {k: (r.reason, r.records, r.status) for k, r in found.items()} == {
        "2026-07-09": ("no JSON", 1, "unknown_failure"), "2026-07-11": ("does not fit the schema", 1, "unknown_failure")}
    assert all(r.file.endswith(f"quotes_a/dt={k}/data.json") for k, r in found.items())
    # Good files are unaffected, whichever columns are asked for.
    assert [r.dt for r in checked.good.select("dt").collect()] == ["2026-07-08"]
    assert [len(r.data) for r in checked.good.select("data").collect()] == [2]

    official, out = spark.createDataFrame([("0050",), ("9999",)], "stock_id string"), str(tmp_path / "clean")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        cleaning.backfill_quotes(spark, root, official, out)
    for _ in range(2):
        cleaning.backfill_quotes(spark, root, official, out, table=table)
    assert {(r.dt, r.stock_id) for r in raw.clean_quotes(spark, out).collect()} == {("2026-07-08", "0050"), ("2026-07-08", "9999"), ("2026-07-08", "0051"), ("2026-07-07", "0051")}
    noted = aside.entries(spark, table).collect()
    assert len(noted) == 3 and {(r.source, r.key) for r in noted} == {("quotes_a", k) for k in found} | {("instrument_history", "0052")}
    days = lambda: [str(r.dt) for r in cleaning.backlog(spark, root, "quotes_a", "2026-07-07", "2026-07-12", table).orderBy("dt").collect()]
    assert days() == ["2026-07-07", "2026-07-09", "2026-07-11", "2026-07-12"]
    assert [r.stock_id for r in aside.landed(spark, root, "instrument_history", table, "stock_id").collect()] == ["0051"]

    # Fetched again, the day has landed, and its rows are read.
    import time

    time.sleep(0.05)
    (lake / "quotes_a/dt=2026-07-09/data.json").write_text(good, encoding="utf-8")
    assert days() == ["2026-07-07", "2026-07-11", "2026-07-12"]
    again = raw.checked_quotes(spark, root, "quotes_a", table=table)
    assert {r.dt for r in again.good.select("dt").collect()} == {"2026-07-08", "2026-07-09"} and again.rejects.isEmpty()


def test_broken_sentiment_is_told(spark, lake):
    put(lake, "sentiment/dt=2026-07-08/data.json", json.loads((lake / "sentiment.json").read_text()))
    whole = raw.checked_sentiment(spark, str(lake), "sentiment", "dt", "2026-07-08")
    assert whole.good.count() == 1 and whole.rejects.isEmpty()
    file = lake / "sentiment/dt=2026-07-08/data.json"
    file.write_text(file.read_text()[:60])
    cut = raw.checked_sentiment(spark, str(lake), "sentiment", "dt", "2026-07-08")
    assert cut.good.isEmpty() and [(r.key, r.reason) for r in cut.rejects.collect()] == [("2026-07-08", "no JSON")]
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        cleaning.sentiment_day(spark, str(file.parent), "2026-07-08", "UTC", str(lake / "mood"))


def test_requeued_days_leave_the_lake_as_it_is(spark, tmp_path):
    """What is written depends on the days set aside and not on the lake; landing a day again brings it back."""
    lake = str(tmp_path / "raw")
    days = [f"2026-06-{d:02d}" for d in range(1, 31)]
    rows = spark.createDataFrame([(d, f"{k}") for d in days for k in range(3)], "dt string, v string")
    sinks.land_raw(rows, lake, "quotes_a")
    before = sorted(p.relative_to(lake).as_posix() for p in (tmp_path / "raw").rglob("*.json"))
    sizes = []
    for n, bad in enumerate((["2026-06-02", "2026-06-09"], ["2026-06-02"])):
        table = str(tmp_path / f"aside{n}")
        aside.requeue(spark, lake, "quotes_a", spark.createDataFrame([(d,) for d in bad], "day string"), table)
        assert {r.key for r in aside.entries(spark, table).collect()} == set(bad)
        sizes.append(aside.entries(spark, table).count())
        aside.requeue(spark, lake, "quotes_a", spark.createDataFrame([(d,) for d in bad], "day string"), table)
        assert aside.entries(spark, table).count() == sizes[-1]
    assert sizes[0] == 2 * sizes[1]
    assert sorted(p.relative_to(lake).as_posix() for p in (tmp_path / "raw").rglob("*.json")) == before
    table = str(tmp_path / "aside0")
    backlog = lambda: [str(r.dt) for r in cleaning.backlog(spark, lake, "quotes_a", "2026-06-01", "2026-06-30", table).orderBy("dt").collect()]
    assert backlog() == ["2026-06-02", "2026-06-09"]
    read = lambda: {r.dt for r in aside.without(aside.with_file(spark.read.schema("v string, dt string").json(f"{lake}/quotes_a")), table).collect()}
    assert read() == set(days) - {"2026-06-02", "2026-06-09"}
    sinks.land_raw(rows.where("dt = '2026-06-02'"), lake, "quotes_a")
    assert backlog() == ["2026-06-09"] and read() == set(days) - {"2026-06-09"}
