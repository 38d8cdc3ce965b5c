"""One query per operator and job, over the driver's tables.

Non-exact numbers are shown as `shown(...)`: four decimals after a small
offset, so that sums taken in another order cannot fall on the other side of a
rounding tie.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import projection as P
from marketmill import schemas as S
from marketmill.functions import articles as NF
from marketmill.functions import labels
from marketmill.functions import parsing
from marketmill.operators import articles as N
from marketmill.operators import asof as A9
from marketmill.operators import backlog as B
from marketmill.operators import calendar as C
from marketmill.operators import coverage as V
from marketmill.operators import dashboard as D
from marketmill.operators import indicators as I
from marketmill.operators import industry as G
from marketmill.operators import presence as B8
from marketmill.operators import quality as Q
from marketmill.operators import quotes as K
from marketmill.operators import runlog as L
from marketmill.operators import sentiment as M
from marketmill.operators import universe as U
from marketmill.plans import cleaning, incremental, marts, presence, state
from marketmill.session import scratch_path
from marketmill.sources import aside, raw, sinks, tables, versions

Query = Callable[..., DataFrame]
QUERIES: dict[str, Query] = {}

DAY = "1998-06-20"
SPLIT = "1998-07-01"
ALL_HISTORY = date(1998, 1, 1)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def shown(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*[F.round(F.col(c) + 1e-7, 4).alias(c) if c in columns else F.col(c) for c in df.columns])


def show_fact(df: DataFrame) -> DataFrame:
    return shown(df, "ma5", "ma20", "rsi14")


def show_wide(df: DataFrame) -> DataFrame:
    return shown(df, "ma5", "ma20", "rsi14", "industry_weighted_price")


def _marts(spark, sf, source: str = "lineitem") -> marts.Marts:
    return marts.build(P.bars(spark, sf, source), P.universe(spark, sf), P.seed(spark, sf), P.sentiment(spark, sf))


def _stored_marts(spark, sf) -> marts.StoredMarts:
    """Marts written once, those of the events; dashboards and gates read them."""
    def write(root: str) -> None:
        marts.refresh_marts(spark, P.bars(spark, sf, "events"), P.universe(spark, sf), P.seed(spark, sf), P.sentiment(spark, sf), root)

    return marts.read_marts(spark, P.stored_once(spark, sf, "marts", write))


def _stored_history(spark, sf) -> marts.StoredMarts:
    """Marts of all days of lineitem, written once."""
    def write(root: str) -> None:
        marts.write_marts(spark, P.bars(spark, sf), P.universe(spark, sf), P.seed(spark, sf), P.sentiment(spark, sf), root)

    return marts.read_marts(spark, P.stored_once(spark, sf, "marts_history", write))


def _lake_quotes(spark, sf) -> DataFrame:
    return K.stage_quotes(raw.clean_quotes(spark, P.clean_lake(spark, sf)))


def _dated(quotes: DataFrame) -> DataFrame:
    return quotes.withColumn("dt", F.col("dt").cast("date"))


def _daily(spark, sf, source: str = "lineitem") -> DataFrame:
    return G.industry_daily(P.bars(spark, sf, source), P.universe(spark, sf))


# -- scans and staging -------------------------------------------------------

@query
def scan_quotes_day(spark, sf):
    lake = P.raw_lake(spark, sf, "quotes_a")
    payload = raw.quotes_day(spark, lake, "quotes_a", DAY, multiline=False).select("dt", "data")
    return K.flatten_payloads(payload, S.RAW_ROW_A)


@query
def scan_quotes_history(spark, sf):
    lake = P.raw_lake(spark, sf, "quotes_a")
    payload = raw.quotes_history(spark, lake, "quotes_a", multiline=False).select("dt", "data")
    return K.flatten_payloads(payload, S.RAW_ROW_A)


@query
def scan_quotes_history_b(spark, sf):
    lake = P.raw_lake(spark, sf, "quotes_b")
    payload = raw.quotes_history(spark, lake, "quotes_b", multiline=False).select("dt", "data")
    return K.flatten_payloads(payload, S.RAW_ROW_B)


def _checked(spark, sf) -> raw.Checked:
    return raw.checked_quotes(spark, P.damaged_lake(spark, sf), "quotes_a", multiline=False, glob="*.txt")


@query
def scan_quotes_sound(spark, sf):
    """The records that parse, of a lake in which others do not."""
    return K.flatten_payloads(_checked(spark, sf).good.select("dt", "data"), S.RAW_ROW_A)


@query
def scan_quotes_rejects(spark, sf):
    """What does not parse, by day and reason."""
    return _checked(spark, sf).rejects.groupBy(F.col("key").alias("dt"), "reason", "status").agg(F.sum("records").alias("records"))


@query
def backlog_set_aside(spark, sf):
    """Days to be fetched again: some of their files were set aside, others were never landed."""
    table, lake = scratch_path(spark, "aside"), P.damaged_lake(spark, sf)
    for _ in range(2):
        aside.put(_checked(spark, sf).rejects, table)
    return cleaning.backlog(spark, lake, "quotes_a", "1998-06-01", "1998-07-31", table)


@query
def scan_instrument_history(spark, sf):
    lake = P.raw_lake(spark, sf, "instrument_history")
    records = raw.instrument_history(spark, lake, "instrument_history", multiline=False)
    known = records.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if c in K.OHLC else F.col(c) for c in records.columns])
    return shown(known, *K.OHLC)


@query
def scan_sentiment_nested(spark, sf):
    return M.history_records(raw.sentiment_payloads(spark, P.sentiment_file(spark, sf), multiline=False))


@query
def scan_universe_latest(spark, sf):
    """The newest snapshot of each exchange's list."""
    lake, found = P.raw_lake(spark, sf, "universe_a", "universe_b"), None
    for market, source in cleaning.SOURCE_LISTS.items():
        listed = raw.universe_snapshot(spark, lake, source, market, multiline=False)
        named = listed.toDF("stock_id", "company_name", "stock_name", "industry_code", "listing_date", "dt")
        found = named if found is None else found.unionByName(named)
    return found


@query
def scan_clean_partitioned(spark, sf):
    quotes = raw.clean_quotes(spark, P.clean_lake(spark, sf), S.MARKET_A)
    return quotes.select("dt", "stock_id", "close_price", "trade_volume")


@query
def scan_seed_codes(spark, sf):
    path = scratch_path(spark, "seed")
    P.seed(spark, sf).write.option("header", True).csv(path)
    return raw.seed_codes(spark, path)


@query
def stg_quotes(spark, sf):
    return K.stage_quotes(P.clean_quotes(spark, sf))


@query
def stg_sentiment(spark, sf):
    return M.stage_sentiment(P.clean_sentiment(spark, sf))


@query
def fact_sentiment(spark, sf):
    return M.sentiment_fact(M.stage_sentiment(P.clean_sentiment(spark, sf)))


@query
def stg_universe(spark, sf):
    return U.stage_universe(P.universe(spark, sf))


# -- sinks: write, then read back --------------------------------------------

def _unpriced(quotes: DataFrame) -> DataFrame:
    return quotes.withColumn("close_price", F.lit(-1.0))


@query
def sink_replace_partition(spark, sf):
    path, quotes = scratch_path(spark, "replace"), P.clean_quotes(spark, sf, "events")
    sinks.replace_partitions(_unpriced(quotes), path)
    for _ in range(2):
        sinks.replace_partitions(quotes.where(F.col("dt") >= SPLIT), path)
    return raw.clean_quotes(spark, path).select("dt", "stock_id", "close_price")


@query
def sink_backfill_union_once(spark, sf):
    path = scratch_path(spark, "backfill")
    side_a = K.unify_a(K.clean_a(P.of_market(P.raw_a(spark, sf, "events"), S.MARKET_A)))
    past = P.history(spark, sf, "events").where(F.col("market") == S.MARKET_B)
    sinks.backfill_once(path, side_a, K.unify_history(K.clean_history(past)))
    return raw.clean_quotes(spark, path).select(*S.names(S.QUOTES))


@query
def sink_versions(spark, sf):
    """Partitions replaced as one version, from a frame that reads the table; a write that was not committed is not seen."""
    root, quotes = scratch_path(spark, "versions"), P.clean_quotes(spark, sf, "events")
    versions.replace(_unpriced(quotes), root)
    versions.replace(quotes.where(F.col("dt") >= SPLIT), root)
    late = versions.read(spark, root, S.QUOTES, first=SPLIT)
    versions.replace(late.withColumn("close_price", F.col("close_price") * 1), root, gone=[DAY])
    return versions.read(spark, root, S.QUOTES).select("dt", "stock_id", "close_price")


@query
def sink_snapshot(spark, sf):
    path = scratch_path(spark, "snapshot")
    for _ in range(2):
        sinks.replace_snapshot(P.universe(spark, sf), path)
    return raw.clean_universe(spark, path)


@query
def load_day_partition(spark, sf):
    path = scratch_path(spark, "warehouse")
    sinks.replace_partitions(_unpriced(P.clean_quotes(spark, sf, "events")), path)
    for _ in range(2):
        sinks.load_day(raw.clean_quotes(spark, P.clean_lake(spark, sf)), path, DAY)
    return raw.clean_quotes(spark, path).select("dt", "stock_id", "close_price")


@query
def incremental_replace(spark, sf):
    """Built to the eighteenth day, then refreshed twice; equals a rebuild."""
    path, quotes = scratch_path(spark, "fact"), _lake_quotes(spark, sf)
    for end in ("1998-07-03", "1998-07-08", "1998-07-15"):
        incremental.refresh_stock_fact(spark, quotes.where(F.col("trade_date") <= F.lit(end).cast("date")), path, lookback_days=5)
    return show_fact(spark.read.schema(I.stock_fact(quotes).schema).parquet(path))


@query
def incremental_digests(spark, sf):
    """Keys of each day, noted in three refreshes of which the later ones read the new days only."""
    path, quotes = scratch_path(spark, "digests"), _lake_quotes(spark, sf)
    for end in ("1998-07-03", "1998-07-08", "1998-07-15"):
        noted = state.note_digests(quotes.where(F.col("trade_date") <= F.lit(end).cast("date")), path, ["stock_id", "trade_date"], 5)
    return noted.select("trade_date", "n_rows", "n_keys", "n_repeated")


@query
def presence_days(spark, sf):
    """Instruments per market and day from bitmaps that were stored in three refreshes; the quotes are not read again."""
    root, quotes = scratch_path(spark, "presence"), _dated(raw.clean_quotes(spark, P.clean_lake(spark, sf)))
    for end in ("1998-07-03", "1998-07-08", "1998-07-15"):
        found = presence.refresh(spark, quotes.where(F.col("dt") <= F.lit(end).cast("date")), root, lookback_days=5)
    return B8.counted(found, "market", "dt")


@query
def presence_months(spark, sf):
    """Instruments that traded in a market on any day of a month: the days' bitmaps merged."""
    quotes = _dated(P.clean_quotes(spark, sf))
    days = B8.day_bitmaps(quotes, B8.numbered(quotes.select("market", "stock_id")))
    months = B8.merged(days.withColumn("month", F.trunc("dt", "month")), "market", "month")
    return B8.counted(months, "market", "month", name="instruments")


@query
def bucketed_tables(spark, sf):
    """All quotes as a table bucketed by instrument; indicators come from it without a shuffle."""
    root = scratch_path(spark, "tables")
    quotes = tables.publish(P.bars(spark, sf), f"clean_{root[-8:]}", "quotes", root, buckets=16, sort=("trade_date",))
    return show_fact(I.stock_fact(quotes))


@query
def materialize_table(spark, sf):
    quotes = sinks.materialize(P.bars(spark, sf, "events"), "quotes", "staging")
    universe = sinks.materialize(P.universe(spark, sf), "universe", "staging")
    path = scratch_path(spark, "industry")
    daily = sinks.materialize(G.industry_daily(quotes, universe), "industry_daily", "marts", path, "trade_date")
    return shown(daily, "weighted_avg_price")


@query
def run_log_append(spark, sf):
    path, quotes = scratch_path(spark, "runs"), P.clean_quotes(spark, sf, "events")
    for minute, task in enumerate(("clean", "load")):
        began = datetime(2024, 2, 1, 17, minute)
        sinks.append_run_log(L.partition_runs(quotes, "market", task, began, began + timedelta(seconds=90)), path)
    return spark.read.parquet(path).select("target_date", "task_id", "status", "row_count", "duration_seconds")


@query
def run_log_observed(spark, sf):
    """The log of two writes of all days, counted while they were written."""
    path, quotes = scratch_path(spark, "runs"), P.clean_quotes(spark, sf, "events")
    days = [str(date(1998, 6, 16) + timedelta(days=d)) for d in range(31)]
    for minute, task in enumerate(("clean", "load")):
        counts = sinks.replace_observed(quotes, scratch_path(spark, "observed"), days, S.MARKETS)
        began = datetime(2024, 2, 1, 17, minute)
        sinks.append_run_log(L.observed_runs(spark, counts, "market", task, began, began + timedelta(seconds=90)), path)
    return spark.read.parquet(path).select("target_date", "task_id", "status", "row_count", "duration_seconds")


@query
def land_raw_partition(spark, sf):
    path, scores = scratch_path(spark, "landed"), P.clean_sentiment(spark, sf)
    sinks.land_raw(scores, path, "sentiment")
    sinks.land_raw(scores.where(F.col("dt") >= SPLIT).withColumn("score", F.lit(0.0)), path, "sentiment")
    return spark.read.schema(S.CLEAN_SENTIMENT).json(f"{path}/sentiment").select("dt", "score", "fear_greed_rating")


@query
def requeue_partitions(spark, sf):
    """Two days are set aside; the lake is neither copied nor changed."""
    table, lake = scratch_path(spark, "requeued"), P.clean_lake(spark, sf)
    root, source = lake.rsplit("/", 1)
    aside.requeue(spark, root, source, spark.createDataFrame([(DAY,), (SPLIT,)], "dt string"), table)
    return raw.clean_quotes(spark, lake, table=table).groupBy("dt").agg(F.count(F.lit(1)).alias("row_count"))


# -- scalar expressions ------------------------------------------------------

@query
def parse_numeric(spark, sf):
    return P.raw_a(spark, sf).select(
        "dt", "stock_id",
        parsing.numeric(F.col("trade_volume"), "bigint").alias("volume"),
        parsing.numeric(F.col("open_price"), "double").alias("open_price"),
        parsing.numeric(F.col("transaction_count"), "bigint").alias("count_long"),
        parsing.numeric(F.col("transaction_count"), "double").alias("count_double"),
    )


@query
def explode_flatten(spark, sf):
    return K.flatten_payloads(P.payloads(spark, sf).select("dt", "fields", "data"), S.RAW_ROW_A)


@query
def drop_null_payload(spark, sf):
    return K.drop_empty_payloads(P.payloads(spark, sf)).groupBy("dt").agg(F.count(F.lit(1)).alias("payloads"))


@query
def html_direction(spark, sf):
    return P.raw_a(spark, sf).select("dt", "stock_id", parsing.direction(F.col("change_symbol_raw")).alias("change_direction"))


@query
def signed_change(spark, sf):
    mark = parsing.direction(F.col("change_symbol_raw"))
    amount = parsing.numeric(F.col("change_amount"), "double")
    return P.raw_a(spark, sf).select(
        "dt", "stock_id", mark.alias("change_direction"), parsing.signed_change(mark, amount).alias("change_amount")
    )


@query
def clean_quotes_a(spark, sf):
    return K.clean_a(P.raw_a(spark, sf))


@query
def clean_quotes_b(spark, sf):
    return K.clean_b(P.raw_b(spark, sf))


@query
def nan_to_null_round(spark, sf):
    return K.clean_history(P.history(spark, sf))


@query
def unify_a(spark, sf):
    return K.unify_a(K.clean_a(P.raw_a(spark, sf)))


@query
def unify_b(spark, sf):
    return K.unify_b(K.clean_b(P.raw_b(spark, sf)))


@query
def unify_history(spark, sf):
    return K.unify_history(K.clean_history(P.history(spark, sf)))


@query
def epoch_ms_to_date(spark, sf):
    return P.sentiment_records(spark, sf).select("x", parsing.epoch_ms_date(F.col("x"), "Asia/Taipei").alias("local_date"))


@query
def clean_universe(spark, sf):
    return U.merge_lists(*[U.clean_list(P.raw_list(spark, sf, m), m) for m in S.MARKETS])


@query
def weight_basis(spark, sf):
    return G.with_weight_basis(P.bars(spark, sf)).select("trade_date", "stock_id", "weight_basis", "weighting_method")


@query
def calendar_attributes(spark, sf):
    days = P.table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("calendar_date")).distinct()
    return C.date_dimension(days)


@query
def rsi_band(spark, sf):
    fact = show_fact(I.stock_fact(P.bars(spark, sf)))
    return fact.select("trade_date", "stock_id", labels.rsi_band(F.col("rsi14")).alias("rsi_status"))


@query
def health_band(spark, sf):
    return L.with_health_band(L.success_summary(P.run_log(spark, sf), P.RUN_ANCHOR))


@query
def era_date_to_iso(spark, sf):
    text = F.expr(
        "case when o_orderkey % 10 = 0 then 'unknown' else cast(year(o_orderdate) - 1911 as string) || date_format(o_orderdate, '/MM/dd') end"
    )
    return P.table(spark, sf, "orders").select("o_orderkey", parsing.era_to_iso(text).alias("iso_date"))


@query
def iso_to_era_date(spark, sf):
    return P.table(spark, sf, "orders").select("o_orderkey", parsing.iso_to_era(F.col("o_orderdate").cast("date")).alias("era_date"))


@query
def normalize_symbol(spark, sf):
    raw_symbol = F.expr(
        "case c_custkey % 4 when 0 then cast(c_custkey as string) || '.TW' when 1 then '  ' || cast(c_custkey as string) || '.two ' "
        "when 2 then cast(c_custkey as string) else cast(c_custkey as string) || '.us' end"
    )
    return P.table(spark, sf, "customer").select("c_custkey", parsing.split_symbol(raw_symbol).alias("s")).select("c_custkey", "s.*")


@query
def vendor_symbol(spark, sf):
    market = F.expr("case c_custkey % 3 when 0 then 'TWSE' when 1 then 'TPEx' else 'UNKNOWN' end")
    symbol = parsing.vendor_symbol(F.col("c_custkey").cast("string"), market)
    return P.table(spark, sf, "customer").select("c_custkey", symbol.alias("symbol"), symbol.isNull().alias("rejected"))


@query
def id_format_class(spark, sf):
    ids = P.table(spark, sf, "orders").selectExpr(
        "cast(o_orderkey as string) || case when o_custkey % 5 = 0 then 'A' else '' end as stock_id"
    )
    return U.id_format_counts(ids)


@query
def article_strip_html(spark, sf):
    return N.with_clean_content(P.table(spark, sf, "pages").select("page_id", "html"), "html")


@query
def article_id(spark, sf):
    return P.feed_articles(spark, sf).select(
        F.col("position").alias("page_id"), NF.article_id(F.col("source_id"), F.col("title")).alias("article_id")
    )


@query
def article_epoch_iso(spark, sf):
    return P.feed_articles(spark, sf).select(
        F.col("position").alias("page_id"), NF.published_at(F.col("epoch"), F.lit("2024-02-01")).alias("published_at")
    )


@query
def article_related_codes(spark, sf):
    codes = NF.related_codes(F.col("market"), F.col("products"), F.col("stocks"))
    return P.feed_articles(spark, sf).select(F.col("position").alias("page_id"), F.concat_ws(",", codes).alias("related_stocks"))


@query
def array_dedup_ordered(spark, sf):
    words = NF.distinct_nonempty(F.split("text", " "))
    return P.table(spark, sf, "documents").select(
        "doc_id", F.concat_ws(" ", words).alias("words"), F.size(words).cast("bigint").alias("word_count")
    )


# -- filters -----------------------------------------------------------------

@query
def filter_official(spark, sf):
    return K.keep_official(P.clean_quotes(spark, sf), P.official(spark, sf)).select("dt", "stock_id", "close_price")


@query
def filter_weightable(spark, sf):
    return G.keep_weightable(P.bars(spark, sf)).select("trade_date", "stock_id", "close_price")


@query
def filter_trading_weekday(spark, sf):
    return P.bars(spark, sf).select("trade_date", "stock_id").where(C.is_trading_weekday(F.col("trade_date")))


@query
def filter_range_preset(spark, sf):
    """Rows in every named range, counted in one pass."""
    inside = [F.count_if(F.col("trade_date") >= F.lit(C.range_start(p, P.TODAY))).alias(p) for p in C.RANGE_PRESETS]
    return P.bars(spark, sf).agg(*inside).unpivot([], C.RANGE_PRESETS, "preset", "rows_in_range")


# -- joins -------------------------------------------------------------------

@query
def join_universe(spark, sf):
    quotes = P.bars(spark, sf).select("trade_date", "stock_id", "market")
    return G.join_universe(quotes, P.universe(spark, sf))


@query
def dim_industry(spark, sf):
    return U.industry_dimension(P.universe(spark, sf), P.seed(spark, sf))


@query
def industry_name_join(spark, sf):
    named = G.with_industry_name(_daily(spark, sf), U.industry_dimension(P.universe(spark, sf), P.seed(spark, sf)))
    return named.select("trade_date", "industry_code", "market", "industry_name")


@query
def market_obt(spark, sf):
    return show_wide(_marts(spark, sf).market_wide)


@query
def industry_vs_sentiment(spark, sf):
    return _industry_vs_sentiment(_stored_marts(spark, sf))


@query
def industry_vs_sentiment_all_days(spark, sf):
    return _industry_vs_sentiment(_stored_history(spark, sf))


def _industry_vs_sentiment(m: marts.StoredMarts) -> DataFrame:
    pairs = D.industry_vs_sentiment(m.industry_fact, m.sentiment_fact, "AMERICA", S.MARKET_A, ALL_HISTORY)
    return shown(pairs, "weighted_avg_price")


@query
def join_expected_actual(spark, sf):
    actual = V.daily_distinct(_dated(P.clean_quotes(spark, sf)))
    return V.expected_vs_actual(actual, V.listed_as_of(actual, P.universe(spark, sf)))


@query
def listed_asof_count(spark, sf):
    return V.listed_as_of(_dated(P.clean_quotes(spark, sf)), P.universe(spark, sf))


@query
def missing_anti(spark, sf):
    return V.absence_intervals(_dated(P.clean_quotes(spark, sf)), P.universe(spark, sf))


@query
def raw_gap_days(spark, sf):
    """The gap scan's days of one range with the instruments missing on them."""
    quotes = _dated(P.clean_quotes(spark, sf))
    asked = quotes.where("dt between date'1998-06-10' and date'1998-07-20'").select("market", "dt")
    return V.missing_on(quotes, P.universe(spark, sf), asked)


@query
def sentiment_asof(spark, sf):
    daily = M.one_per_day(P.sentiment_records(spark, sf), P.ZONE)
    return M.as_of(daily, P.clean_quotes(spark, sf).select("dt"))


@query
def events_asof(spark, sf):
    """For every event the value of the latest view on or before its moment."""
    events = P.table(spark, sf, "events")
    views = events.where("event_type = 'view'").select("ts", "event_id", "value")
    found = A9.latest_before(views, events.select("event_id", "ts"), "ts", "event_id")
    return found.select("event_id", F.col("known.event_id").alias("view_id"), F.col("known.value").alias("view_value"))


@query
def scalar_latest_filter(spark, sf):
    return _scalar_latest_filter(_stored_marts(spark, sf))


def _marts_root(spark, sf) -> str:
    return _stored_marts(spark, sf)._root


@query
def latest_day_served(spark, sf):
    """The newest day of both markets by the note that the refresh keeps; each answer opens one folder."""
    both = [marts.latest_industries(spark, _marts_root(spark, sf), m) for m in S.MARKETS]
    return shown(both[0].unionByName(both[1]).select("market", "trade_date", "industry_code", "weighted_avg_price", "daily_return_pct"), "weighted_avg_price")


@query
def latest_ranking_served(spark, sf):
    """Best and worst industry of the newest day, from its one folder."""
    rows = marts.latest_industries(spark, _marts_root(spark, sf), S.MARKET_A)
    return D.best_and_worst(D.industry_ranking(rows, S.MARKET_A, rows=rows))


@query
def scalar_latest_filter_all_days(spark, sf):
    return _scalar_latest_filter(_stored_history(spark, sf))


def _scalar_latest_filter(m: marts.StoredMarts) -> DataFrame:
    latest = D.latest_rows(m.industry_fact, S.MARKET_A)
    return shown(latest.select("trade_date", "industry_code", "weighted_avg_price", "daily_return_pct"), "weighted_avg_price")


# -- aggregations ------------------------------------------------------------

@query
def industry_daily_price(spark, sf):
    return shown(_daily(spark, sf), "weighted_avg_price")


@query
def weighting_label(spark, sf):
    return G.weighting_label(P.bars(spark, sf), P.universe(spark, sf))


@query
def count_by_market(spark, sf):
    sides = K.unify_a(K.clean_a(P.raw_a(spark, sf))), K.unify_b(K.clean_b(P.raw_b(spark, sf)))
    return K.count_by_market(K.merge_sources(*sides))


@query
def daily_distinct_instruments(spark, sf):
    return V.daily_distinct(P.clean_quotes(spark, sf))


@query
def date_bounds(spark, sf):
    return C.date_bounds(P.bars(spark, sf))


@query
def latest_date(spark, sf):
    return D.latest_date(P.bars(spark, sf))


@query
def run_success_summary(spark, sf):
    return L.success_summary(P.run_log(spark, sf), P.RUN_ANCHOR)


@query
def run_overall_kpi(spark, sf):
    return L.overall_kpi(L.success_summary(P.run_log(spark, sf), P.RUN_ANCHOR))


@query
def run_daily_trend(spark, sf):
    return L.daily_trend(P.run_log(spark, sf), P.RUN_ANCHOR)


@query
def duplicate_key_audit(spark, sf):
    lines = P.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return Q.duplicate_rows(lines, "l_orderkey", "l_linenumber")


@query
def id_length_histogram(spark, sf):
    return U.id_length_histogram(P.bars(spark, sf).select("stock_id", F.isnull("trade_value").alias("is_subset")))


# -- windows -----------------------------------------------------------------

@query
def prev_close(spark, sf):
    return I.with_prev_close(P.bars(spark, sf).select("trade_date", "stock_id", "close_price"))


@query
def gain_loss(spark, sf):
    changes = I.with_gain_loss(I.with_prev_close(P.bars(spark, sf)))
    return shown(changes.select("trade_date", "stock_id", "gain", "loss"), "gain", "loss")


def _indicator(spark, sf, name: str) -> DataFrame:
    return shown(I.stock_fact(P.bars(spark, sf)).select("trade_date", "stock_id", name), name)


@query
def ma5(spark, sf):
    return _indicator(spark, sf, "ma5")


@query
def ma20(spark, sf):
    return _indicator(spark, sf, "ma20")


@query
def rsi14(spark, sf):
    return _indicator(spark, sf, "rsi14")


@query
def fact_stock_daily(spark, sf):
    return show_fact(I.stock_fact(P.bars(spark, sf)))


@query
def industry_return_pct(spark, sf):
    return shown(_marts(spark, sf).industry_fact, "weighted_avg_price")


@query
def latest_vs_previous(spark, sf):
    return shown(I.latest_vs_previous(P.bars(spark, sf)), "close_change")


# -- sorts and limits --------------------------------------------------------

@query
def sentiment_last2(spark, sf):
    return D.newest_sentiment(P.sentiment(spark, sf))


@query
def industry_ranking_latest(spark, sf):
    return shown(D.industry_ranking(_stored_marts(spark, sf).industry_fact, S.MARKET_A), "weighted_avg_price")


@query
def industry_ranking_latest_all_days(spark, sf):
    return shown(D.industry_ranking(_stored_history(spark, sf).industry_fact, S.MARKET_A), "weighted_avg_price")


@query
def best_worst_industry(spark, sf):
    return D.best_and_worst(D.industry_ranking(_stored_marts(spark, sf).industry_fact, S.MARKET_A))


@query
def best_worst_industry_all_days(spark, sf):
    return D.best_and_worst(D.industry_ranking(_stored_history(spark, sf).industry_fact, S.MARKET_A))


@query
def stock_series(spark, sf):
    return show_fact(D.stock_series(I.stock_fact(P.bars(spark, sf)), "7", ALL_HISTORY))


@query
def stock_info(spark, sf):
    return D.stock_info(_stored_marts(spark, sf).market_wide, "7")


@query
def stock_info_all_days(spark, sf):
    return D.stock_info(_stored_history(spark, sf).market_wide, "7")


@query
def top_gaps(spark, sf):
    actual = V.daily_distinct(_dated(P.clean_quotes(spark, sf)))
    return V.largest_gaps(V.expected_vs_actual(actual, V.listed_as_of(actual, P.universe(spark, sf))), 20)


@query
def industry_picker(spark, sf):
    return U.industry_picker(U.industry_dimension(P.universe(spark, sf), P.seed(spark, sf)))


# -- sets --------------------------------------------------------------------

@query
def merge_markets(spark, sf):
    return K.merge_markets(
        K.clean_a(P.of_market(P.raw_a(spark, sf), S.MARKET_A)),
        K.clean_b(P.of_market(P.raw_b(spark, sf), S.MARKET_B)),
        P.official_of(spark, sf, S.MARKET_A),
        P.official_of(spark, sf, S.MARKET_B),
    )


@query
def merge_three_sources(spark, sf):
    return K.merge_sources(
        K.unify_a(K.clean_a(P.of_market(P.raw_a(spark, sf), S.MARKET_A))),
        K.unify_b(K.clean_b(P.of_market(P.raw_b(spark, sf), S.MARKET_B))),
        K.unify_history(K.clean_history(P.history(spark, sf))),
    )


@query
def merge_universe(spark, sf):
    return U.merge_lists(*[U.clean_list(U.latest_snapshot(P.raw_list(spark, sf, m)), m) for m in S.MARKETS])


@query
def sentiment_dedup_day(spark, sf):
    return M.one_per_day(P.sentiment_records(spark, sf), P.ZONE)


@query
def set_difference_ids(spark, sf):
    live = P.table(spark, sf, "events").select(F.col("user_id").cast("string").alias("stock_id"))
    return U.ids_missing_from(live, P.universe(spark, sf))


@query
def article_dedup(spark, sf):
    merged = marts.merged_articles(P.feed_articles(spark, sf), P.vendor_articles(spark, sf), F.lit("2024-02-01"))
    return merged.select("article_id", "title", "url", "published_at", "source_name")


# -- generators --------------------------------------------------------------

@query
def date_spine(spark, sf):
    return C.date_spine(P.bars(spark, sf))


def _backlog_inputs(spark, sf):
    """Every thirteenth of a month counts as marked, every other trade date as landed."""
    days = P.bars(spark, sf).select(F.col("trade_date").alias("dt")).distinct()
    marked = F.dayofmonth("dt") == 13
    return B.requested_days(spark, "1995-01-01", "2001-12-31"), days.where(~marked), days.where(marked)


@query
def backlog_dates(spark, sf):
    return B.backlog_days(*_backlog_inputs(spark, sf))


@query
def backlog_outcomes(spark, sf):
    return B.day_outcomes(*_backlog_inputs(spark, sf))


@query
def backlog_instruments(spark, sf):
    return B.backlog_instruments(P.universe(spark, sf), P.official(spark, sf))


@query
def dim_stock(spark, sf):
    return U.stock_dimension(P.universe(spark, sf))


@query
def dim_date(spark, sf):
    return C.date_dimension(C.date_spine(P.bars(spark, sf)))


# -- quality -----------------------------------------------------------------

@query
def dq_not_null(spark, sf):
    return Q.failing(P.bars(spark, sf), Q.is_missing("trade_value")).select("trade_date", "stock_id")


@query
def dq_unique(spark, sf):
    return Q.repeated_keys(P.raw_a(spark, sf), "dt", "stock_id")


@query
def dq_accepted_values(spark, sf):
    accepted = ["fear", "neutral", "greed"]
    return Q.failing(P.sentiment_records(spark, sf), Q.not_accepted("rating", accepted)).select("x", "rating")


@query
def dq_accepted_range(spark, sf):
    rule = Q.out_of_range("close_price", 0, 100_000, inclusive=False, where=F.col("trade_value").isNotNull())
    return Q.failing(P.bars(spark, sf), rule).select("trade_date", "stock_id", "close_price")


def _averaged(spark, sf, column: str) -> DataFrame:
    """Quotes whose high or low is replaced by the average where there is one, so that rules fail."""
    return P.bars(spark, sf).withColumn(column, F.coalesce("average_price", column))


@query
def dq_high_is_highest(spark, sf):
    return Q.failing(_averaged(spark, sf, "high_price"), Q.high_not_highest()).select("trade_date", "stock_id", "high_price")


@query
def dq_low_is_lowest(spark, sf):
    return Q.failing(_averaged(spark, sf, "low_price"), Q.low_not_lowest()).select("trade_date", "stock_id", "low_price")


@query
def dq_not_future(spark, sf):
    return Q.failing(P.bars(spark, sf), Q.in_future("trade_date", P.TODAY)).select("trade_date", "stock_id")


@query
def dq_no_mixed_method(spark, sf):
    return Q.failing(_marts(spark, sf).industry_fact, Q.is_mixed_method()).select("trade_date", "industry_code", "market")


@query
def dq_freshness(spark, sf):
    loads = P.table(spark, sf, "events").select(
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("source"), F.col("ts").alias("loaded_at")
    )
    return shown(Q.freshness(loads, datetime(2024, 2, 1), ["user_1", "never_loaded"]).drop("last_loaded"), "age_hours")


def _completeness(spark, sf, market: str, official_only: bool) -> DataFrame:
    quotes = _dated(P.clean_quotes(spark, sf, "events"))
    requested = B.requested_days(spark, "1998-06-10", "1998-07-20")
    return shown(V.completeness(requested, quotes, P.official(spark, sf), market, official_only, start="1998-06-10", end="1998-07-20"), "ratio")


@query
def completeness_a(spark, sf):
    return _completeness(spark, sf, S.MARKET_A, official_only=False)


@query
def completeness_b(spark, sf):
    return _completeness(spark, sf, S.MARKET_B, official_only=True)


@query
def raw_gap_scan(spark, sf):
    return V.raw_gap_scan(_dated(P.clean_quotes(spark, sf)), P.universe(spark, sf))


@query
def clean_gap_scan(spark, sf):
    return V.clean_gap_scan(_dated(P.clean_quotes(spark, sf)), P.universe(spark, sf))


@query
def field_contract(spark, sf):
    return Q.field_contract(P.payloads(spark, sf), S.RAW_FIELDS_A).select(
        "l_orderkey", "l_linenumber", "fields_match", "missing_fields", "extra_fields"
    )


@query
def payload_contract(spark, sf):
    body = F.expr(
        """case event_type
           when 'view' then '{"fear_and_greed": {"score": ' || cast(value as string) || ', "rating": null, "timestamp": "t"}}'
           when 'click' then '{"fear_and_greed": {"score": 1, "timestamp": "t"}}'
           else props end"""
    )
    payloads = P.table(spark, sf, "events").select("event_id", body.alias("body"))
    return Q.payload_contract(payloads, "body", "fear_and_greed", ["score", "rating", "timestamp"]).drop("body")


@query
def landing_status(spark, sf):
    attempts = P.fetch_attempts(spark, sf)
    past, current = Q.landing_status(attempts, confirm_empty=True), Q.landing_status(attempts, confirm_empty=False)
    answers = attempts.withColumn("n_tables", F.col("n_tables") - 7)
    single = Q.landing_status_of_answer(answers).select("dt", "status")
    modes = {"history": past, "daily": current, "single": single}
    first, *rest = [df.withColumn("mode", F.lit(name)) for name, df in modes.items()]
    return first.unionByName(rest[0]).unionByName(rest[1])


@query
def unparseable_scan(spark, sf):
    text = {"stock_id", "stock_name", "change_symbol_raw"}
    rows = P.raw_a(spark, sf)
    return Q.unparseable_values(rows, [c for c in S.RAW_ROW_A.names if c not in text])


@query
def null_ohlc_audit(spark, sf):
    quotes = K.unify_b(K.clean_b(P.of_market(P.raw_b(spark, sf), S.MARKET_B)))
    listed = K.keep_official(quotes, P.official_of(spark, sf, S.MARKET_B))
    return Q.average_without_close(listed).select("dt", "stock_id", "average_price")


@query
def nan_residual_check(spark, sf):
    return Q.nan_residue(K.clean_history(P.history(spark, sf)), K.OHLC)


# -- jobs --------------------------------------------------------------------

@query
def job_clean_day(spark, sf):
    out, lake = scratch_path(spark, "clean-day"), P.raw_lake(spark, sf, "quotes_a", "quotes_b")
    lists = [P.official_of(spark, sf, m) for m in S.MARKETS]
    cleaning.clean_day(spark, lake, *lists, "1998-06-25", out, multiline=False)
    return raw.clean_quotes(spark, out).select(*S.names(S.QUOTES))


@query
def job_backfill_quotes(spark, sf):
    out, lake = scratch_path(spark, "backfilled"), P.raw_lake(spark, sf, "quotes_a", "instrument_history")
    cleaning.backfill_quotes(spark, lake, P.official_of(spark, sf, S.MARKET_A), out, multiline=False)
    return raw.clean_quotes(spark, out).select(*S.names(S.QUOTES))


@query
def job_sentiment_day(spark, sf):
    out = scratch_path(spark, "sentiment-day")
    cleaning.sentiment_day(spark, P.sentiment_file(spark, sf), "1998-07-20", P.ZONE, out, multiline=False)
    return raw.clean_sentiment(spark, out)


@query
def job_sentiment_history(spark, sf):
    out = scratch_path(spark, "sentiment-history")
    cleaning.sentiment_history(spark, P.sentiment_file(spark, sf), P.ZONE, out, multiline=False)
    return raw.clean_sentiment(spark, out)


@query
def job_universe(spark, sf):
    out = scratch_path(spark, "universe")
    cleaning.universe(spark, P.raw_lake(spark, sf, "universe_a", "universe_b"), out, multiline=False)
    return raw.clean_universe(spark, out)


@query
def job_marts(spark, sf):
    """All marts, built to the twentieth day and refreshed to the last."""
    root, quotes = scratch_path(spark, "marts"), _lake_quotes(spark, sf)
    rest = P.universe(spark, sf), P.seed(spark, sf), P.sentiment(spark, sf)
    marts.refresh_marts(spark, quotes.where("trade_date <= date'1998-07-05'"), *rest, root)
    return show_wide(marts.refresh_marts(spark, quotes, *rest, root)["marts_market_obt"])


@query
def job_quality_gates(spark, sf):
    return _gates(spark, sf, _stored_marts(spark, sf))


@query
def job_quality_gates_all_days(spark, sf):
    return _gates(spark, sf, _stored_history(spark, sf))


def _gates(spark, sf, m: marts.StoredMarts) -> DataFrame:
    loads = P.table(spark, sf, "events").select(F.lit("events").alias("source"), F.col("ts").alias("loaded_at"))
    late = marts.freshness_gates(loads, datetime(2024, 1, 31), ["events", "never_loaded"])
    return marts.quality_gates(m, P.TODAY).unionByName(late)


@query
def job_dashboard_overview(spark, sf):
    return _overview(_stored_marts(spark, sf))


@query
def job_dashboard_overview_all_days(spark, sf):
    return _overview(_stored_history(spark, sf))


def _overview(m: marts.StoredMarts) -> DataFrame:
    return shown(marts.overview(m.industry_fact, m.sentiment_fact), "score_change")


@query
def job_articles(spark, sf):
    return marts.merged_articles(P.feed_articles(spark, sf), P.vendor_articles(spark, sf), F.lit("2024-02-01"))
