"""The driver's tables seen as market data.

Trades come from lineitem (supplier = instrument, ship day = trade date, about
2,500 days) or, for what is written to dated folders, from events (user =
instrument, 30 days). supplier is the official list, region the industry names,
events also the sentiment stream and the run log, pages and documents the
articles. Every projection covers its whole table.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketmill import schemas as S
from marketmill.operators import quotes as Q
from marketmill.session import scratch_path
from marketmill.sources import sinks

ZONE = "UTC"
TODAY = date(2001, 6, 30)
RUN_ANCHOR = datetime(2024, 1, 31)
# Days from the first event day, 2024-01-01, back to its market day, 1998-06-16.
DAY_SHIFT = 9330
# Above any price in cents.
PRICE_ROOM = 10_000_000_000
# Bytes of a table that one core may have to read alone.
SMALL = 64 << 20

# Events with the columns of lineitem, in words both engines read.
EVENT_TRADES = f"""
select event_id as l_orderkey, event_id % 97 as l_partkey, user_id as l_suppkey,
    cast(event_id % 7 + 1 as int) as l_linenumber, cast(event_id % 50 + 1 as double) as l_quantity,
    value as l_extendedprice, cast(event_id % 10 as double) / 100 as l_discount,
    cast(event_id % 9 as double) / 100 as l_tax,
    case when event_type = 'view' then 'N' when event_type = 'click' then 'A' else 'R' end as l_returnflag,
    case when event_type = 'error' then 'F' else 'O' end as l_linestatus,
    cast(ts as date) - interval {DAY_SHIFT} day as l_shipdate
from events"""

# Sentences both engines can read; placeholders are the number formats.
_NOISY = "case when l_orderkey % 17 = 0 then '---' when l_orderkey % 13 = 0 then {0} || ' ' else {0} end"
_QTY = "cast(l_quantity as bigint)"
_VALUE = "cast(round(l_extendedprice * l_quantity, 0) as bigint)"
_COUNT = (
    "case when l_orderkey % 29 = 0 then '12.5' when l_orderkey % 31 = 0 then '12345678901234567890' "
    "when l_orderkey % 37 = 0 then '12.' else cast(l_linenumber as string) end"
)
MARKET = f"case when l_suppkey % 2 = 0 then '{S.MARKET_A}' else '{S.MARKET_B}' end"
RATING = (
    "case when {0} < 25 then 'extreme fear' when {0} < 45 then 'fear' when {0} <= 55 then 'neutral' "
    "when {0} <= 75 then 'greed' else 'extreme greed' end"
)


def raw_row_a(f2, f0) -> list[str]:
    noisy = _NOISY.format
    return [
        "cast(l_suppkey as string)", "'Stock ' || cast(l_suppkey as string)",
        noisy(f0(f"{_QTY} * 1000")), _COUNT, noisy(f0(_VALUE)),
        noisy(f2("l_extendedprice")), f2("l_extendedprice + 5"), f2("l_extendedprice - 5"),
        noisy(f2("l_extendedprice + 1")),
        "case when l_linestatus = 'F' and l_linenumber = 1 then '' when l_returnflag = 'A' then '<p style=color:red>+</p>' "
        "when l_returnflag = 'R' then '<p style=color:green> - </p>' else '<p>X</p>' end",
        f2("l_discount * 100"), f2("l_extendedprice - 1"), f0(_QTY), f2("l_extendedprice + 1"), f0(f"{_QTY} + 1"),
        "case when l_tax = 0 then '-' else " + f2("l_tax * 1000") + " end",
    ]


def raw_row_b(f2, f0) -> list[str]:
    noisy = _NOISY.format
    return [
        "cast(l_suppkey as string)", "'Stock ' || cast(l_suppkey as string)",
        noisy(f2("l_extendedprice + 1")),
        "case when l_returnflag = 'A' then '+' || {0} when l_returnflag = 'R' then '-' || {0} else '---' end".format(f2("l_discount * 100")),
        noisy(f2("l_extendedprice")), f2("l_extendedprice + 5"), f2("l_extendedprice - 5"), f2("l_extendedprice + 2"),
        noisy(f0(f"{_QTY} * 1000")), noisy(f0(_VALUE)), _COUNT,
        f2("l_extendedprice - 1"), f0(_QTY), f2("l_extendedprice + 1"), f0(f"{_QTY} + 1"),
        f0("l_partkey * 1000"), f2("l_extendedprice"), f2("l_extendedprice + 10"), f2("l_extendedprice - 10"),
    ]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def trades(spark: SparkSession, sf: str, source: str = "lineitem") -> DataFrame:
    if source == "events":
        return spark.sql(EVENT_TRADES.replace("from events", "from {events}"), events=table(spark, sf, "events"))
    return table(spark, sf, "lineitem")


def _spread(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Rows of a small table, which is one row group, dealt over the cores; a larger one comes in splits and is not moved."""
    small = rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < SMALL
    return rows.repartition(spark.sparkContext.defaultParallelism) if small else rows


def _written(spark: SparkSession, sf: str, source: str, raw_row) -> tuple[DataFrame, list[str]]:
    """Trades with every number that a raw row writes, each formatted once, and the row's cells over these texts."""
    texts: dict[str, str] = {}

    def text(digits: int):
        return lambda x: texts.setdefault(f"format_number({x}, {digits})", f"text_{len(texts)}")

    cells = raw_row(text(2), text(0))
    return _spread(spark, trades(spark, sf, source)).select("*", *[F.expr(e).alias(name) for e, name in texts.items()]), cells


def _raw(spark: SparkSession, sf: str, source: str, raw_row, names: list[str]) -> DataFrame:
    """Raw text, made as it is read: as a table it would take many times its source.

    Coalescing merges no tasks here. It ends the generated method, which the
    JVM would leave interpreted if formatting and parsing made it too long.
    """
    rows, cells = _written(spark, sf, source, raw_row)
    texts = rows.selectExpr("cast(cast(l_shipdate as date) as string) as dt", *[f"{e} as {n}" for e, n in zip(cells, names, strict=True)])
    return texts.coalesce(2**31 - 1)


def raw_a(spark, sf, source: str = "lineitem") -> DataFrame:
    """Exchange A's raw text."""
    return _raw(spark, sf, source, raw_row_a, S.RAW_ROW_A.names)


def raw_b(spark, sf, source: str = "lineitem") -> DataFrame:
    return _raw(spark, sf, source, raw_row_b, S.RAW_ROW_B.names)


def of_market(rows: DataFrame, market: str) -> DataFrame:
    """Rows of instruments that belong to one market; the two markets cover all."""
    return rows.where(F.expr(MARKET.replace("l_suppkey", "cast(stock_id as bigint)")) == market)


def payloads(spark, sf, side: str = "a", source: str = "lineitem") -> DataFrame:
    """One payload per trade, without grouping.

    Every trade of order line 6 brings a second, cut-off row; some payloads are
    markers without data; line 7 comes with a reordered header, line 5 with a
    column less. The cells are exploded out of an array of one, below which no
    filter on the payload is pushed: there it would format every cell again.
    """
    rows, cells = _written(spark, sf, source, raw_row_a if side == "a" else raw_row_b)
    header = S.RAW_FIELDS_A if side == "a" else S.RAW_FIELDS_B
    expected = F.array(*[F.lit(f) for f in header])
    return rows.select("*", F.expr(f"explode(array(array({', '.join(cells)}))) as cells")).select(
        F.expr("cast(cast(l_shipdate as date) as string)").alias("dt"),
        F.expr(MARKET).alias("market_hint"),
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_linenumber") == 7, F.reverse(expected))
        .when(F.col("l_linenumber") == 5, F.slice(expected, 1, len(header) - 1))
        .otherwise(expected).alias("fields"),
        F.expr(
            "case when l_orderkey % 23 = 0 then null when l_linenumber = 6 then array(cells, slice(cells, 1, 10)) else array(cells) end"
        ).alias("data"),
    )


def clean_quotes(spark, sf, source: str = "lineitem") -> DataFrame:
    """Unified quotes: one row per instrument and day.

    Open and close are the first and last trade by key, then price: both are
    packed into one number, so that a plain minimum and maximum find them. Sums
    run over whole cents, so they are exact in any order. Everything stays on
    hash aggregation and combines before the shuffle.
    """
    cents = F.rint(F.col("l_extendedprice") * 100).cast("bigint")
    packed = F.when((cents < 0) | (cents >= PRICE_ROOM), F.raise_error(F.lit("price does not fit the packed trade")).cast("bigint")).otherwise(cents)
    trade_no = (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("decimal(20,0)")
    trade = (trade_no * F.lit(PRICE_ROOM).cast("decimal(11,0)") + packed).cast("decimal(38,0)")
    value_cents = F.rint(F.col("l_extendedprice") * F.col("l_quantity") * 100).cast("bigint")
    bars = (
        trades(spark, sf, source)
        .groupBy("l_suppkey", F.col("l_shipdate").cast("date").alias("day"))
        .agg(
            F.min(trade).alias("first_trade"),
            F.max(trade).alias("last_trade"),
            F.max("l_extendedprice").alias("high_price"),
            F.min("l_extendedprice").alias("low_price"),
            F.sum(cents).alias("cents"),
            F.sum(value_cents).alias("value_cents"),
            F.sum("l_quantity").cast("bigint").alias("trade_volume"),
            F.count(F.lit(1)).alias("n"),
            F.min("l_quantity").cast("bigint").alias("min_qty"),
            F.max("l_quantity").cast("bigint").alias("max_qty"),
            F.max("l_tax").alias("tax"),
            F.max("l_partkey").alias("part"),
        )
    )
    second = "l_suppkey % 2 = 1"
    priced = bars.selectExpr(
        "*",
        f"cast(first_trade % {PRICE_ROOM} as double) / 100D as open_price",
        f"cast(last_trade % {PRICE_ROOM} as double) / 100D as close_price",
    )
    return priced.selectExpr(
        "cast(day as string) as dt",
        "cast(l_suppkey as string) as stock_id",
        "'Stock ' || cast(l_suppkey as string) as stock_name",
        f"{MARKET} as market",
        "open_price", "high_price", "low_price", "close_price",
        f"case when {second} then ((2 * cents + n) div (2 * n)) / 100D end as average_price",
        "trade_volume",
        f"case when not ({second} and day < date'1998-01-01') and not (l_suppkey % 10 = 1 and day < date'1998-07-01') "
        "then (value_cents + 50) div 100 end as trade_value",
        "n as transaction_count",
        "round(close_price - open_price, 2) as change_amount",
        "low_price as last_bid_price", "min_qty as last_bid_volume",
        "high_price as last_ask_price", "max_qty as last_ask_volume",
        f"case when not ({second}) then round(tax * 100, 2) end as pe_ratio",
        f"case when {second} then part * 1000 end as issued_shares",
    )


def bars(spark, sf, source: str = "lineitem") -> DataFrame:
    return Q.stage_quotes(clean_quotes(spark, sf, source))


def universe(spark, sf) -> DataFrame:
    return table(spark, sf, "supplier").selectExpr(
        "cast(s_suppkey as string) as stock_id", "s_name as company_name",
        "'Stock ' || cast(s_suppkey as string) as stock_name",
        "lpad(cast(s_nationkey % 5 + 1 as string), 2, '0') as industry_code",
        "date_add(date'1995-01-01', cast(s_suppkey % 700 as int)) as listing_date",
        f"{MARKET.replace('l_suppkey', 's_suppkey')} as market",
    )


def official(spark, sf) -> DataFrame:
    """Instruments on the official list: suppliers with an account in credit."""
    listed = table(spark, sf, "supplier").where("s_acctbal >= 0")
    return listed.selectExpr(
        "cast(s_suppkey as string) as stock_id", f"{MARKET.replace('l_suppkey', 's_suppkey')} as market"
    )


def official_of(spark, sf, market: str) -> DataFrame:
    return official(spark, sf).where(F.col("market") == market).select("stock_id")


def raw_list(spark, sf, market: str) -> DataFrame:
    """Two dated snapshots of a raw list; some listing dates are impossible or missing."""
    snapshots = table(spark, sf, "supplier").selectExpr(
        "s_suppkey", "s_name", "s_nationkey",
        f"{MARKET.replace('l_suppkey', 's_suppkey')} as market",
        "case when s_suppkey % 11 = 3 then '20260231' when s_suppkey % 11 = 4 then '' "
        "else date_format(date_add(date'1995-01-01', cast(s_suppkey % 700 as int)), 'yyyyMMdd') end as listed",
        "explode(array('2001-01-01', '2001-06-01')) as dt",
    )
    return snapshots.where(F.col("market") == market).select(
        F.col("s_suppkey").cast("string").alias(S.LIST_ID),
        F.col("s_name").alias(S.LIST_COMPANY),
        F.concat(F.lit("Stock "), F.col("s_suppkey").cast("string")).alias(S.LIST_SHORT_NAME),
        F.when(F.col("dt") == "2001-06-01", F.expr("lpad(cast(s_nationkey % 5 + 1 as string), 2, '0')"))
        .otherwise("99").alias(S.LIST_INDUSTRY),
        F.col("listed").alias(S.LIST_LISTING_DATE[market]),
        "dt",
    )


def seed(spark, sf) -> DataFrame:
    """Industry names; the codes are shifted, so one code in use has no name."""
    return table(spark, sf, "region").selectExpr(
        "lpad(cast(r_regionkey + 2 as string), 2, '0') as industry_code", "r_name as industry_name"
    )


def clean_sentiment(spark, sf) -> DataFrame:
    day = F.col("ts").cast("date")
    per_day = (
        table(spark, sf, "events").groupBy(day.alias("day"))
        .agg(F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("cents"), F.count(F.lit(1)).alias("n"))
    )
    scored = per_day.selectExpr(
        f"cast(date_sub(day, {DAY_SHIFT}) as string) as dt", "((2 * cents + n) div (2 * n)) / 100D as score"
    )
    return scored.selectExpr("dt", "score", f"{RATING.format('score')} as fear_greed_rating")


def sentiment(spark, sf) -> DataFrame:
    return clean_sentiment(spark, sf).select(
        F.col("dt").cast("date").alias("index_date"), F.col("score").alias("fear_greed_score"), "fear_greed_rating"
    )


def sentiment_records(spark, sf) -> DataFrame:
    """Epoch-millisecond records, many per day."""
    return table(spark, sf, "events").selectExpr(
        "cast(timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', ts) "
        f"- {DAY_SHIFT} * 86400000L as double) as x",
        "value as y", f"{RATING.format('value')} as rating",
    )


def sentiment_payloads(spark, sf) -> DataFrame:
    """Nested payloads, one per event, each with its record and the same one an hour later."""
    record = "struct(x, y, rating)"
    later = "struct(x + 3600000D as x, y, rating)"
    return sentiment_records(spark, sf).selectExpr(
        "struct(y as score, rating, cast(x as string) as timestamp) as fear_and_greed",
        f"struct(array({record}, {later}) as data) as fear_and_greed_historical",
    )


def history(spark, sf, source: str = "lineitem") -> DataFrame:
    """Adjusted histories: prices with long fractions, NaN on some days."""
    price = "case when trade_volume % 11 = 0 then double('NaN') else {0}_price / 3 end as {0}"
    return clean_quotes(spark, sf, source).selectExpr(
        "stock_id", "market", "dt as trade_date", *[price.format(c) for c in Q.OHLC], "trade_volume as volume"
    )


def run_log(spark, sf) -> DataFrame:
    return table(spark, sf, "events").selectExpr(
        "ts as run_timestamp", "'dag_' || cast(user_id % 3 as string) as dag_id", "event_type as task_id",
        "cast(ts as date) as target_date", "case when value > 100 then 'failed' else 'success' end as status",
        "cast(null as bigint) as row_count", "value as duration_seconds",
    )


def feed_articles(spark, sf) -> DataFrame:
    """Pages as the first publisher's articles; some lack an id, some a time."""
    return table(spark, sf, "pages").selectExpr(
        "case when page_id % 3 = 0 then '' else cast(page_id as string) end as source_id",
        "url as title", "html as markup", "url", "page_id as position", "'  page ' || cast(page_id as string) || '\n' as summary",
        "case when page_id % 4 > 0 then 'c' || cast(page_id % 4 as string) end as category",
        "case when page_id % 5 = 0 then 0L else 1700000000L + page_id * 60 end as epoch",
        "array('news', '', 'k' || cast(page_id % 4 as string), 'news') as keyword",
        "array(named_struct('code', cast(page_id % 7 as string), 'name', 'n'), named_struct('code', '', 'name', 'n')) as market",
        "array('TWS:' || cast(page_id % 9 as string) || ':STOCK:COMMON', 'TW:ETF', 'plain') as products",
        "case when page_id % 2 = 0 then array('US-META') end as stocks",
    )


def vendor_articles(spark, sf) -> DataFrame:
    """The same pages and all documents from the second publisher; page addresses collide with the first."""
    pages = table(spark, sf, "pages").selectExpr(
        "url as title", "cast(null as string) as summary", "url", "page_id as position", "1600000000L + page_id as epoch",
        "cast(page_id as string) || case when page_id % 2 = 0 then '.TW' else '.TWO' end as symbol",
    )
    documents = table(spark, sf, "documents").selectExpr(
        "text as title", "text as summary", "'doc/' || source || '/' || case when doc_id % 10 = 0 then lang else cast(doc_id as string) end as url", "doc_id as position", "1500000000L + doc_id as epoch",
        "source as symbol",
    )
    return pages.unionByName(documents)


def fetch_attempts(spark, sf) -> DataFrame:
    """Numbered fetch attempts per order date."""
    return table(spark, sf, "orders").selectExpr(
        "cast(o_orderdate as date) as dt", "cast(o_orderkey % 4 + 1 as int) as attempt",
        "o_orderstatus <> 'P' as http_ok", "o_orderpriority like '1%' as retryable",
        "case when o_orderstatus = 'F' then 'OK' else 'no rows' end as stat",
        "cast(7 + o_custkey % 4 as int) as n_tables", "cast(o_totalprice / 100 as int) as n_rows",
    )


# -- written inputs --------------------------------------------------------

_LANDED: dict[tuple, str] = {}


def stored_once(spark: SparkSession, sf: str, name: str, write) -> str:
    """Folder of an input written once per application and scale."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _LANDED:
        path = scratch_path(spark, name)
        write(path)
        _LANDED[key] = path
    return _LANDED[key]


def raw_lake(spark, sf, *sources: str) -> str:
    """Root of a raw lake with the asked sources landed in it."""
    root = stored_once(spark, sf, "raw", lambda path: None)
    makers = {
        "quotes_a": lambda: (payloads(spark, sf, "a", "events").where(F.col("market_hint") == S.MARKET_A).select("dt", "data"), "dt"),
        "quotes_b": lambda: (payloads(spark, sf, "b", "events").where(F.col("market_hint") == S.MARKET_B).select("dt", "data"), "dt"),
        "instrument_history": lambda: (history(spark, sf, "events"), "stock_id"),
        "universe_a": lambda: (raw_list(spark, sf, S.MARKET_A), "dt"),
        "universe_b": lambda: (raw_list(spark, sf, S.MARKET_B), "dt"),
    }
    for source in sources:
        frame, key = makers[source]()
        stored_once(spark, sf, source, lambda _: sinks.land_raw(frame, root, source, key))
    return root


#: Of the raw texts of every fourth day some are cut off, others do not fit the schema.
DAMAGE = "case when day(cast(dt as date)) % 4 <> 0 then 'none' when l_orderkey % 41 = 0 then 'cut' when l_orderkey % 43 = 0 then 'unfit' else 'none' end"


def damaged_lake(spark, sf) -> str:
    """Root of a raw lake of exchange A's payloads as texts, one per line, some of them damaged."""
    def write(root: str) -> None:
        texts = payloads(spark, sf, "a", "events").where(F.col("market_hint") == S.MARKET_A).select("dt", F.expr(DAMAGE).alias("damage"), F.to_json(F.struct("fields", "data")).alias("text"))
        text = F.when(F.col("damage") == "cut", F.expr("left(text, length(text) - 7)")).when(F.col("damage") == "unfit", '{"fields": [], "data": 7}').otherwise(F.col("text"))
        sinks.replace_partitions(texts.select("dt", text.alias("value")), f"{root}/quotes_a", fmt="text")

    return stored_once(spark, sf, "damaged", write)


def sentiment_file(spark, sf) -> str:
    return stored_once(spark, sf, "sentiment_raw", lambda path: sentiment_payloads(spark, sf).write.json(path))


def clean_lake(spark, sf) -> str:
    return stored_once(spark, sf, "clean_quotes", lambda path: sinks.replace_partitions(clean_quotes(spark, sf, "events"), path))
