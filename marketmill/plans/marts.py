"""Staging to marts, and what is asked of them."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketmill import schemas as S
from marketmill.operators import articles as N
from marketmill.operators import calendar as C
from marketmill.operators import dashboard as D
from marketmill.operators import indicators as I
from marketmill.operators import industry as G
from marketmill.operators import market as W
from marketmill.operators import quality as Q
from marketmill.operators import sentiment as M
from marketmill.operators import universe as U
from marketmill.plans import incremental as R
from marketmill.plans import state
from marketmill.sources import sinks, versions


@dataclass(frozen=True)
class Marts:
    """Lazy frames of the star schema and the wide table."""

    stock_dimension: DataFrame
    industry_dimension: DataFrame
    date_dimension: DataFrame
    industry_daily: DataFrame
    industry_fact: DataFrame
    stock_fact: DataFrame
    sentiment_fact: DataFrame
    market_wide: DataFrame


def build(quotes: DataFrame, universe: DataFrame, seed: DataFrame, sentiment: DataFrame) -> Marts:
    """All marts as one lazy plan over staged tables; nothing is computed here."""
    industries = U.industry_dimension(universe, seed)
    daily = G.industry_daily(quotes, universe)
    industry_fact = G.industry_fact(daily, industries)
    stock_fact = I.stock_fact(quotes)
    stocks = U.stock_dimension(universe)
    mood = M.sentiment_fact(sentiment)
    return Marts(
        stock_dimension=stocks,
        industry_dimension=industries,
        date_dimension=C.date_dimension(C.date_spine(quotes)),
        industry_daily=daily,
        industry_fact=industry_fact,
        stock_fact=stock_fact,
        sentiment_fact=mood,
        market_wide=W.market_wide(stock_fact, stocks, industries, industry_fact, mood),
    )


def require_unique(table: str, rows: DataFrame, *keys: str) -> None:
    """Stop before a join that a repeated key would fan out."""
    if not Q.repeated_keys(rows, *keys).isEmpty():
        raise ValueError(f"{table}: repeated {', '.join(keys)}")


def refresh_marts(
    spark: SparkSession, quotes: DataFrame, universe: DataFrame, seed: DataFrame, sentiment: DataFrame, root: str,
    since: date | None = None, full: bool = False,
) -> dict[str, DataFrame]:
    """Build or refresh every mart under a root folder.

    `since` rewrites from an earlier day than the lookback (rows that came
    late, requeued days), `full` everything.

    Each fact is written once and read back by the models that use it, which
    cuts their lineage at a table instead of recomputing it per reader. Later
    runs open the days from the lookback on: keys of older days are known by
    their digests, window rows by the state beside each fact.
    """
    require_unique("universe", universe, "stock_id")
    days = state.note_digests(quotes, f"{root}/quotes_digests", ["stock_id", "trade_date"], R.STOCK_LOOKBACK_DAYS, since, full)
    if not days.where("n_repeated > 0").isEmpty():
        raise ValueError("quotes: repeated stock_id, trade_date")

    def table(name: str, df: DataFrame) -> DataFrame:
        return sinks.materialize(df, name, "marts", f"{root}/{name}")

    def written(name: str, like: DataFrame) -> DataFrame:
        return spark.read.schema(like.schema).parquet(f"{root}/{name}").select(*like.columns)

    lazy = build(quotes, universe, seed, sentiment)
    stocks = table("dim_stock", lazy.stock_dimension)
    industries = table("dim_industry", lazy.industry_dimension)
    # The digests name every day, so the span of days is known without the quotes.
    dates = table("dim_date", C.date_dimension(C.date_spine(days)))

    R.refresh_industry_daily(spark, quotes, universe, f"{root}/int_industry_daily_price", since=since, full=full)
    daily = written("int_industry_daily_price", lazy.industry_daily)
    R.refresh_industry_fact(spark, daily, industries, f"{root}/fact_industry_price", since=since, full=full)
    industry_fact = written("fact_industry_price", lazy.industry_fact)
    R.refresh_stock_fact(spark, quotes, f"{root}/fact_stock_daily", since=since, full=full)
    stock_fact = written("fact_stock_daily", lazy.stock_fact)
    R.refresh_rows(spark, lazy.sentiment_fact, f"{root}/fact_fear_greed", "index_date", since=since, full=full)
    mood = written("fact_fear_greed", lazy.sentiment_fact)
    wide = W.market_wide(stock_fact, stocks, industries, industry_fact, mood)
    note_latest(spark, industry_fact, root, since, full)
    # The wide table follows the stock fact, which rewrites more days than the others.
    R.refresh_rows(spark, wide, f"{root}/marts_market_obt", "trade_date", R.STOCK_LOOKBACK_DAYS, since, full)
    return {
        "dim_stock": stocks, "dim_industry": industries, "dim_date": dates,
        "int_industry_daily_price": daily, "fact_industry_price": industry_fact,
        "fact_stock_daily": stock_fact, "fact_fear_greed": mood,
        "marts_market_obt": written("marts_market_obt", lazy.market_wide),
    }


LATEST = "market string, latest_date date"


def note_latest(spark: SparkSession, industry_fact: DataFrame, root: str, since: date | None = None, full: bool = False) -> None:
    """Keep each market's newest day beside the marts, so that a question about it opens one folder.

    Only the days that a refresh may have changed are read. A market without
    rows on them keeps its day; `full` asks all days.
    """
    path = f"{root}/latest_day"
    rows = industry_fact
    if not full and versions.newest(spark, path)[0]:
        known = versions.read(spark, path, LATEST, "market").agg(F.max("latest_date")).first()[0]
        start = known - timedelta(days=R.OTHER_LOOKBACK_DAYS)
        rows = rows.where(F.col("trade_date") >= F.lit(start if since is None else min(start, since)))
    newest = rows.groupBy("market").agg(F.max("trade_date").alias("latest_date")).where(F.col("market").isNotNull())
    versions.replace(newest, path, "market")


def latest_day(spark: SparkSession, root: str, market: str) -> date | None:
    """A market's newest day, from the note of the last refresh."""
    row = versions.read(spark, f"{root}/latest_day", LATEST, "market", first=market, last=market).first()
    return row and row.latest_date


def latest_industries(spark: SparkSession, root: str, market: str) -> DataFrame:
    """The industry fact of a market's newest day; the day is a literal, so its folder alone is read."""
    return D.rows_on(read_marts(spark, root).industry_fact, market, latest_day(spark, root, market))


def write_marts(spark: SparkSession, quotes: DataFrame, universe: DataFrame, seed: DataFrame, sentiment: DataFrame, root: str) -> None:
    """Write every mart once and whole, for a history of any number of days.

    There are no day folders, so a refresh by days does not apply to this root;
    building again replaces it. Each fact is read back by the models that use it.
    """
    require_unique("universe", universe, "stock_id")
    require_unique("quotes", quotes, "stock_id", "trade_date")

    def table(name: str, df: DataFrame) -> DataFrame:
        return sinks.materialize(df, name, "marts", f"{root}/{name}")

    lazy = build(quotes, universe, seed, sentiment)
    stocks = table("dim_stock", lazy.stock_dimension)
    industries = table("dim_industry", lazy.industry_dimension)
    table("dim_date", lazy.date_dimension)
    daily = table("int_industry_daily_price", lazy.industry_daily)
    industry_fact = table("fact_industry_price", G.industry_fact(daily, industries))
    stock_fact = table("fact_stock_daily", lazy.stock_fact)
    mood = table("fact_fear_greed", lazy.sentiment_fact)
    table("marts_market_obt", W.market_wide(stock_fact, stocks, industries, industry_fact, mood))


class StoredMarts:
    """The marts as they were written, for questions and gates. A table's folders are listed when it is first asked for."""

    TABLES = {
        "stock_dimension": "dim_stock", "industry_dimension": "dim_industry", "date_dimension": "dim_date", "industry_daily": "int_industry_daily_price",
        "industry_fact": "fact_industry_price", "stock_fact": "fact_stock_daily", "sentiment_fact": "fact_fear_greed", "market_wide": "marts_market_obt",
    }

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._root = spark, root

    def __getattr__(self, mart: str) -> DataFrame:
        if mart not in self.TABLES:
            raise AttributeError(mart)
        table = self._spark.read.parquet(f"{self._root}/{self.TABLES[mart]}")
        setattr(self, mart, table)
        return table


def read_marts(spark: SparkSession, root: str) -> StoredMarts:
    return StoredMarts(spark, root)


def _present(column: str) -> Column:
    return F.col(column).isNotNull()


def freshness_gates(loads: DataFrame, anchor: datetime, sources: list[str]) -> DataFrame:
    """Verdict rows of the expected sources: one that is too old, or was never loaded, fails."""
    states = Q.freshness(loads, anchor, sources)
    late = F.col("state") == "error"
    return states.select(F.col("source").alias("table_name"), F.lit("freshness").alias("rule"), F.lit("loaded_at").alias("column_name"), late.cast("bigint").alias("failing_rows"), (~late).alias("passed"))


def quality_gates(marts: Marts | StoredMarts, today: date) -> DataFrame:
    """Verdict table of all rules; one scan per table, one shuffle per key rule. Over written marts each scan reads one table."""
    price_rules = [
        Q.Rule("accepted_range", c, Q.out_of_range(c, 0, 100_000, where=_present(c)))
        for c in ("close_price", "open_price", "high_price", "low_price")
    ]
    stock_rules = [
        Q.Rule("not_null", "stock_id", Q.is_missing("stock_id")),
        Q.Rule("not_null", "trade_date", Q.is_missing("trade_date")),
        Q.Rule("accepted_values", "market", Q.not_accepted("market", S.MARKETS)),
        *price_rules,
        Q.Rule("accepted_range", "trade_volume", Q.out_of_range("trade_volume", 0)),
        Q.Rule("accepted_range", "trade_value", Q.out_of_range("trade_value", 0)),
        Q.Rule("accepted_range", "ma5", Q.out_of_range("ma5", 0, inclusive=False)),
        Q.Rule("accepted_range", "ma20", Q.out_of_range("ma20", 0, inclusive=False)),
        Q.Rule("accepted_range", "rsi14", Q.out_of_range("rsi14", 0, 100)),
        Q.Rule("high_is_highest", "high_price", Q.high_not_highest()),
        Q.Rule("low_is_lowest", "low_price", Q.low_not_lowest()),
        Q.Rule("not_future", "trade_date", Q.in_future("trade_date", today)),
    ]
    industry_rules = [
        Q.Rule("not_null", "trade_date", Q.is_missing("trade_date")),
        Q.Rule("not_null", "industry_code", Q.is_missing("industry_code")),
        Q.Rule("accepted_values", "market", Q.not_accepted("market", S.MARKETS)),
        Q.Rule("accepted_range", "weighted_avg_price", Q.out_of_range("weighted_avg_price", 0, inclusive=False)),
        Q.Rule("accepted_range", "total_weight_basis", Q.out_of_range("total_weight_basis", 0)),
        Q.Rule("accepted_range", "stock_count", Q.out_of_range("stock_count", 1)),
        Q.Rule("accepted_values", "weighting_method", Q.not_accepted("weighting_method", S.WEIGHTING_METHODS)),
        Q.Rule("no_mixed_method", "weighting_method", Q.is_mixed_method()),
    ]
    sentiment_rules = [
        Q.Rule("not_null", "index_date", Q.is_missing("index_date")),
        Q.Rule("accepted_range", "fear_greed_score", Q.out_of_range("fear_greed_score", 0, 100)),
        Q.Rule("accepted_values", "fear_greed_rating", Q.not_accepted("fear_greed_rating", S.RATINGS)),
    ]
    dimension_rules = [
        Q.Rule("not_null", "stock_id", Q.is_missing("stock_id")),
        Q.Rule("accepted_values", "market", Q.not_accepted("market", S.MARKETS)),
        Q.Rule("accepted_range", "listing_date", Q.out_of_range("listing_date", high=F.lit(today))),
    ]
    parts = [
        Q.verdicts("fact_stock_daily", marts.stock_fact, stock_rules),
        Q.verdicts("fact_industry_price", marts.industry_fact, industry_rules),
        Q.verdicts("fact_fear_greed", marts.sentiment_fact, sentiment_rules),
        Q.verdicts("dim_stock", marts.stock_dimension, dimension_rules),
        Q.verdicts("dim_date", marts.date_dimension, [Q.Rule("not_null", "calendar_date", Q.is_missing("calendar_date"))]),
        Q.verdicts("dim_industry", marts.industry_dimension, [Q.Rule("not_null", "industry_code", Q.is_missing("industry_code"))]),
        Q.key_verdict("fact_stock_daily", marts.stock_fact, "stock_id", "trade_date"),
        Q.key_verdict("fact_fear_greed", marts.sentiment_fact, "index_date"),
        Q.key_verdict("dim_stock", marts.stock_dimension, "stock_id"),
        Q.key_verdict("dim_date", marts.date_dimension, "calendar_date"),
        Q.key_verdict("dim_industry", marts.industry_dimension, "industry_code"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def overview(industry_fact: DataFrame, sentiment_fact: DataFrame, market: str = S.MARKET_A) -> DataFrame:
    """One row: newest sentiment with its change, best and worst industry of the newest day."""
    ends = D.best_and_worst(D.industry_ranking(industry_fact, market))
    columns = ends.columns
    both = ends.select(F.struct(*columns).alias("ends")).scalar()
    return D.sentiment_change(sentiment_fact).withColumn("ends", both).select("*", "ends.*").drop("ends")


def merged_articles(feed: DataFrame, vendor: DataFrame, run_date: Column) -> DataFrame:
    """Both publishers' articles in the common form, one per id."""
    return N.first_per_id(N.format_feed(feed, run_date), N.format_vendor(vendor, run_date)).drop("position")
