"""Answers behind the dashboard pages."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_date(facts: DataFrame) -> DataFrame:
    return facts.agg(F.max("trade_date").alias("latest_date"))


def latest_rows(facts: DataFrame, market: str) -> DataFrame:
    """Rows of the market's newest day; a scalar subquery, so a dated table is pruned to that day."""
    ours = facts.where(F.col("market") == market)
    newest = ours.agg(F.max("trade_date").alias("d")).scalar()
    return ours.where(F.col("trade_date") == newest)


def rows_on(facts: DataFrame, market: str, day: date | None) -> DataFrame:
    """Rows of a market on a day that is known, from one folder of a dated table; none where no day is."""
    return facts.where((F.col("market") == market) & (F.col("trade_date") == F.lit(day).cast("date")))


def industry_ranking(industries: DataFrame, market: str, by: str = "return", rows: DataFrame | None = None) -> DataFrame:
    """Industries of the newest day by return, or by code. `rows` are those of the day where it is known already."""
    rows = (latest_rows(industries, market) if rows is None else rows).where(
        F.col("daily_return_pct").isNotNull() & F.col("industry_name").isNotNull()
    )
    order = [F.desc("daily_return_pct"), F.asc("industry_code")] if by == "return" else [F.asc("industry_code")]
    columns = ["trade_date", "industry_code", "industry_name", "weighted_avg_price", "daily_return_pct"]
    return rows.select(*columns).orderBy(*order)


def best_and_worst(ranking: DataFrame) -> DataFrame:
    """First and last industry of the ranking; the lower code wins a tie for best, the higher one for worst."""
    shown = F.struct("industry_code", "industry_name", "daily_return_pct")
    ends = ranking.agg(F.min_by(shown, F.struct(-F.col("daily_return_pct"), "industry_code")).alias("best"),
                      F.max_by(shown, F.struct(-F.col("daily_return_pct"), "industry_code")).alias("worst"))
    return ends.select(
        F.col("best.industry_name").alias("best_industry"), F.col("best.daily_return_pct").alias("best_return_pct"),
        F.col("worst.industry_name").alias("worst_industry"), F.col("worst.daily_return_pct").alias("worst_return_pct"),
    )


def newest_sentiment(sentiment: DataFrame, rows: int = 2) -> DataFrame:
    """The newest rows; a top-n plan, no full sort."""
    return sentiment.orderBy(F.desc("index_date")).limit(rows)


def sentiment_change(sentiment: DataFrame) -> DataFrame:
    """The newest score and its change since the row before; no change on a single row."""
    newest_first = Window.orderBy(F.desc("index_date"))
    two = newest_sentiment(sentiment).select(
        "*",
        F.lead("fear_greed_score").over(newest_first).alias("prior"),
        F.row_number().over(newest_first).alias("rn"),
    )
    return two.where("rn = 1").select(
        "index_date", "fear_greed_score", "fear_greed_rating",
        (F.col("fear_greed_score") - F.col("prior")).alias("score_change"),
    )


def stock_series(facts: DataFrame, stock_id: str, start: date) -> DataFrame:
    return (
        facts.where((F.col("stock_id") == stock_id) & (F.col("trade_date") >= F.lit(start)))
        .select("trade_date", "open_price", "high_price", "low_price", "close_price", "trade_volume", "ma5", "ma20", "rsi14")
        .orderBy("trade_date")
    )


def stock_info(wide: DataFrame, stock_id: str) -> DataFrame:
    """The instrument's newest descriptive row."""
    columns = ["stock_id", "company_name", "stock_name", "market", "industry_name"]
    rows = wide.where(F.col("stock_id") == stock_id)
    return rows.orderBy(F.desc("trade_date"), "market").limit(1).select(*columns)


def industry_vs_sentiment(
    industries: DataFrame, sentiment: DataFrame, industry_name: str, market: str, start: date
) -> DataFrame:
    """Price of one industry beside the sentiment of the day."""
    rows = industries.where(
        (F.col("industry_name") == industry_name) & (F.col("market") == market) & (F.col("trade_date") >= F.lit(start))
    )
    mood = sentiment.select(F.col("index_date").alias("trade_date"), "fear_greed_score")
    return (
        rows.select("trade_date", "weighted_avg_price")
        .join(mood, "trade_date", "left")
        .orderBy("trade_date")
    )
