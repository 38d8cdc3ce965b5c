"""The wide, denormalised market table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def market_wide(
    stocks: DataFrame,
    stock_dimension: DataFrame,
    industry_dimension: DataFrame,
    industry_prices: DataFrame,
    sentiment: DataFrame,
) -> DataFrame:
    """Stock facts with names, industry price and sentiment of the day; never loses a fact row."""
    instruments = stock_dimension.select("stock_id", "company_name", "stock_name", "industry_code")
    prices = industry_prices.select(
        "trade_date", "industry_code", "market", F.col("weighted_avg_price").alias("industry_weighted_price")
    )
    mood = sentiment.withColumnRenamed("index_date", "trade_date")
    wide = (
        stocks.join(instruments, "stock_id", "left")
        .join(industry_dimension, "industry_code", "left")
        .join(prices, ["trade_date", "industry_code", "market"], "left")
        .join(mood, "trade_date", "left")
    )
    return wide.select(
        "trade_date", "stock_id", "company_name", "stock_name", "market", "industry_code",
        "industry_name", "open_price", "high_price", "low_price", "close_price", "trade_volume",
        "trade_value", "change_amount", "ma5", "ma20", "rsi14", "industry_weighted_price",
        "fear_greed_score", "fear_greed_rating",
    )
