"""Turnover-weighted industry prices and their guarded daily return."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEYS = ["trade_date", "industry_code", "market"]


def with_weight_basis(quotes: DataFrame) -> DataFrame:
    """Trade value where known, else volume, and which of the two it is."""
    return quotes.select(
        "*",
        F.coalesce("trade_value", "trade_volume").alias("weight_basis"),
        F.when(F.col("trade_value").isNotNull(), "trade_value").otherwise("trade_volume").alias("weighting_method"),
    )


def keep_weightable(quotes: DataFrame) -> DataFrame:
    return quotes.where((F.coalesce("trade_value", "trade_volume") > 0) & F.col("close_price").isNotNull())


def join_universe(quotes: DataFrame, universe: DataFrame) -> DataFrame:
    """Attach the industry by instrument id; the market stays the quote's own."""
    return quotes.join(universe.select("stock_id", "industry_code"), "stock_id")


def industry_daily(quotes: DataFrame, universe: DataFrame) -> DataFrame:
    """Weighted mean price per day, industry and market.

    The method label needs no distinct count: rows by value, rows in all. That
    leaves one distinct aggregate, and every buffer is numeric, so the plan
    stays on hash aggregation with map-side combining.
    """
    narrow = quotes.select("trade_date", "stock_id", "market", "close_price", "trade_value", "trade_volume")
    rows = join_universe(keep_weightable(narrow), universe)
    weight = F.coalesce("trade_value", "trade_volume")
    sums = rows.groupBy(*KEYS).agg(
        F.sum(weight).alias("total_weight_basis"),
        F.sum(F.col("close_price") * weight).alias("weighted_sum"),
        F.count_distinct("stock_id").alias("stock_count"),
        F.count("trade_value").alias("by_value"),
        F.count(F.lit(1)).alias("quotes"),
    )
    method = (
        F.when(F.col("by_value") == F.col("quotes"), "trade_value")
        .when(F.col("by_value") == 0, "trade_volume")
        .otherwise("mixed")
    )
    return sums.select(
        *KEYS,
        "total_weight_basis",
        (F.col("weighted_sum") / F.col("total_weight_basis")).alias("weighted_avg_price"),
        "stock_count",
        method.alias("weighting_method"),
    )


def weighting_label(quotes: DataFrame, universe: DataFrame) -> DataFrame:
    return industry_daily(quotes, universe).select(*KEYS, "weighting_method")


def with_industry_name(daily: DataFrame, dimension: DataFrame) -> DataFrame:
    return daily.join(dimension, "industry_code", "left")


def with_daily_return(daily: DataFrame) -> DataFrame:
    """Percent change against the previous row, only between rows weighted the same way.

    There is one row per industry, market and day, so the calendar bounds a window partition.
    """
    series = Window.partitionBy("industry_code", "market").orderBy("trade_date")
    before = F.lag(F.struct("weighting_method", "weighted_avg_price")).over(series)
    paired = daily.withColumn("before", before)
    price, prior = F.col("weighted_avg_price"), F.col("before.weighted_avg_price")
    change = F.round((price - prior) / F.nullif(prior, F.lit(0.0)) * 100, 2)
    return paired.withColumn(
        "daily_return_pct", F.when(F.col("weighting_method") == F.col("before.weighting_method"), change)
    ).drop("before")


def industry_fact(daily: DataFrame, dimension: DataFrame) -> DataFrame:
    return with_industry_name(with_daily_return(daily), dimension).select(
        "trade_date", "industry_code", "industry_name", "market", "total_weight_basis",
        "weighted_avg_price", "stock_count", "weighting_method", "daily_return_pct",
    )
