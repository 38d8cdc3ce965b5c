"""Date spine, date dimension and date predicates."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANGE_PRESETS = ["1D", "5D", "1M", "6M", "YTD", "1Y", "5Y", "ALL"]


def date_bounds(quotes: DataFrame) -> DataFrame:
    return quotes.agg(F.min("trade_date").alias("min_date"), F.max("trade_date").alias("max_date"))


def date_spine(quotes: DataFrame) -> DataFrame:
    """Every calendar day from the first to the last trade date."""
    days = F.sequence("min_date", "max_date", F.expr("interval 1 day"))
    return date_bounds(quotes).select(F.explode(days).alias("calendar_date"))


def date_dimension(spine: DataFrame) -> DataFrame:
    day = F.col("calendar_date")
    return spine.select(
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
    )


def is_trading_weekday(day: Column) -> Column:
    """Monday to Friday; public holidays are not known here."""
    return F.weekday(day) < 5


def range_start(preset: str, anchor: date, history_start: date = date(2024, 7, 1)) -> date:
    """First day of a named range that ends at the anchor."""
    back = {"1D": 1, "5D": 5, "1M": 30, "6M": 182, "1Y": 365, "5Y": 5 * 365}
    if preset in back:
        return anchor - timedelta(days=back[preset])
    if preset == "YTD":
        return anchor.replace(month=1, day=1)
    if preset == "ALL":
        return history_start
    raise ValueError(f"unknown range: {preset}")


def in_range(df: DataFrame, preset: str, anchor: date, column: str = "trade_date", **kw) -> DataFrame:
    return df.where(F.col(column) >= F.lit(range_start(preset, anchor, **kw)))
