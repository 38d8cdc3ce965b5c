"""Incremental refresh of the marts.

A refresh rewrites the days from `high-water mark - lookback` on, and nothing
else. What it reads is a separate matter: window values of the first rewritten
days depend on earlier rows. These are carried in a small table of state beside
the mart (state.py), so older days of the source are not opened. The result
equals a full rebuild.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketmill.operators import indicators, industry
from marketmill.plans import state
from marketmill.sources import raw, sinks

STOCK_LOOKBACK_DAYS = 30
OTHER_LOOKBACK_DAYS = 3
#: What the folder of a mart's state is called after the mart.
STATE = "_state"


def high_water_mark(spark: SparkSession, path: str, by: str) -> date | None:
    """Newest date of a written table, from its folder names; None before the first build."""
    newest = raw.partition_values(spark, path, by).agg(F.max(F.col(by).cast("date"))).first()
    return newest[0]


def refresh(
    spark: SparkSession,
    path: str,
    by: str,
    lookback_days: int,
    build_full: Callable[[], DataFrame],
    build_from: Callable[[date], DataFrame],
    since: date | None = None,
    full: bool = False,
    carry: Callable[[date], DataFrame] | None = None,
) -> None:
    """First run, or `full`: everything. Later runs: recompute and replace the days since the lookback.

    `since` is the first day whose source rows changed, where that lies before
    the lookback: days that arrive late are named by it. `carry` leaves the
    state of the day that the next run starts from.
    """
    mark = None if full else high_water_mark(spark, path, by)
    if mark is None:
        sinks.replace_partitions(build_full(), path, by)
    else:
        start = mark - timedelta(days=lookback_days)
        if since is not None:
            start = min(start, since)
        sinks.replace_partitions(build_from(start).where(F.col(by) >= F.lit(start)), path, by)
    if carry is not None and (mark := high_water_mark(spark, path, by)) is not None:
        carry(mark - timedelta(days=lookback_days))


def refresh_stock_fact(
    spark: SparkSession, quotes: DataFrame, path: str, lookback_days: int = STOCK_LOOKBACK_DAYS, since: date | None = None, full: bool = False
) -> None:
    """A late day changes the windows of the rows after it as well, so all days from it on are rewritten."""

    def needed(start: date) -> DataFrame:
        return state.rows_from(quotes.select(*indicators.FACT_COLUMNS), start, ["stock_id"], indicators.HISTORY_ROWS, f"{path}{STATE}")

    refresh(spark, path, "trade_date", lookback_days, lambda: indicators.stock_fact(quotes), lambda start: indicators.stock_fact(needed(start)), since, full, needed)


def refresh_industry_daily(
    spark: SparkSession, quotes: DataFrame, universe: DataFrame, path: str, lookback_days: int = OTHER_LOOKBACK_DAYS, since: date | None = None, full: bool = False
) -> None:
    def build_from(start: date) -> DataFrame:
        return industry.industry_daily(quotes.where(F.col("trade_date") >= F.lit(start)), universe)

    refresh(spark, path, "trade_date", lookback_days, lambda: industry.industry_daily(quotes, universe), build_from, since, full)


def refresh_industry_fact(
    spark: SparkSession, daily: DataFrame, dimension: DataFrame, path: str, lookback_days: int = OTHER_LOOKBACK_DAYS, since: date | None = None, full: bool = False
) -> None:
    """One earlier row per industry and market is carried, for the return of the first rewritten day."""

    def needed(start: date) -> DataFrame:
        return state.rows_from(daily, start, ["industry_code", "market"], 1, f"{path}{STATE}")

    refresh(spark, path, "trade_date", lookback_days, lambda: industry.industry_fact(daily, dimension), lambda start: industry.industry_fact(needed(start), dimension), since, full, needed)


def refresh_rows(
    spark: SparkSession, rows: DataFrame, path: str, by: str, lookback_days: int = OTHER_LOOKBACK_DAYS, since: date | None = None, full: bool = False
) -> None:
    """Refresh of a table whose rows do not depend on other days."""
    refresh(spark, path, by, lookback_days, lambda: rows, lambda start: rows.where(F.col(by) >= F.lit(start)), since, full)
