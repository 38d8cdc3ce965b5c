"""Stored presence: a dictionary of instruments and a bitmap for each market and day.

A refresh reads the days from the lookback on and replaces their folders; ids
it has not seen get the next numbers, so older bitmaps stay as they are.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketmill.operators import presence as P
from marketmill.plans import incremental
from marketmill.sources import sinks

DICTIONARY = "market string, stock_id string, bit bigint"
BITMAPS = "market string, bucket bigint, bits binary, dt date"


def dictionary(spark: SparkSession, root: str) -> DataFrame:
    """Every instrument ever seen and its number."""
    try:
        return spark.read.schema(DICTIONARY).parquet(f"{root}/ids")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], DICTIONARY)


def stored(spark: SparkSession, root: str) -> DataFrame:
    """market, bucket, bits, dt; a filter on dt prunes folders."""
    return spark.read.schema(BITMAPS).parquet(f"{root}/days")


def refresh(spark: SparkSession, quotes: DataFrame, root: str, lookback_days: int, since: date | None = None, full: bool = False) -> DataFrame:
    """Add or replace the bitmaps of the days (dt, a date) since the lookback, or `since`; returns all bitmaps."""
    mark = None if full else incremental.high_water_mark(spark, f"{root}/days", "dt")
    fresh = quotes.select("market", "stock_id", "dt")
    if mark is not None:
        start = mark - timedelta(days=lookback_days)
        fresh = fresh.where(F.col("dt") >= F.lit(start if since is None else min(start, since)))
    known, keys = dictionary(spark, root), ["market", "stock_id"]
    new = P.numbered(fresh.select(*keys).distinct(), known).join(known.select(*keys), keys, "left_anti")
    new.select(*known.columns).write.mode("append").parquet(f"{root}/ids")
    sinks.replace_partitions(P.day_bitmaps(fresh, dictionary(spark, root)), f"{root}/days")
    return stored(spark, root)
