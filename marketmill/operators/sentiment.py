"""Daily market-sentiment index."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketmill.functions import parsing as P


def history_records(payloads: DataFrame) -> DataFrame:
    """x, y, rating records inside the nested history array."""
    return payloads.select(F.explode("fear_and_greed_historical.data").alias("record")).select("record.*")


def dated_records(records: DataFrame, zone: str) -> DataFrame:
    return records.select(
        P.epoch_ms_date(F.col("x"), zone).cast("string").alias("dt"),
        "x",
        F.col("y").alias("score"),
        F.col("rating").alias("fear_greed_rating"),
    )


def one_per_day(records: DataFrame, zone: str) -> DataFrame:
    """The latest record of every day; of several at that moment the highest score, then the last rating.

    The latest moment is a plain maximum, which combines before the shuffle, so
    a day with very many records still reaches one reducer as a handful of
    rows. Only the records of that moment are then compared in full.
    """
    dated = dated_records(records, zone)
    newest = dated.groupBy(F.col("dt").alias("day")).agg(F.max("x").alias("moment"))
    last = dated.join(newest, F.expr("dt <=> day and x <=> moment"))
    best = F.max(F.struct("score", "fear_greed_rating"))
    daily = last.groupBy("dt").agg(best.alias("latest"))
    return daily.select("dt", F.round("latest.score", 2).alias("score"), "latest.fear_greed_rating")


def as_of(daily: DataFrame, targets: DataFrame) -> DataFrame:
    """For every target date, the newest daily record on or before it, dated to the target.

    Targets before the first record come out with a null score. Works on one
    row per calendar day on both sides: the single ordered pass sees at most
    as many rows as the calendar has days, whatever the size of the raw data.
    """
    marks = daily.select("dt", F.struct("score", "fear_greed_rating").alias("known"))
    asked = targets.select("dt").distinct().withColumn("asked", F.lit(True))
    by_day = marks.join(asked, "dt", "full").select("dt", "known", F.coalesce("asked", F.lit(False)).alias("asked"))
    so_far = Window.orderBy("dt").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = by_day.select("dt", "asked", F.last("known", ignorenulls=True).over(so_far).alias("known"))
    return carried.where("asked").select(
        "dt", F.col("known.score").alias("score"), F.col("known.fear_greed_rating").alias("fear_greed_rating")
    )


def on_day(records: DataFrame, day: str, zone: str) -> DataFrame:
    """The record valid on one day: newest date on or before it, re-dated. Empty when there is none."""
    seen = dated_records(records, zone).where(F.col("dt") <= day)
    newest = seen.orderBy(F.desc("dt"), F.desc("x"), F.desc("score"), F.desc("fear_greed_rating")).limit(1)
    return newest.select(F.lit(day).alias("dt"), F.round("score", 2).alias("score"), "fear_greed_rating")


def stage_sentiment(clean: DataFrame) -> DataFrame:
    return clean.select(
        F.col("dt").cast("date").alias("index_date"),
        F.col("score").alias("fear_greed_score"),
        "fear_greed_rating",
    )


def sentiment_fact(staged: DataFrame) -> DataFrame:
    return staged.select("index_date", "fear_greed_score", "fear_greed_rating")
