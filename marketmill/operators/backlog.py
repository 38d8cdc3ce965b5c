"""What still has to be fetched."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def requested_days(spark, start: str, end: str) -> DataFrame:
    bounds = spark.range(1).select(F.lit(start).cast("date").alias("a"), F.lit(end).cast("date").alias("b"))
    return bounds.select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("dt"))


def backlog_days(requested: DataFrame, landed: DataFrame, no_data: DataFrame) -> DataFrame:
    """Requested days that neither landed nor were confirmed to have no data."""
    return requested.join(landed.select("dt"), "dt", "left_anti").join(no_data.select("dt"), "dt", "left_anti")


def day_outcomes(requested: DataFrame, landed: DataFrame, no_data: DataFrame) -> DataFrame:
    """Requested days per outcome; a landed day is skipped even if it is also marked."""
    flagged = (
        requested.select("dt")
        .join(landed.select("dt").distinct().withColumn("landed", F.lit(True)), "dt", "left")
        .join(no_data.select("dt").distinct().withColumn("marked", F.lit(True)), "dt", "left")
    )
    outcome = F.when(F.col("landed"), "skipped").when(F.col("marked"), "no_trading").otherwise("to_do")
    return flagged.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("days"))


def backlog_instruments(official: DataFrame, landed: DataFrame) -> DataFrame:
    return official.select("stock_id").distinct().join(landed.select("stock_id"), "stock_id", "left_anti")

