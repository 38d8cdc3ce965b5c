"""Task run log and its health figures. The anchor stands for 'now'."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketmill.functions.labels import health_band

WINDOW_DAYS = 30


def run_rows(runs: DataFrame) -> DataFrame:
    """Log rows of task runs; the duration is null until both ends are known."""
    seconds = (F.unix_micros(F.col("end_time").cast("timestamp")) - F.unix_micros(F.col("start_time").cast("timestamp"))) / 1e6
    return runs.select(
        "run_timestamp", "dag_id", "task_id", "target_date", "status", "row_count",
        seconds.alias("duration_seconds"),
    )


def recent(log: DataFrame, anchor: datetime) -> DataFrame:
    since = F.lit(str(anchor - timedelta(days=WINDOW_DAYS))).cast(log.schema["run_timestamp"].dataType)
    return log.where(F.col("run_timestamp") >= since)


def _pct(part: Column, whole: Column) -> Column:
    return F.round(part / whole * 100, 1)


def success_summary(log: DataFrame, anchor: datetime) -> DataFrame:
    runs, ok = F.count(F.lit(1)), F.count_if(F.col("status") == "success")
    return (
        recent(log, anchor)
        .groupBy("dag_id", "task_id")
        .agg(
            runs.alias("total_runs"), ok.alias("success_runs"), _pct(ok, runs).alias("success_rate_pct"),
            F.round(F.avg("duration_seconds"), 1).alias("avg_duration_sec"),
        )
        .orderBy("dag_id", "task_id")
    )


def overall_kpi(summary: DataFrame) -> DataFrame:
    return summary.agg(
        _pct(F.sum("success_runs"), F.sum("total_runs")).alias("success_rate_pct"),
        F.sum("total_runs").alias("total_runs"),
        F.count_distinct("task_id").alias("task_count"),
    )


def daily_trend(log: DataFrame, anchor: datetime) -> DataFrame:
    return (
        recent(log, anchor)
        .groupBy(F.to_date("run_timestamp").alias("run_date"), "status")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .orderBy("run_date", "status")
    )


def with_health_band(summary: DataFrame) -> DataFrame:
    return summary.withColumn("health", health_band(F.col("success_rate_pct")))


def partition_runs(quotes: DataFrame, dag_id: str, task_id: str, run_timestamp: datetime, ended: datetime | None = None) -> DataFrame:
    """One log row per day and market of a written table, for a single append; the run lasted from its stamp to its end."""
    seconds = (ended - run_timestamp).total_seconds() if ended else None
    return quotes.groupBy(F.col("dt").cast("date").alias("target_date"), "market").agg(
        F.count(F.lit(1)).alias("row_count")
    ).select(
        F.lit(str(run_timestamp)).cast("timestamp").alias("run_timestamp"), F.lit(dag_id).alias("dag_id"),
        F.concat_ws(".", F.lit(task_id), "market").alias("task_id"), "target_date",
        F.lit("success").alias("status"), "row_count", F.lit(seconds).cast("double").alias("duration_seconds"),
    )


def observed_runs(spark: SparkSession, counts: dict[tuple[str, str], int], dag_id: str, task_id: str, run_timestamp: datetime, ended: datetime | None = None) -> DataFrame:
    """The same log rows from counts taken while the table was written: nothing is read again."""
    rows = spark.createDataFrame([(day, market, n) for (day, market), n in counts.items()], "day string, market string, row_count bigint")
    seconds = (ended - run_timestamp).total_seconds() if ended else None
    return rows.select(
        F.lit(str(run_timestamp)).cast("timestamp").alias("run_timestamp"), F.lit(dag_id).alias("dag_id"),
        F.concat_ws(".", F.lit(task_id), "market").alias("task_id"), F.col("day").cast("date").alias("target_date"),
        F.lit("success").alias("status"), "row_count", F.lit(seconds).cast("double").alias("duration_seconds"),
    )
