"""Idempotent writers.

Partitioned writes replace exactly the partitions present in the frame. Rows
are first brought together per partition with a rebalance hint: AQE merges
small partitions into full files and splits an oversized one over several
tasks, which a plain repartition by the column would put into one.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marketmill.operators.quotes import merge_sources

NO_DATA_SUFFIX = "_no_data"


def replace_partitions(df: DataFrame, path: str, by: str = "dt", fmt: str = "parquet") -> None:
    """Overwrite the partitions that occur in the frame; all others stay as they are."""
    (
        df.hint("rebalance", by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(by)
        .format(fmt)
        .save(path)
    )


def replace_observed(df: DataFrame, path: str, days: list[str], markets: list[str], by: str = "dt") -> dict[tuple[str, str], int]:
    """`replace_partitions`, and how many rows of each day and market it wrote, counted while they are written.

    The days are those that a run was asked for; other days are written as
    well, but not counted. Days and markets without rows are left out.
    """
    pairs = [(day, market) for day in days for market in markets]
    seen = Observation()
    counts = [F.count_if((F.col(by).cast("string") == day) & (F.col("market") == market)).alias(f"n{k}") for k, (day, market) in enumerate(pairs)]
    # Counted in the stage that writes, whose tasks count once however often they are tried.
    (
        df.hint("rebalance", by).observe(seen, F.count(F.lit(1)).alias("rows"), *counts)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    )
    found = seen.get
    return {pair: found[f"n{k}"] for k, pair in enumerate(pairs) if found[f"n{k}"]}


def backfill_once(path: str, *unified: DataFrame) -> None:
    """Union all sources, then write once: two writes to one partition would erase each other."""
    replace_partitions(merge_sources(*unified), path)


def replace_snapshot(df: DataFrame, path: str) -> None:
    """Full overwrite of an unpartitioned table; the frame must not read from the same path."""
    df.write.mode("overwrite").parquet(path)


def land_raw(df: DataFrame, root: str, source: str, key: str = "dt") -> None:
    """Write raw records under the lake's path template; landing a partition again replaces it."""
    replace_partitions(df, f"{root}/{source}", by=key, fmt="json")


def load_day(clean: DataFrame, warehouse: str, day: str) -> None:
    """Replace one day of a warehouse table with the clean lake's rows of that day.

    The static partition overwrite also clears the day when there are no rows for it.
    """
    rows = clean.where(F.col("dt") == day).drop("dt")
    rows.write.mode("overwrite").parquet(f"{warehouse}/dt={day}")


def mark_no_data(days: DataFrame, root: str, source: str) -> None:
    """Remember days (dt) confirmed to have no data, beside the source, so that they leave the backlog."""
    confirmed = days.select("dt", F.lit("confirmed_no_trading_day").alias("status"))
    land_raw(confirmed, root, f"{source}{NO_DATA_SUFFIX}")


def append_run_log(rows: DataFrame, path: str) -> DataFrame | None:
    """Append log rows, filed by run date; returns rows that could not be written, to be kept elsewhere, else None.

    A log that cannot be written warns and never fails the caller.
    """
    try:
        dated = rows.withColumn("run_date", F.to_date("run_timestamp"))
        dated.write.mode("append").partitionBy("run_date").parquet(path)
        return None
    except Exception as error:  # noqa: BLE001 - the run itself succeeded
        warnings.warn(f"run log not written: {error}", stacklevel=2)
        return rows


def materialize(df: DataFrame, name: str, layer: str, path: str | None = None, by: str | None = None) -> DataFrame:
    """Publish a model: staging models are views, dimensions and facts are tables in files.

    Returns the frame later models should read.
    """
    spark: SparkSession = df.sparkSession
    if layer == "staging":
        out = df
    elif by:
        replace_partitions(df, path, by)
        out = spark.read.schema(df.schema).parquet(path).select(*df.columns)
    else:
        replace_snapshot(df, path)
        out = spark.read.schema(df.schema).parquet(path)
    out.createOrReplaceTempView(f"{layer}_{name}")
    return out
