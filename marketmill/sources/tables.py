"""Tables of the session catalog: one database per layer, files bucketed by a key.

Tables that are bucketed by the same key into as many buckets are joined,
grouped and windowed by it without a shuffle: each task reads its bucket. An
instrument has one row per day, so a bucket is bounded by the calendar times
the instruments that fall into it; BUCKETS is set to the size of the table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

BUCKETS = 64


def open_layer(spark: SparkSession, layer: str, root: str) -> str:
    """The database of a layer, its folder under the root."""
    spark.sql(f"create database if not exists `{layer}` location '{root}/{layer}'")
    return layer


def publish(df: DataFrame, layer: str, name: str, root: str, key: str = "stock_id", buckets: int = BUCKETS, sort: tuple[str, ...] = ()) -> DataFrame:
    """Write a frame as a bucketed table of the layer, replacing one of that name; returns the table.

    The rows of a bucket are brought together first, so each bucket is one file,
    sorted by the key and `sort`. A new folder is written each time. The frame
    must not read the table that it replaces.
    """
    spark = df.sparkSession
    open_layer(spark, layer, root)
    (
        df.repartition(buckets, key).write.mode("overwrite").format("parquet")
        .bucketBy(buckets, key).sortBy(key, *sort)
        .option("path", f"{root}/{layer}/{name}-{uuid.uuid4().hex}").saveAsTable(f"`{layer}`.`{name}`")
    )
    return spark.table(f"`{layer}`.`{name}`")
