"""As-of joins of any number of stamped rows, without a window over all of them.

Records and targets are sorted together by ranges of their stamp. Each range
carries its last record forward on its own; what a range begins with is the
last record of the ranges before it, one row each, whose running last is added
back by range. So no task sees more than its range, a moment with very many
rows is spread over ranges by the tie, and nothing grows with the table but
the number of ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketmill.session import scratch_path


def latest_before(records: DataFrame, targets: DataFrame, at: str, tie: str) -> DataFrame:
    """Each target with the record of the latest stamp on or before its own; of equal stamps the one with the largest tie.

    Both have a column `at`, records also `tie`. The record comes as a struct
    `known`, null before the first one. A target without a stamp has none, and
    so is its record; a record without a stamp is nobody's.
    """
    spark, asked = targets.sparkSession, targets.columns
    record, target = F.struct(*records.columns), F.struct(*asked)
    kinds = {"known": records.select(record.alias("x")).schema["x"].dataType, "asked": targets.select(target.alias("x")).schema["x"].dataType}
    stamped = records.where(F.col(at).isNotNull()).select(F.col(at).alias("at"), F.lit(0).alias("kind"), F.col(tie).cast("string").alias("spread"), F.col(tie).alias("tie"), record.alias("known"), F.lit(None).cast(kinds["asked"]).alias("asked"))
    # Targets of one moment are spread by their content.
    wanted = targets.select(F.col(at).alias("at"), F.lit(1).alias("kind"), F.hash(*asked).cast("string").alias("spread"), F.lit(None).cast(records.schema[tie].dataType).alias("tie"), F.lit(None).cast(kinds["known"]).alias("known"), target.alias("asked"))
    path = scratch_path(spark, "asof")
    # Records of a moment come in the order of their tie, before its targets.
    order = ["at", "kind", "tie", "spread"]
    stamped.unionByName(wanted).repartitionByRange(*order).withColumn("part", F.spark_partition_id()).write.parquet(path)
    marks = spark.read.parquet(path)
    tails = marks.where("known is not null").groupBy("part").agg(F.max_by("known", F.struct("at", "tie")).alias("tail"))
    # One row per range.
    last, starts = None, []
    found = {r.part: r.tail for r in tails.collect()}
    for part in sorted(r.part for r in marks.select("part").distinct().collect()):
        starts.append((part, last))
        last = found.get(part, last)
    begins = spark.createDataFrame(starts, f"first_part int, start {kinds['known'].simpleString()}")
    within = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = marks.select("part", "kind", "at", "asked", F.last("known", ignorenulls=True).over(within).alias("inner"))
    joined = carried.where("kind = 1").join(begins, F.col("part") == F.col("first_part"), "left")
    known = F.when(F.col("at").isNotNull(), F.coalesce("inner", "start"))
    return joined.select("asked.*", known.alias("known"))
