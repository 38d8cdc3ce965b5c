"""Files that are set aside: raw files that do not parse, and days that are to be fetched again.

A small table names files by path and time of change; the files themselves stay
where they are. Readers leave named files out, and a day that holds one counts
as not landed, so the backlog asks for it. Landing the day again replaces its
files, which ends the entry by itself: the path and time it names are gone.

What is written grows with the files set aside and never with the lake.
Listings take names and times from the file system and open nothing.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILE = "_file"
MODIFIED = "_modified"

TABLE = "source string, key string, file string, modified timestamp, reason string, records bigint, status string"
REQUEUED = "requeued"
#: What a fetch attempt with such a file counts as.
STATUS = {REQUEUED: "no_data"}
BROKEN_STATUS = "unknown_failure"


def _absent(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def listed(spark: SparkSession, path: str, key: str) -> DataFrame:
    """key, file, modified of all files below a path that lie in a folder of the partition key."""
    try:
        files = spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if not _absent(error):
            raise
        return spark.createDataFrame([], "key string, file string, modified timestamp")
    meta = files.select("_metadata.file_path", "_metadata.file_modification_time").toDF("file", "modified")
    value = F.url_decode(F.regexp_extract("file", f"/{key}=([^/]+)/", 1))
    return meta.select(value.alias("key"), "file", "modified").where(F.col("key") != "")


def entries(spark: SparkSession, table: str) -> DataFrame:
    """All entries; none where the table was never written."""
    try:
        return spark.read.schema(TABLE).parquet(table)
    except AnalysisException as error:
        if not _absent(error):
            raise
        return spark.createDataFrame([], TABLE)


def put(found: DataFrame, table: str) -> None:
    """Add entries; one that is there already is not added again."""
    spark = found.sparkSession
    names = [part.split()[0] for part in TABLE.split(", ")]
    known = entries(spark, table).select("file", "modified", "reason")
    found.select(*names).join(known, ["file", "modified", "reason"], "left_anti").select(*names).write.mode("append").parquet(table)


def current(spark: SparkSession, root: str, source: str, table: str, key: str = "dt") -> DataFrame:
    """Entries of a source whose file still lies there unchanged: key, file, modified, reason."""
    there = listed(spark, f"{root}/{source}", key)
    noted = entries(spark, table).where(F.col("source") == source).select("file", "modified", "reason")
    return there.join(noted, ["file", "modified"]).select("key", "file", "modified", "reason")


def landed(spark: SparkSession, root: str, source: str, table: str, key: str = "dt") -> DataFrame:
    """Days, or instruments, that hold files none of which is set aside."""
    there = listed(spark, f"{root}/{source}", key).select("key").distinct()
    return there.join(current(spark, root, source, table, key).select("key").distinct(), "key", "left_anti").select(F.col("key").alias(key))


def requeue(spark: SparkSession, root: str, source: str, keys: DataFrame, table: str, key: str = "dt") -> None:
    """Set aside all files of some days, so that the backlog lists them again. One row is written for each of these files."""
    files = listed(spark, f"{root}/{source}", key).join(keys.select(F.col(keys.columns[0]).cast("string").alias("key")).distinct(), "key", "left_semi")
    put(files.select(F.lit(source).alias("source"), "key", "file", "modified", F.lit(REQUEUED).alias("reason"), F.lit(None).cast("bigint").alias("records"), F.lit(STATUS[REQUEUED]).alias("status")), table)


def with_file(df: DataFrame) -> DataFrame:
    """The columns of a frame that reads files, with the file of each row."""
    return df.select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_modification_time").alias(MODIFIED))


def without(filed: DataFrame, table: str) -> DataFrame:
    """The rows whose file is not set aside, without the columns of `with_file`."""
    noted = entries(filed.sparkSession, table).select("file", "modified").distinct()
    kept = filed.join(noted, (F.col(FILE) == F.col("file")) & (F.col(MODIFIED) == F.col("modified")), "left_anti")
    return kept.drop(FILE, MODIFIED)
