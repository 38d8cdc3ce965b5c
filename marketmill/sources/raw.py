"""Readers of the raw lake.

Layout: {root}/{source}/{key}={value}/data.json, key being dt, stock_id or
range. Every schema is explicit, the partition column included, so folder
values such as 0050 stay text and no file is opened to infer types. Marker
files start with an underscore, which Spark leaves out by itself.

A file that is no JSON, or does not fit its schema, is never read as a day
without rows: readers fail on it, or, where a table for files set aside is
named, `checked_*` give its rows and its rejects as two frames.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketmill import schemas as S
from marketmill.operators.quotes import with_trade_date
from marketmill.sources import aside

#: A file beside a day's data, or in its place, that says that the day has none.
NO_DATA_MARKER = "_no_data_marker.json"


def partition_path(root: str, source: str, key: str, value: str) -> str:
    return f"{root}/{source}/{key}={value}"


#: Column with the text of a record that does not parse.
BROKEN = "_broken"


class Checked(NamedTuple):
    """The records that fit, and the rejects: one row per file and reason, as `aside.put` takes them."""
    good: DataFrame
    rejects: DataFrame


def _json(spark: SparkSession, path: str, schema: str, multiline: bool, glob: str | None = None, mode: str = "FAILFAST") -> DataFrame:
    reader = spark.read.schema(schema).option("multiLine", multiline).option("mode", mode).option("columnNameOfCorruptRecord", BROKEN)
    return (reader.option("pathGlobFilter", glob) if glob else reader).json(path)


def _checked(spark: SparkSession, root: str, source: str, schema: str, multiline: bool, glob: str | None, table: str | None, key: str, value: str | None = None) -> Checked:
    """Records of a source, or of one partition of it, split into those that fit and those that do not.

    Files that `table` names are left out of both. Spark lists no empty files,
    so a day with nothing else has not landed anyway.
    """
    path = partition_path(root, source, key, value) if value is not None else f"{root}/{source}"
    columns = f"{schema}, {BROKEN} string" + ("" if value is not None else f", {key} string")
    read = aside.with_file(_json(spark, path, columns, multiline, glob, "PERMISSIVE"))
    if table:
        kept = read.join(aside.entries(spark, table).select("file", "modified").distinct(), (F.col(aside.FILE) == F.col("file")) & (F.col(aside.MODIFIED) == F.col("modified")), "left_anti")
    else:
        kept = read
    # Both sides ask for every column: a record is judged by those that are read.
    every = F.pmod(F.xxhash64(*[F.col(c) for c in read.columns if c not in (BROKEN, key, aside.FILE, aside.MODIFIED)]), F.lit(2)) >= 0
    kept = kept.where(every)
    good = kept.where(F.col(BROKEN).isNull()).drop(BROKEN, aside.FILE, aside.MODIFIED)
    reason = F.when(F.try_parse_json(F.col(BROKEN)).isNotNull(), "does not fit the schema").otherwise("no JSON")
    folder = F.url_decode(F.regexp_extract(aside.FILE, f"/{key}=([^/]+)/", 1))
    broken = kept.where(F.col(BROKEN).isNotNull()).groupBy(F.col(aside.FILE).alias("file"), F.col(aside.MODIFIED).alias("modified"), folder.alias("key"), reason.alias("reason")).agg(F.count(F.lit(1)).alias("records"))
    rejects = broken.select(F.lit(source).alias("source"), "key", "file", "modified", "reason", "records", F.lit(aside.BROKEN_STATUS).alias("status"))
    return Checked(good, rejects)


def partition_values(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Values of a partition column that hold a file. File names are listed, no file is opened."""
    try:
        files = spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{key} string")
    value = F.regexp_extract("path", f"/{key}=([^/]+)/", 1)
    return files.select(F.url_decode(value).alias(key)).where(F.col(key) != "").distinct()


def marked_days(spark: SparkSession, root: str, source: str, key: str = "dt", marker: str = NO_DATA_MARKER) -> DataFrame:
    """Days whose folder holds a marker that there is no data. One name per day is listed, no file is opened.

    Spark's readers hide names with a leading underscore, so the file system is asked.
    """
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{root}/{source}/{key}=*/{marker}")
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern)
    days = [(f.getPath().getParent().getName().split("=", 1)[1],) for f in found or []]
    return spark.createDataFrame(days, f"{key} string")


def landed_keys(spark: SparkSession, root: str, source: str, key: str = "dt") -> DataFrame:
    """Days, or instruments, that a source has data for."""
    return partition_values(spark, f"{root}/{source}", key)


def quotes_day(spark: SparkSession, root: str, source: str, day: str, schema: str = S.RAW_DAY, multiline: bool = True) -> DataFrame:
    """One day's payload with its date attached; only that folder is listed."""
    payload = _json(spark, partition_path(root, source, "dt", day), schema, multiline)
    return with_trade_date(payload, day)


def quotes_history(
    spark: SparkSession, root: str, source: str, schema: str = S.RAW_DAY, multiline: bool = True, glob: str = "*.json"
) -> DataFrame:
    """All days of a source; dt comes from the folder and prunes like any partition column."""
    return _json(spark, f"{root}/{source}", f"{schema}, dt string", multiline, glob)


def checked_quotes(
    spark: SparkSession, root: str, source: str, schema: str = S.RAW_DAY, multiline: bool = True, glob: str = "*.json", table: str | None = None, day: str | None = None
) -> Checked:
    """All days of a source, or one, with what does not parse kept apart."""
    good, rejects = _checked(spark, root, source, schema, multiline, glob, table, "dt", day)
    return Checked(good if day is None else with_trade_date(good, day), rejects)


def checked_histories(spark: SparkSession, root: str, source: str, multiline: bool = True, table: str | None = None) -> Checked:
    """Histories of all instruments, with what does not parse kept apart."""
    # The folder's id is the record's, so the record's is read.
    schema = S.RAW_HISTORY.replace("stock_id string, ", "")
    return _checked(spark, root, source, schema, multiline, None, table, "stock_id")


def checked_sentiment(spark: SparkSession, root: str, source: str, key: str, value: str, multiline: bool = True, table: str | None = None) -> Checked:
    """The sentiment payloads of one partition, with what does not parse kept apart."""
    return _checked(spark, root, source, S.RAW_SENTIMENT, multiline, None, table, key, value)


def instrument_history(spark: SparkSession, root: str, source: str, multiline: bool = True) -> DataFrame:
    """History records of all instruments; the folder's id equals the record's and stays text."""
    return _json(spark, f"{root}/{source}", S.RAW_HISTORY, multiline)


def sentiment_payloads(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    return _json(spark, path, S.RAW_SENTIMENT, multiline)


def universe_snapshot(spark: SparkSession, root: str, source: str, market: str, multiline: bool = True) -> DataFrame:
    """The newest dated snapshot of an official list; an error when there is none."""
    newest = landed_keys(spark, root, source).agg(F.max("dt")).first()[0]
    if newest is None:
        raise ValueError(f"no snapshot of {source} under {root}")
    columns = [S.LIST_ID, S.LIST_COMPANY, S.LIST_SHORT_NAME, S.LIST_INDUSTRY, S.LIST_LISTING_DATE[market], "dt"]
    schema = ", ".join(f"`{c}` string" for c in columns)
    return _json(spark, f"{root}/{source}", schema, multiline).where(F.col("dt") == newest)


def seed_codes(spark: SparkSession, path: str) -> DataFrame:
    """Code -> name lookup; codes are text, so leading zeros stay."""
    return spark.read.schema(S.SEED_CODES).option("header", True).csv(path)


def clean_quotes(spark: SparkSession, path: str, market: str | None = None, table: str | None = None) -> DataFrame:
    """Unified quotes of the clean lake; dt prunes folders, the market filter reaches the file scan. Files that `table` sets aside are left out."""
    quotes = spark.read.schema(S.QUOTES).parquet(path)
    if table:
        quotes = aside.without(aside.with_file(quotes), table)
    return quotes.where(F.col("market") == market) if market else quotes


def clean_sentiment(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.CLEAN_SENTIMENT).parquet(path)


def clean_universe(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.UNIVERSE).parquet(path)
