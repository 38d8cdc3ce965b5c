"""What a refresh carries over: the last rows of each key, and digests of the keys of each day.

A snapshot holds every key's last n rows before a day, its `as_of`. With it a
refresh opens the days from `as_of` on and nothing older, however rarely a key
trades; at its end it leaves the snapshot that the next one starts from. Three slots are written in turn, so a table of state stays as small as
three times what one refresh needs: the newest snapshots, and one that lags
up to ANCHOR_DAYS behind, from which days that come late can be recomputed. A snapshot is
void once a later refresh began at an earlier day; where none is left that is
old enough, all rows are read once.

Digests say for each day how many rows and keys it has and how many keys
repeat. A key that names its day can only repeat within it, so a refresh
checks the days it reads and leaves the others to what is noted of them.
"""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SLOTS = 3
ANCHOR_DAYS = 90


class Snapshot(NamedTuple):
    slot: int
    as_of: date
    made: int


def snapshots(spark: SparkSession, path: str) -> list[Snapshot]:
    """The snapshots of a state table, from folder names; SLOTS at most."""
    try:
        files = spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    part = lambda key: F.regexp_extract("path", f"/{key}=([^/]+)/", 1)
    found = files.select(part("slot").cast("int").alias("slot"), part("as_of").cast("date").alias("as_of"), part("made").cast("int").alias("made")).distinct()
    return [Snapshot(*r) for r in found.collect()]


def valid(found: list[Snapshot]) -> list[Snapshot]:
    """Those that no later refresh made void by starting earlier; oldest day first."""
    return sorted((s for s in found if not any(o.made > s.made and o.as_of < s.as_of for o in found)), key=lambda s: (s.as_of, s.made))


def next_slot(found: list[Snapshot], base: Snapshot | None, start: date) -> int:
    """The slot to write a snapshot of `start` to: never the one it is made from."""
    free = set(range(SLOTS)) - {s.slot for s in found}
    if free:
        return min(free)
    good = {s.slot for s in valid(found) if s.as_of <= start}
    others = sorted((s for s in found if base is None or s.slot != base.slot), key=lambda s: (s.as_of, s.made))
    for s in others:
        if s.slot not in good:
            return s.slot
    return others[0].slot if start - others[0].as_of > timedelta(days=ANCHOR_DAYS) else others[-1].slot


def last_rows(rows: DataFrame, keys: list[str], n: int, by: str) -> DataFrame:
    newest_first = Window.partitionBy(*keys).orderBy(F.desc(by))
    return rows.withColumn("nth", F.row_number().over(newest_first)).where(F.col("nth") <= n).drop("nth")


def rows_from(source: DataFrame, start: date, keys: list[str], n: int, path: str, by: str = "trade_date") -> DataFrame:
    """Rows from the start day on and each key's last n rows before it; writes the snapshot of that day if there is none.

    Keys are compared as in a window, so a null key is a key.
    """
    spark, columns = source.sparkSession, source.columns
    found = snapshots(spark, path)
    base = max((s for s in valid(found) if s.as_of <= start), key=lambda s: (s.as_of, s.made), default=None)
    day = F.col(by)
    if base is None or base.as_of != start:
        if base is None:
            before = source.where(day < F.lit(start))
        else:
            carried = spark.read.schema(source.schema).parquet(f"{path}/slot={base.slot}/as_of={base.as_of}/made={base.made}")
            before = carried.unionByName(source.where((day >= F.lit(base.as_of)) & (day < F.lit(start))))
        base = Snapshot(next_slot(found, base, start), start, max((s.made for s in found), default=0) + 1)
        (
            last_rows(before, keys, n, by).withColumn("as_of", F.lit(start)).withColumn("made", F.lit(base.made))
            .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("as_of", "made").parquet(f"{path}/slot={base.slot}")
        )
    current = source.where(day >= F.lit(start))
    try:
        carried = spark.read.schema(source.schema).parquet(f"{path}/slot={base.slot}/as_of={base.as_of}/made={base.made}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":  # no key has a row before the start
            raise
        return current.select(*columns)
    return current.select(*columns).unionByName(carried.select(*columns))


# -- digests ---------------------------------------------------------------

DIGESTS = "trade_date date, n_rows bigint, n_keys bigint, n_repeated bigint, key_sum decimal(38,0), made int"


def key_digests(rows: DataFrame, keys: list[str], by: str = "trade_date") -> DataFrame:
    """For each day: rows whose key has no null, different keys, keys that occur more than once, and the sum of the keys' hashes."""
    present = reduce(and_, [F.col(k).isNotNull() for k in keys])
    per_key = rows.where(present).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy(by).agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_keys"), F.count_if(F.col("n") > 1).alias("n_repeated"),
        F.sum(F.xxhash64(*keys).cast("decimal(38,0)")).alias("key_sum"),
    )


def noted_digests(spark: SparkSession, path: str) -> DataFrame:
    """The newest digest of every day."""
    try:
        noted = spark.read.schema(DIGESTS).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], DIGESTS)
    newest = noted.groupBy("trade_date").agg(F.max_by(F.struct("n_rows", "n_keys", "n_repeated", "key_sum", "made"), "made").alias("d"))
    return newest.select("trade_date", "d.*")


def note_digests(rows: DataFrame, path: str, keys: list[str], lookback_days: int, since: date | None = None, full: bool = False) -> DataFrame:
    """Digest the days from the newest noted one less the lookback on, or from `since`; returns the digests of all days.

    Nothing older is read. `full` digests all days anew and forgets days that are gone.
    """
    spark = rows.sparkSession
    newest = None if full else noted_digests(spark, path).agg(F.max("trade_date"), F.max("made")).first()
    made = 1 if full or newest[1] is None else newest[1] + 1
    if made > 1:
        start = newest[0] - timedelta(days=lookback_days)
        rows = rows.where(F.col("trade_date") >= F.lit(start if since is None else min(start, since)))
    digests = key_digests(rows, keys).withColumn("made", F.lit(made))
    digests.coalesce(1).write.mode("overwrite" if full else "append").parquet(path)
    return noted_digests(spark, path)
