"""Tables that change as a whole: data under new names, one pointer written last.

A table's folder holds its files under `data/{by}={value}/write={id}/`, and
under `versions/` one small file per committed version, which names for each
partition value the write that it belongs to. A write puts its files under an
id of its own, then adds the next version. A reader takes the newest version
and reads exactly the folders that it names. So a writer that is killed leaves
files that no version names, and what readers see is the old or the new table,
never half of either. Partitions that a version does not touch keep their
folders: nothing is copied.

Two writers that add the same version are told apart by name: the file system
creates a version file once, and the writer that comes second fails.
"""

from __future__ import annotations

import json
import uuid
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F



#: Partition column that tells writes apart.
WRITE = "write"


class Conflict(RuntimeError):
    """Another writer committed the version first."""



def newest(spark: SparkSession, root: str) -> tuple[int, dict[str, str]]:
    """Number and parts (partition value to write) of the newest version; 0 and none before the first."""
    try:
        names = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(f"{root}/versions")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0, {}
    # Names are listed, then one file is read.
    last = names.agg(F.max(F.regexp_extract("path", r"/([0-9]+)\.json", 1).cast("long"))).first()[0]
    return (0, {}) if last is None else (last, parts_of(spark, root, last))


def parts_of(spark: SparkSession, root: str, version: int) -> dict[str, str]:
    return json.loads(spark.read.text(f"{root}/versions/{version:012d}.json", wholetext=True).first()[0])


def _commit(spark: SparkSession, root: str, number: int, parts: dict[str, str]) -> None:
    """Create the version file; an existing one is never overwritten."""
    files = spark.sparkContext._jvm.org.apache.hadoop.fs
    path = files.Path(f"{root}/versions/{number:012d}.json")
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fresh = files.Path(f"{root}/versions/_{uuid.uuid4().hex}")
    try:
        out = system.create(fresh, False)
        out.write(bytearray(json.dumps(parts).encode()))
        out.close()
        if system.exists(path) or not system.rename(fresh, path):
            raise Conflict(f"version {number} of {root} exists")
    finally:
        system.delete(fresh, False)


def replace(df: DataFrame, root: str, by: str = "dt", gone: list[str] | None = None) -> int:
    """Replace the partitions that occur in the frame, and drop those in `gone`, as one version; returns its number.

    The frame may read the table that it replaces.
    """
    spark = df.sparkSession
    number, parts = newest(spark, root)
    mine = uuid.uuid4().hex
    df.hint("rebalance", by).withColumn(WRITE, F.lit(mine)).write.mode("append").partitionBy(by, WRITE).parquet(f"{root}/data")
    value = F.url_decode(F.regexp_extract("path", f"/{by}=([^/]+)/", 1))
    try:
        files = spark.read.format("binaryFile").load(f"{root}/data/*/{WRITE}={mine}")
        written = [r[0] for r in files.select(value.alias("v")).distinct().collect()]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":  # no rows, no files
            raise
        written = []
    for key in gone or []:
        parts.pop(key, None)
    parts.update(dict.fromkeys(written, mine))
    _commit(spark, root, number + 1, parts)
    return number + 1


def read(spark: SparkSession, root: str, schema: str, by: str = "dt", first: date | str | None = None, last: date | str | None = None, version: int | None = None) -> DataFrame:
    """The table as of its newest version, or of an older one. `first` and `last` leave out folders of other days before any is listed."""
    parts = newest(spark, root)[1] if version is None else parts_of(spark, root, version)
    within = lambda key: (first is None or str(first) <= key) and (last is None or key <= str(last))
    paths = [f"{root}/data/{by}={_escaped(key)}/{WRITE}={mine}" for key, mine in sorted(parts.items()) if within(key)]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(f"{schema}, {WRITE} string").option("basePath", f"{root}/data").parquet(*paths).drop(WRITE)


def _escaped(value: str) -> str:
    """A partition value as Spark names its folder."""
    return "".join(c if c not in "\"#%'*/:=?\\{[]^\x7f" and ord(c) >= 32 else f"%{ord(c):02X}" for c in value)


def high_water_mark(spark: SparkSession, root: str) -> str | None:
    """Newest partition value of the committed table."""
    return max(newest(spark, root)[1], default=None)
