"""What several operators need: tables in the shared folder, files written by tasks, connected components."""

from __future__ import annotations

import ctypes
import os
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketmill.session import scratch_path

#: ASCII white space that separates words everywhere in this package.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"

#: Whether Spark deletes the shuffle files of a query when it ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows that go to Python at once while a step is written: texts and sets of many thousands are held several times over, outside the heap.
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
MOST_ROWS = 2000


def prepare(spark: SparkSession) -> None:
    """Let Python workers that share this machine's files import the package; a cluster ships it with --py-files."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    if root not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, environment.get("PYTHONPATH", "")]))


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write to the shared folder and read back: later work starts there, also after executors are lost."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = {FREE_SHUFFLES: spark.conf.get(FREE_SHUFFLES, "false"), BATCH_ROWS: spark.conf.get(BATCH_ROWS)}
    rows = int(before[BATCH_ROWS])
    # What the step shuffled is freed with its end.
    spark.conf.set(FREE_SHUFFLES, "true")
    spark.conf.set(BATCH_ROWS, str(min(rows, MOST_ROWS) if rows > 0 else MOST_ROWS))
    try:
        df.write.options(**options).parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)


#: What tasks keep in a Python worker for the next task that asks for the same: tokenizers and models with the words they have met.
TABLES: dict = {}


def table(key: str, make: Callable):
    """The table of this key in this worker, made once."""
    if key not in TABLES:
        TABLES[key] = make(key)
    return TABLES[key]


def give_back() -> None:
    """Return to the system what Arrow and the C library hold of freed memory. The C library's call is GNU's; without it the rest is done."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(run: Callable, key: str | None = None) -> Callable:
    """A task's function for workers that stay for other steps: only the table `key` outlives it, and freed memory goes back at its end."""

    def task(batches):
        for other in [k for k in TABLES if k != key]:
            del TABLES[other]
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def small(batches, rows: int = 512):
    """Batches of a few rows: Spark's hold thousands, which as Python objects take many times the space."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def new_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not have, however its own are called."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def without_ids(df: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """The rows whose id (as long) is not in the one-column table `ids`; rows with a null id stay.

    The ids are written first: by their size Spark knows whether the rows have to be shuffled for them.
    """
    mine, theirs = new_name(df, "_mine"), new_name(df, "_theirs")
    keyed = df.withColumn(mine, F.col(id_col).cast("long"))
    return keyed.join(stored(ids.toDF(theirs).distinct(), "without-ids"), F.col(mine) == F.col(theirs), "left_anti").drop(mine)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder for files that tasks write themselves."""
    path = scratch_path(spark, name)
    return path if "://" in path else path.replace("file:", "file://", 1) if path.startswith("file:") else f"file://{os.path.abspath(path)}"


def open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def unique_file(folder: str, suffix: str) -> str:
    """A name that no other attempt of a task uses; only names in a committed manifest are ever read."""
    return f"{folder}/{uuid.uuid4().hex}{suffix}"


def read_files(manifest: DataFrame, reader: Callable[[str], Iterator[pa.RecordBatch]], schema: str, column: str = "file") -> DataFrame:
    """One task per file of a manifest, each read from start to end."""
    names = manifest.select(column)

    def run(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                yield from reader(name)

    n = max(1, names.count())
    return names.repartition(n).mapInArrow(run, schema)


def connected_components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Columns a, b (long) to node, component: the smallest id reachable. Nodes without a link have no row.

    Alternates two steps on the edges until nothing changes: every larger
    neighbour of a node is tied to the node's smallest neighbour, then every
    smaller one. Minima are combined before each shuffle, edges of a hub are
    joined with one row, and each round is written to the shared folder.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    for _ in range(most_rounds):
        both = edges.union(edges.select(F.col("v"), F.col("u")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        # A node with one smaller neighbour stays as it is; only the others are joined again.
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        edges = stored(small, "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components not settled after {most_rounds} rounds")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(edges.select(F.col("v"), F.col("v")).distinct())
