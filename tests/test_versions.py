"""Versioned tables: what readers see when writers fail or meet."""

import pytest
from pyspark.sql import functions as F

from marketmill.session import scratch_path
from marketmill.sources import versions

SCHEMA = "v long, dt string"


def days(spark, *values, v=1):
    return spark.createDataFrame([(v, d) for d in values for _ in range(3)], SCHEMA)


def seen(spark, root, **only):
    return sorted((r.dt, r.v) for r in versions.read(spark, root, SCHEMA, **only).distinct().collect())


def test_versions_replace_keep_and_drop_partitions(spark):
    root = scratch_path(spark, "table")
    assert versions.newest(spark, root) == (0, {}) and seen(spark, root) == [] and versions.high_water_mark(spark, root) is None
    assert versions.replace(days(spark, "2026-01-01", "2026-01-02"), root) == 1
    assert versions.replace(days(spark, "2026-01-02", "2026-01-03", v=2), root) == 2
    assert seen(spark, root) == [("2026-01-01", 1), ("2026-01-02", 2), ("2026-01-03", 2)]
    assert seen(spark, root, first="2026-01-02", last="2026-01-02") == [("2026-01-02", 2)]
    assert seen(spark, root, version=1) == [("2026-01-01", 1), ("2026-01-02", 1)]
    # A frame may read the table it replaces; a day without rows can be dropped.
    own = versions.read(spark, root, SCHEMA).where("dt > '2026-01-01'").withColumn("v", F.col("v") + 5)
    assert versions.replace(own, root, gone=["2026-01-01"]) == 3
    assert seen(spark, root) == [("2026-01-02", 7), ("2026-01-03", 7)] and versions.high_water_mark(spark, root) == "2026-01-03"
    assert versions.replace(days(spark), root, gone=["2026-01-03"]) == 4 and seen(spark, root) == [("2026-01-02", 7)]
    assert versions.read(spark, root, SCHEMA).count() == 3


def test_partition_values_of_any_text(spark):
    root = scratch_path(spark, "table")
    odd = ["a b", "x/y", "50%", "k=v", "q?", "é", "[1]"]
    versions.replace(days(spark, *odd), root)
    assert [d for d, _ in seen(spark, root)] == sorted(odd)


def test_a_killed_writer_changes_nothing(spark, monkeypatch):
    root = scratch_path(spark, "table")
    versions.replace(days(spark, "2026-01-01", "2026-01-02"), root)
    before = seen(spark, root)
    # A task fails while others have written.
    many = spark.range(0, 4000, numPartitions=8).select(F.col("id").alias("v"), F.lit("2026-01-02").alias("dt"))
    failing = many.withColumn("v", F.when(F.col("v") == 3999, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        versions.replace(failing, root)
    assert seen(spark, root) == before and versions.newest(spark, root)[0] == 1
    # The writer dies with all its files written, before it commits.
    commit = versions._commit
    monkeypatch.setattr(versions, "_commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        versions.replace(days(spark, "2026-01-02", "2026-01-09", v=9), root)
    assert seen(spark, root) == before
    monkeypatch.setattr(versions, "_commit", commit)
    assert versions.replace(days(spark, "2026-01-02", v=4), root) == 2
    assert seen(spark, root) == [("2026-01-01", 1), ("2026-01-02", 4)]


def test_the_second_of_two_writers_fails(spark, monkeypatch):
    root = scratch_path(spark, "table")
    versions.replace(days(spark, "2026-01-01"), root)
    read = versions.newest
    stale = read(spark, root)
    versions.replace(days(spark, "2026-01-02", v=2), root)
    monkeypatch.setattr(versions, "newest", lambda *a: (stale[0], dict(stale[1])))
    with pytest.raises(versions.Conflict):
        versions.replace(days(spark, "2026-01-03", v=3), root)
    monkeypatch.setattr(versions, "newest", read)
    assert seen(spark, root) == [("2026-01-01", 1), ("2026-01-02", 2)]
