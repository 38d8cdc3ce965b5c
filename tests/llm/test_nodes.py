"""Nodes of the near-duplicate search: whole in one task, and nothing is compared twice."""
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from marketmill.llm import neardup
from marketmill.llm.shared import BATCH_ROWS, MOST_ROWS, prepare, stored

from .conftest import words


def test_a_node_meets_in_one_task_whatever_join_is_below(spark):
    """Without a repartition of its own the rows would be dealt as the join below leaves them, whose partitions Spark may split."""
    prepare(spark)
    rows = spark.range(0, 4000, 1, 8).select((F.col("id") % 40).alias("node"), "id", F.col("id").alias("component"), F.lit(bytes(neardup.HASHES)).alias("sketch"))

    def sizes(batches):
        for node, ids, *_ in neardup._groups(batches):
            yield pa.RecordBatch.from_arrays([pa.array([int(node)]), pa.array([len(ids)])], ["node", "n"])

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        whole = neardup._ordered(neardup.contested(rows))
        plan = whole._jdf.queryExecution().executedPlan().toString()
        got = whole.mapInArrow(sizes, "node long, n long").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "REPARTITION_BY_COL" in plan
    assert sorted((r.node, r.n) for r in got) == [(k, 100) for k in range(40)]


def test_pairs_that_were_confirmed_are_not_open():
    sketch = np.zeros((3, neardup.HASHES), np.uint8)
    sketch[2, :20] = 1
    component = np.array([1, 2, 3])
    assert not neardup.open_members(component, component, sketch).any()
    many = np.zeros((neardup.BEST + 3, neardup.HASHES), np.uint8)
    apart = np.arange(len(many))
    # All take the first ones, which leaves the pairs among the others.
    assert neardup.open_members(apart, apart, many).tolist() == [False] * neardup.BEST + [True] * 3


def test_a_set_is_brought_once_for_nodes_that_share_members(spark, monkeypatch):
    prepare(spark)
    rest = spark.createDataFrame([(node, i, i, bytes(neardup.HASHES)) for node in range(10) for i in (1, 2, 3 + node)] + [(50, 100, 100, bytes(neardup.HASHES)), (50, 101, 101, bytes(neardup.HASHES))], "node long, id long, component long, sketch binary")
    sketches = spark.createDataFrame([(i, 5) for i in [*range(1, 13), 100, 101]], "id long, size long")
    got = neardup.gathered(rest, sketches).groupBy("node").agg(F.sort_array(F.collect_list("id")).alias("ids")).collect()
    assert sorted(r.ids for r in got) == [list(range(1, 13)), [100, 101]]
    monkeypatch.setattr(neardup, "LEAF", 4)
    got = neardup.gathered(rest, sketches).groupBy("node").agg(F.sort_array(F.collect_list("id")).alias("ids")).collect()
    assert sorted(r.ids for r in got) == sorted([[1, 2, 3 + node] for node in range(10)] + [[100, 101]])


def test_confirmed_pairs_bring_no_sets_again(spark, make_docs, monkeypatch):
    """Pairs just under the threshold are decided by the first confirmations."""
    rng, rows = random.Random(8), []
    for k in range(40):
        base = words(rng, 200)
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(base[:170] + words(rng, 30)))]
    seen, plain = {}, neardup.stored

    def stored(df, name, **options):
        seen[name] = plain(df, name, **options)
        return seen[name]

    monkeypatch.setattr(neardup, "stored", stored)
    neardup.near_duplicates(make_docs(rows)).collect()
    assert seen["near-stars"].count() >= 40
    assert seen["near-open"].count() == 0


def test_steps_hand_bounded_batches_to_python(spark):
    before = spark.conf.get(BATCH_ROWS)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    rows = stored(spark.range(0, 25_000, 1, 1).mapInArrow(sizes, "n long"), "batches").collect()
    assert sum(r.n for r in rows) == 25_000 and max(r.n for r in rows) <= MOST_ROWS
    assert spark.conf.get(BATCH_ROWS) == before
