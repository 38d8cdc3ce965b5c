"""As-of joins of stamped rows against a scan in order."""

import random
from datetime import datetime, timedelta

from marketmill.operators import asof

T0 = datetime(2026, 1, 1)


def stamp(k):
    return None if k is None else T0 + timedelta(seconds=k)


def test_latest_before_equals_a_scan(spark):
    rng = random.Random(8)
    records = [(rng.choice([None, *range(40)]) if k % 9 == 0 else rng.randrange(500), k, f"r{k}") for k in range(300)]
    # Very many rows of one moment, targets before any record, and repeated ones.
    records += [(250, 1000 + k, "hot") for k in range(400)]
    targets = [(k, rng.choice([None, -5, 250, *range(0, 520, 3)])) for k in range(700)] + [(1, 250)] * 3
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        r = spark.createDataFrame([(stamp(t), k, n) for t, k, n in records], "ts timestamp, no long, name string")
        t = spark.createDataFrame([(k, stamp(x)) for k, x in targets], "id long, ts timestamp")
        got = asof.latest_before(r, t, "ts", "no")
        assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()
        rows = sorted(str((x.id, x.ts, x.known and (x.known.no, x.known.name))) for x in got.collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = []
    for k, x in targets:
        best = max(((a, b, n) for a, b, n in records if a is not None and x is not None and a <= x), default=None)
        want.append(str((k, stamp(x), best and (best[1], best[2]))))
    assert rows == sorted(want)
    none = asof.latest_before(r.where("false"), t, "ts", "no").collect()
    assert len(none) == len(targets) and all(x.known is None for x in none)
    assert asof.latest_before(r, t.where("false"), "ts", "no").isEmpty()
