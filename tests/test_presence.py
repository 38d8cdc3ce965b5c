"""Bitmaps of present instruments against sets."""

import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from marketmill.operators import presence as P
from marketmill.plans import presence
from marketmill.session import scratch_path

D0 = date(2026, 1, 1)


def market(rng, ids, days):
    return {(m, f"{m}{k}", D0 + timedelta(days=d)) for m in ("A", "B") for k in ids for d in days if rng.random() < 0.7}


def frame(spark, rows):
    return spark.createDataFrame([*rows, *list(rows)[:50]], "market string, stock_id string, dt date")


def test_differences_expand_to_the_missing_ids(spark):
    """Numbers reach over several buckets; present ids that are not expected do not matter."""
    rng = random.Random(1)
    rows = market(rng, range(60), range(4))
    ids = spark.createDataFrame(sorted({r[:2] for r in rows}), "market string, stock_id string")
    # Spread the numbers over buckets, edges included.
    spread = P.numbered(ids).withColumn("bit", F.expr("case when bit % 3 = 0 then bit * 700 when bit = 1 then 32768 when bit = 2 then 32769 else bit + 20 end"))
    numbers = spark.createDataFrame(spread.collect(), spread.schema)
    assert numbers.select("market", "bit").distinct().count() == numbers.count()
    quotes = frame(spark, rows)
    present = P.day_bitmaps(quotes, numbers)
    assert {(r.market, r.dt): r.actual_count for r in P.counted(present, "market", "dt").collect()} == {(m, d): len({s for a, s, b in rows if (a, b) == (m, d)}) for m, _, d in rows}
    listed = numbers.where("bit % 5 <> 0")
    members = {(r.market, r.stock_id) for r in listed.collect()}
    days = quotes.select("market", "dt").distinct()
    got = P.absent_ids(P.listed_bitmaps(listed, days, since_listing=False), present, numbers).collect()
    assert sorted((r.market, r.stock_id, r.dt) for r in got) == sorted((m, s, d) for m, s in members for k, d in {(m_, d_) for m_, _, d_ in rows} if k == m and (m, s, d) not in rows)
    whole = P.counted(P.merged(present, "market"), "market", name="n").collect()
    assert {r.market: r.n for r in whole} == {m: len({s for a, s, _ in rows if a == m}) for m in ("A", "B")}


def test_refreshes_read_new_days_and_keep_numbers(spark):
    rng = random.Random(2)
    rows = market(rng, range(20), range(30)) | {("A", "late", D0 + timedelta(days=28)), ("C", "x", D0 + timedelta(days=29))}
    root, numbers = scratch_path(spark, "presence"), {}
    for end in (10, 20, 29):
        upto = {r for r in rows if (r[2] - D0).days <= end}
        # Days before the lookback are gone from the source.
        shown = {r for r in upto if end == 10 or (r[2] - D0).days >= end - 12}
        found = presence.refresh(spark, frame(spark, shown), root, lookback_days=2)
        now = {(r.market, r.stock_id): r.bit for r in presence.dictionary(spark, root).collect()}
        assert numbers.items() <= now.items() and len({(m, b) for (m, _), b in now.items()}) == len(now)
        numbers = now
        counts = {(r.market, r.dt): r.actual_count for r in P.counted(found, "market", "dt").collect()}
        assert counts == {(m, d): len({s for a, s, b in upto if (a, b) == (m, d)}) for m, _, d in upto}
