"""Which instruments have rows on a day, as bitmaps.

A dictionary gives each instrument of a market a number; the instruments
present on a day are bits in buckets of 32,768. Bitmaps of a day are built once
from its quotes; counts and differences of days, and of any range of days, come
from merging bitmaps, without the quotes. Building is an aggregation that
combines before the shuffle, at most 4 KB per market, day and bucket however
many rows a day has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_DIGITS = "123456789ABCDEF"
_NIBBLES = 2 * 4096


def numbered(instruments: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """The instruments (market, stock_id and more) with a number `bit` from 1 on in their market; ids in `known` keep theirs, new ones follow.

    The ordered pass sees one row per instrument.
    """
    ids = instruments.dropDuplicates(["market", "stock_id"])
    order = Window.partitionBy("market").orderBy("stock_id")
    if known is None:
        return ids.withColumn("bit", F.row_number().over(order).cast("bigint"))
    top = known.groupBy("market").agg(F.max("bit").alias("top"))
    new = ids.join(known.select("market", "stock_id"), ["market", "stock_id"], "left_anti").join(top, "market", "left")
    fresh = new.withColumn("bit", F.coalesce("top", F.lit(0)) + F.row_number().over(order)).drop("top")
    return known.unionByName(fresh.select(*known.columns))


def bitmaps(rows: DataFrame, *keys: str) -> DataFrame:
    """keys, bucket, bits of rows that have a number `bit`; rows without one count for no bit, in a bucket that is null."""
    return rows.groupBy(*keys, F.bitmap_bucket_number("bit").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))


def day_bitmaps(quotes: DataFrame, dictionary: DataFrame) -> DataFrame:
    """market, dt, bucket, bits of the instruments in the dictionary."""
    bits = quotes.select("market", "stock_id", "dt").join(dictionary.select("market", "stock_id", "bit"), ["market", "stock_id"])
    return bitmaps(bits, "market", "dt")


def merged(found: DataFrame, *keys: str) -> DataFrame:
    """Bitmaps of any coarser keys: an instrument is there if it is on any day."""
    return found.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def counted(found: DataFrame, *keys: str, name: str = "actual_count") -> DataFrame:
    """How many instruments the bitmaps of each key hold."""
    return found.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))


def listed_bitmaps(dictionary: DataFrame, days: DataFrame, since_listing: bool = True) -> DataFrame:
    """market, dt, bucket, bits of the instruments listed on or before each day; without since_listing of all.

    Listings of a date are one bitmap; merged in the order of dates with the
    days, each day gets what was listed so far. A series holds a row per date.
    """
    wanted = days.select("market", "dt").distinct()
    if not since_listing:
        return wanted.join(bitmaps(dictionary, "market"), "market")
    listings = bitmaps(dictionary.where(F.col("listing_date").isNotNull()).withColumn("dt", F.col("listing_date")), "market", "dt")
    marks = wanted.join(listings.select("market", "bucket").distinct(), "market").withColumn("asked", F.lit(True))
    both = listings.withColumn("asked", F.lit(False)).unionByName(marks.withColumn("bits", F.lit(None).cast("binary")))
    so_far = Window.partitionBy("market", "bucket").orderBy("dt").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    running = both.select("market", "dt", "bucket", "asked", F.bitmap_or_agg("bits").over(so_far).alias("bits"))
    return running.where("asked").drop("asked")


def absent_bits(expected: DataFrame, present: DataFrame) -> DataFrame:
    """market, dt, bit of what is expected on a day and not present on it. Only hexadecimal digits that differ are taken apart."""
    found = present.select("market", "dt", "bucket", F.hex("bits").alias("there"))
    both = expected.select("market", "dt", "bucket", F.hex("bits").alias("wanted")).join(found, ["market", "dt", "bucket"], "left")
    both = both.withColumn("there", F.coalesce("there", F.lit("0" * _NIBBLES))).where("wanted <> there")
    digits = both.select("market", "dt", "bucket", "wanted", "there", F.expr(
        f"explode(filter(sequence(1, {_NIBBLES}), i -> substr(wanted, i, 1) <> '0' and substr(wanted, i, 1) <> substr(there, i, 1))) as i"
    ))
    # The first digit of a byte holds its upper four bits.
    value = lambda text: f"instr('{_DIGITS}', substr({text}, i, 1))"
    apart = digits.select("market", "dt", "bucket", "i", F.expr(f"{value('wanted')} & ~{value('there')}").alias("gone"))
    bits = apart.select("market", "dt", "bucket", "i", "gone", F.explode(F.array(*[F.lit(k) for k in range(4)])).alias("k")).where("(shiftright(gone, k) & 1) = 1")
    place = F.expr("(i - 1) div 2 * 8 + case when i % 2 = 1 then 4 else 0 end + k")
    return bits.select("market", "dt", ((F.col("bucket") - 1) * 32768 + place + 1).alias("bit"))


def absent_ids(expected: DataFrame, present: DataFrame, dictionary: DataFrame) -> DataFrame:
    """market, dt and the columns of the dictionary, for each instrument that is expected and not present."""
    return absent_bits(expected, present).join(dictionary, ["market", "bit"]).drop("bit")
