"""Which listed instruments have rows on which days.

All days are answered by one plan. Tables of days and of listing dates are
bounded by the calendar, so their running sums stay small. Absences are
intervals of days; for days that are asked for, and for shares of a list, they
are differences of bitmaps (presence.py).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketmill.operators import presence as P


def daily_distinct(quotes: DataFrame) -> DataFrame:
    return quotes.groupBy("market", "dt").agg(F.count_distinct("stock_id").alias("actual_count"))


def listed_as_of(days: DataFrame, universe: DataFrame) -> DataFrame:
    """Instruments of the market with a listing date on or before each day.

    A range join turned into a running sum: listings are counted per date,
    merged with the days, and summed in date order within the market.
    """
    listings = (
        universe.where(F.col("listing_date").isNotNull())
        .groupBy("market", F.col("listing_date").alias("dt"))
        .agg(F.count(F.lit(1)).alias("listed"))
        .withColumn("is_day", F.lit(False))
    )
    marks = days.select("market", "dt").distinct().select("market", "dt", F.lit(0).cast("bigint").alias("listed"), F.lit(True).alias("is_day"))
    by_date = listings.unionByName(marks).groupBy("market", "dt").agg(
        F.sum("listed").alias("listed"), F.max("is_day").alias("is_day")
    )
    so_far = Window.partitionBy("market").orderBy("dt").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = by_date.select("market", "dt", "is_day", F.sum("listed").over(so_far).alias("expected_count"))
    return totals.where("is_day").drop("is_day")


def expected_vs_actual(actual: DataFrame, expected: DataFrame) -> DataFrame:
    joined = actual.join(expected, ["market", "dt"])
    return joined.withColumn("gap", F.col("expected_count") - F.col("actual_count"))


def largest_gaps(gaps: DataFrame, threshold: int = 10) -> DataFrame:
    return gaps.where(F.col("gap") > threshold).orderBy(F.desc("gap"), "market", "dt")


def clean_gap_scan(quotes: DataFrame, universe: DataFrame, threshold: int = 10) -> DataFrame:
    """Days whose instrument count falls short of the listed count by more than the threshold."""
    actual = daily_distinct(quotes)
    return largest_gaps(expected_vs_actual(actual, listed_as_of(actual, universe)), threshold)


def market_days(quotes: DataFrame) -> DataFrame:
    """The days on which a market has rows, numbered in order; the ordered pass sees one row per calendar day."""
    by_day = Window.partitionBy("market").orderBy("dt")
    return quotes.select("market", "dt").distinct().withColumn("day_no", F.row_number().over(by_day))


def _absences(quotes: DataFrame, universe: DataFrame, days: DataFrame, since_listing: bool) -> DataFrame:
    """market, stock_id, company_name, first_no, last_no: runs of days on which a listed instrument has no row.

    An instrument's absences are the holes between the day numbers it does
    have, from its listing to the last day. A series holds at most one mark per
    day, so its window is bounded by the calendar.
    """
    last = days.groupBy("market").agg(F.max("day_no").alias("last_no"))
    listed = universe.select("market", "stock_id", "company_name", "listing_date")
    if since_listing:
        listed = listed.where(F.col("listing_date").isNotNull())
        listed = listed.join(_first_day_no(days, listed), ["market", "listing_date"])
    else:
        listed = listed.withColumn("first_no", F.lit(1))
    listed = listed.join(last, "market").where(F.col("first_no") <= F.col("last_no")).select("market", "stock_id", "company_name", "first_no", "last_no")

    keys = ["market", "stock_id"]
    present = quotes.select(*keys, "dt").distinct().join(days, ["market", "dt"]).select(*keys, "day_no")
    fences = listed.select("*", F.explode(F.array(F.col("first_no") - 1, F.col("last_no") + 1)).alias("day_no"))
    marks = fences.unionByName(present.join(listed, keys).where("day_no >= first_no").select(*fences.columns))
    series = Window.partitionBy(*keys).orderBy("day_no")
    holes = marks.withColumn("next_no", F.lead("day_no").over(series)).where(F.col("next_no") - F.col("day_no") > 1)
    return holes.select(*keys, "company_name", (F.col("day_no") + 1).alias("first_no"), (F.col("next_no") - 1).alias("last_no"))


def absence_intervals(quotes: DataFrame, universe: DataFrame, since_listing: bool = True) -> DataFrame:
    """Runs of days on which a listed instrument is absent while its market has rows: first and last day, and their number."""
    days = market_days(quotes)
    first = days.select("market", F.col("day_no").alias("first_no"), F.col("dt").alias("first_day"))
    last = days.select("market", F.col("day_no").alias("last_no"), F.col("dt").alias("last_day"))
    runs = _absences(quotes, universe, days, since_listing)
    named = runs.join(first, ["market", "first_no"]).join(last, ["market", "last_no"])
    return named.select("market", "stock_id", "company_name", "first_day", "last_day", (F.col("last_no") - F.col("first_no") + 1).cast("bigint").alias("days_absent"))


def missing_on(quotes: DataFrame, universe: DataFrame, asked: DataFrame, since_listing: bool = True) -> DataFrame:
    """One row for each asked day (market, dt) on which the market has rows and each listed instrument absent on it.

    Of the asked days, the bitmap of what is listed is held against the one of
    what is present; nothing but the difference is expanded.
    """
    dictionary = P.numbered(universe.select("market", "stock_id", "company_name", "listing_date"))
    short = quotes.select("market", "stock_id", "dt").join(asked.select("market", "dt").distinct(), ["market", "dt"], "left_semi")
    expected = P.listed_bitmaps(dictionary, short, since_listing)
    return P.absent_ids(expected, P.day_bitmaps(short, dictionary), dictionary).select("market", "dt", "stock_id", "company_name")


def missing_instruments(quotes: DataFrame, universe: DataFrame, since_listing: bool = True) -> DataFrame:
    """Absences of all days, one row each: for small markets; others ask for intervals, or for single days."""
    return missing_on(quotes, universe, quotes.select("market", "dt"), since_listing)


def _first_day_no(days: DataFrame, listed: DataFrame) -> DataFrame:
    """Number of the first day on or after each listing date."""
    dates = listed.select("market", F.col("listing_date").alias("dt")).distinct()
    marks = days.select("market", "dt", "day_no").unionByName(
        dates.withColumn("day_no", F.lit(None).cast("int"))
    )
    by_date = marks.groupBy("market", "dt").agg(F.max("day_no").alias("day_no"))
    before = Window.partitionBy("market").orderBy("dt").rowsBetween(Window.unboundedPreceding, -1)
    numbered = by_date.select(
        "market", F.col("dt").alias("listing_date"),
        (F.coalesce(F.max("day_no").over(before), F.lit(0)) + 1).alias("first_no"),
    )
    return numbered


def raw_gap_scan(quotes: DataFrame, universe: DataFrame, min_missing: int = 1) -> DataFrame:
    """Days with absent instruments: how many are there and how many are missing, days with most absences first.

    Counted from where runs of absence begin and end, without a row per absence.
    """
    days = market_days(quotes)
    ends = _absences(quotes, universe, days, True).select("market", F.explode(F.array(
        F.struct(F.col("first_no").alias("day_no"), F.lit(1).alias("change")), F.struct((F.col("last_no") + 1).alias("day_no"), F.lit(-1).alias("change")),
    )).alias("x")).groupBy("market", "x.day_no").agg(F.sum("x.change").alias("change"))
    so_far = Window.partitionBy("market").orderBy("day_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    missing = days.join(ends, ["market", "day_no"], "left").select("market", "dt", F.sum(F.coalesce("change", F.lit(0))).over(so_far).alias("missing_count"))
    counted = missing.where(F.col("missing_count") >= min_missing).join(daily_distinct(quotes), ["market", "dt"])
    return counted.select("market", "dt", "actual_count", "missing_count").orderBy(F.desc("missing_count"), "market", "dt")


def completeness(
    requested: DataFrame,
    quotes: DataFrame,
    official: DataFrame,
    market: str,
    official_only: bool,
    min_ratio: float = 0.95,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Share of a market's official list present on each requested day.

    With official_only the numerator counts list members only; without it every
    id counts, so the share can pass 1 and hide gaps. A day without rows passes.
    A day that fails has a row for each missing id, any other day one row. With
    `start` and `end` only the partitions between them are read.
    """
    ids = quotes.where(F.col("market") == market).select("market", "dt", "stock_id")
    if start:
        ids = ids.where(F.col("dt") >= F.lit(start).cast("date"))
    if end:
        ids = ids.where(F.col("dt") <= F.lit(end).cast("date"))
    ids = ids.join(requested.select("dt").distinct(), "dt", "left_semi")
    members = P.numbered(official.where(F.col("market") == market).select("market", "stock_id"))
    # Bits are those of list members; a day on which none is present has a bitmap without bits.
    present = P.bitmaps(ids.join(members, ["market", "stock_id"], "left"), "market", "dt")
    size = members.agg(F.count(F.lit(1)).alias("n")).scalar()
    per_day = P.counted(present, "market", "dt", name="present") if official_only else ids.groupBy("market", "dt").agg(F.count_distinct("stock_id").alias("present"))
    judged = (
        requested.select("dt").distinct().join(per_day, "dt", "left")
        .select(
            "market", "dt",
            F.col("present").isNotNull().alias("landed"),
            F.coalesce("present", F.lit(0)).cast("bigint").alias("present"),
            size.alias("official_count"),
        )
        .withColumn("ratio", F.when(F.col("official_count") > 0, F.col("present") / F.col("official_count")).otherwise(1.0))
        .withColumn("passed", ~F.col("landed") | (F.col("ratio") >= min_ratio))
    )
    # A day that fails has rows, and its market from them: with a literal here Spark turns the join by market into a nested loop.
    failed = judged.where(~F.col("passed")).select("market", "dt")
    missing = P.absent_ids(P.listed_bitmaps(members, failed, since_listing=False), present, members).select("dt", F.col("stock_id").alias("missing_id"))
    return judged.drop("market").join(missing, "dt", "left")
