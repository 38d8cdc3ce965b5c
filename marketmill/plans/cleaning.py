"""Raw lake to clean lake."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketmill import schemas as S
from marketmill.operators import backlog as B
from marketmill.operators import quotes as Q
from marketmill.operators import sentiment as M
from marketmill.operators import universe as U
from marketmill.sources import aside, raw, sinks

SOURCE_A = "quotes_a"
SOURCE_B = "quotes_b"
SOURCE_HISTORY = "instrument_history"
SOURCE_LISTS = {S.MARKET_A: "universe_a", S.MARKET_B: "universe_b"}


def accepted(checked: raw.Checked, table: str) -> DataFrame:
    """The records that fit; files with others are set aside first, so that they stay in the backlog."""
    aside.put(checked.rejects, table)
    return checked.good


def clean_day(
    spark: SparkSession, lake: str, official_a: DataFrame, official_b: DataFrame, day: str, out: str,
    multiline: bool = True, table: str | None = None,
) -> None:
    """One day of both exchanges, parsed, filtered, merged and written to its partition.

    A file that does not parse fails the job, or, with a table, is set aside.
    """
    if table:
        day_a = accepted(raw.checked_quotes(spark, lake, SOURCE_A, multiline=multiline, table=table, day=day), table)
        day_b = accepted(raw.checked_quotes(spark, lake, SOURCE_B, S.RAW_DAY_B, multiline, table=table, day=day), table)
    else:
        day_a = raw.quotes_day(spark, lake, SOURCE_A, day, multiline=multiline)
        day_b = raw.quotes_day(spark, lake, SOURCE_B, day, schema=S.RAW_DAY_B, multiline=multiline)
    merged = Q.merge_markets(
        Q.clean_a(Q.flatten_payloads(day_a, S.RAW_ROW_A)),
        Q.clean_b(Q.flatten_payloads(day_b, S.RAW_ROW_B)),
        official_a,
        official_b,
    )
    sinks.replace_partitions(merged, out)


def backfill_quotes(spark: SparkSession, lake: str, official_a: DataFrame, out: str, multiline: bool = True, table: str | None = None) -> None:
    """All of exchange A's days and every instrument history, in one write.

    A file that does not parse fails the job, or, with a table, is set aside.
    """
    if table:
        days = accepted(raw.checked_quotes(spark, lake, SOURCE_A, multiline=multiline, table=table), table)
        records = accepted(raw.checked_histories(spark, lake, SOURCE_HISTORY, multiline, table), table)
    else:
        days = raw.quotes_history(spark, lake, SOURCE_A, multiline=multiline)
        records = raw.instrument_history(spark, lake, SOURCE_HISTORY, multiline=multiline)
    listed = Q.keep_official(Q.unify_a(Q.clean_a(Q.flatten_payloads(days, S.RAW_ROW_A))), official_a)
    sinks.backfill_once(out, listed, Q.unify_history(Q.clean_history(records)))


def sentiment_day(spark: SparkSession, payload_path: str, day: str, zone: str, out: str, multiline: bool = True) -> None:
    """The sentiment valid on one day, written under that day; an error when nothing is known yet."""
    records = M.history_records(raw.sentiment_payloads(spark, payload_path, multiline))
    row = M.on_day(records, day, zone)
    if row.isEmpty():
        raise ValueError(f"no sentiment on or before {day}")
    sinks.replace_partitions(row, out)


def sentiment_history(spark: SparkSession, payload_path: str, zone: str, out: str, multiline: bool = True) -> None:
    records = M.history_records(raw.sentiment_payloads(spark, payload_path, multiline))
    sinks.replace_partitions(M.one_per_day(records, zone), out)


def universe(spark: SparkSession, lake: str, out: str, multiline: bool = True) -> None:
    """Newest lists of both exchanges, cleaned and merged into one snapshot."""
    lists = [
        U.clean_list(raw.universe_snapshot(spark, lake, SOURCE_LISTS[m], m, multiline), m) for m in S.MARKETS
    ]
    sinks.replace_snapshot(U.merge_lists(*lists), out)


def backlog(spark: SparkSession, lake: str, source: str, start: str, end: str, table: str | None = None) -> DataFrame:
    """Days of a range still to be fetched: not in the lake, not confirmed to have no data.

    A day is confirmed by a marker file in its folder, or in the source's folder
    of confirmed days. A day with a file that the table sets aside has not landed.
    """
    day = F.col("dt").cast("date").alias("dt")
    landed = (aside.landed(spark, lake, source, table) if table else raw.landed_keys(spark, lake, source)).select(day)
    confirmed = raw.landed_keys(spark, lake, f"{source}{sinks.NO_DATA_SUFFIX}").select(day)
    marked = confirmed.unionByName(raw.marked_days(spark, lake, source).select(F.col("dt").cast("date").alias("dt")))
    return B.backlog_days(B.requested_days(spark, start, end), landed, marked)


def official_ids(universe_table: DataFrame, market: str) -> DataFrame:
    return universe_table.where(F.col("market") == market).select("stock_id")
