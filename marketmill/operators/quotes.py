"""Raw day payloads to unified quotes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketmill import schemas as S
from marketmill.functions import parsing as P

_LONGS_A = ["trade_volume", "transaction_count", "trade_value", "last_bid_volume", "last_ask_volume"]
_DOUBLES_A = [
    "open_price", "high_price", "low_price", "close_price", "last_bid_price", "last_ask_price",
    "pe_ratio", "change_amount",
]
_LONGS_B = [*_LONGS_A, "issued_shares"]
_DOUBLES_B = [
    "close_price", "open_price", "high_price", "low_price", "average_price", "last_bid_price",
    "last_ask_price", "next_day_reference_price", "next_day_limit_up", "next_day_limit_down",
]
OHLC = ["open", "high", "low", "close"]


def with_trade_date(payloads: DataFrame, day: str) -> DataFrame:
    return payloads.withColumn("dt", F.lit(day))


def drop_empty_payloads(payloads: DataFrame) -> DataFrame:
    """Leave out marker objects, which carry no rows."""
    return payloads.where(F.col("data").isNotNull())


def flatten_payloads(payloads: DataFrame, layout: T.StructType) -> DataFrame:
    """One row per inner array; cell i becomes column i of the layout, missing cells are null."""
    kept = drop_empty_payloads(payloads)
    carried = [c for c in kept.columns if c not in ("fields", "data")]
    cells = kept.select(*carried, F.explode("data").alias("cells"))
    named = [F.get("cells", F.lit(i)).alias(name) for i, name in enumerate(layout.names)]
    return cells.select(*carried, *named)


def _parsed(df: DataFrame, longs: list[str], doubles: list[str]) -> dict[str, Column]:
    types = dict.fromkeys(longs, "bigint") | dict.fromkeys(doubles, "double")
    return {c: P.numeric(F.col(c), types[c]) if c in types else F.col(c) for c in df.columns}


def clean_a(rows: DataFrame) -> DataFrame:
    """Typed columns of a layout-A row, plus the direction mark and the signed change."""
    columns = _parsed(rows, _LONGS_A, _DOUBLES_A)
    mark = P.direction(F.col("change_symbol_raw"))
    columns["change_direction"] = mark
    columns["signed_change_amount"] = P.signed_change(mark, columns["change_amount"])
    return rows.select(*[c.alias(name) for name, c in columns.items()])


def clean_b(rows: DataFrame) -> DataFrame:
    """Typed columns of a layout-B row; its change column already carries the sign."""
    columns = _parsed(rows, _LONGS_B, _DOUBLES_B)
    columns["change_amount"] = P.numeric(F.col("change_symbol_raw"), "double")
    return rows.select(*[c.alias(name) for name, c in columns.items()])


def clean_history(records: DataFrame) -> DataFrame:
    """Adjusted prices: NaN (no trade) to null, two decimals."""
    return records.select(
        *[P.finite_rounded(F.col(c)).alias(c) if c in OHLC else F.col(c) for c in records.columns]
    )


def _to_contract(df: DataFrame, given: dict[str, Column]) -> DataFrame:
    """The unified columns in order; what a source lacks is a typed null."""
    return df.select(
        *[given.get(name, F.lit(None)).cast(dtype).alias(name) for name, dtype in S.fields(S.QUOTES)]
    )


def _shared(df: DataFrame, absent: set[str]) -> dict[str, Column]:
    return {n: F.col(n) for n in S.names(S.QUOTES) if n in df.columns and n not in absent}


def unify_a(cleaned: DataFrame) -> DataFrame:
    given = _shared(cleaned, {"average_price", "issued_shares"})
    return _to_contract(
        cleaned, given | {"market": F.lit(S.MARKET_A), "change_amount": F.col("signed_change_amount")}
    )


def unify_b(cleaned: DataFrame) -> DataFrame:
    return _to_contract(cleaned, _shared(cleaned, {"pe_ratio"}) | {"market": F.lit(S.MARKET_B)})


def unify_history(cleaned: DataFrame) -> DataFrame:
    prices = {f"{c}_price": F.col(c) for c in OHLC}
    return _to_contract(
        cleaned,
        prices
        | {
            "dt": F.col("trade_date"),
            "stock_id": F.col("stock_id"),
            "market": F.col("market"),
            "trade_volume": F.col("volume"),
        },
    )


def keep_official(quotes: DataFrame, official: DataFrame) -> DataFrame:
    """Quotes of listed instruments only.

    A semi join, so repeated list entries never repeat a quote and the list
    stays distributed; AQE broadcasts it when it is measured small.
    """
    return quotes.join(official.select("stock_id"), "stock_id", "left_semi").select(*quotes.columns)


def merge_markets(
    cleaned_a: DataFrame, cleaned_b: DataFrame, official_a: DataFrame, official_b: DataFrame
) -> DataFrame:
    """Both exchanges in one table, each filtered with its own list."""
    side_a = keep_official(unify_a(cleaned_a), official_a)
    side_b = keep_official(unify_b(cleaned_b), official_b)
    return side_a.unionByName(side_b)


def merge_sources(*unified: DataFrame) -> DataFrame:
    """Union by name of unified tables that share the contract exactly."""
    expected = S.names(S.QUOTES)
    for part in unified:
        if part.columns != expected:
            raise ValueError(f"not a unified quote table: {part.columns}")
    merged = unified[0]
    for part in unified[1:]:
        merged = merged.unionByName(part)
    return merged


def count_by_market(quotes: DataFrame) -> DataFrame:
    return quotes.groupBy("market").agg(F.count(F.lit(1)).alias("row_count"))


def stage_quotes(clean: DataFrame) -> DataFrame:
    """The 15 columns the marts read, with the partition column as a date."""
    unused = {"last_bid_price", "last_bid_volume", "last_ask_price", "last_ask_volume"}
    kept = [n for n in S.names(S.QUOTES) if n not in unused and n != "dt"]
    return clean.select(F.col("dt").cast("date").alias("trade_date"), *kept)
