"""Column expressions that turn raw exchange text into typed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketmill.schemas import MARKET_A, MARKET_B

# What counts as a number, and the direction mark inside its tag.
NUMBER = r"^[+-]?\d+\.?\d*$"
DIRECTION_TAG = r"<p[^>]*>(.*?)</p>"
# White space at either end, the ideographic space included.
OUTER_SPACE = r"^[\s\x0b\x1c-\x1f\x85\p{Z}]+|[\s\x0b\x1c-\x1f\x85\p{Z}]+$"
VENDOR_SUFFIX = {MARKET_A: ".TW", MARKET_B: ".TWO"}
ERA_OFFSET = 1911


def numeric(text: Column, dtype: str) -> Column:
    """Number without thousands separators; null for placeholders and anything that does not fit."""
    plain = F.trim(F.replace(text, F.lit(","), F.lit("")))
    return F.when(plain.rlike(NUMBER), plain.try_cast(dtype))


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, OUTER_SPACE, "")


def direction(markup: Column) -> Column:
    """Text of the first paragraph tag; empty when there is none."""
    return F.trim(F.regexp_extract(markup, DIRECTION_TAG, 1))


def signed_change(mark: Column, amount: Column) -> Column:
    """'-' negates, 'X' (not comparable) clears, every other mark keeps the amount."""
    return F.when(mark == "-", -amount).when(mark.isNull() | (mark != "X"), amount)


def finite_rounded(value: Column, digits: int = 2) -> Column:
    """NaN becomes null, the rest is rounded half up."""
    return F.round(F.when(~F.isnan(value), value), digits)


def epoch_ms_date(millis: Column, zone: str) -> Column:
    """Calendar date of an epoch-millisecond stamp in a named zone, whatever the session zone."""
    since_epoch = F.make_dt_interval(secs=F.floor(millis / 1000))
    utc = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + since_epoch
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc).cast("date")


def compact_date(text: Column) -> Column:
    """Date of an eight-digit yyyyMMdd text; null for impossible dates."""
    return F.try_to_date(F.when(text.rlike(r"^\d{8}$"), text), "yyyyMMdd")


def era_to_iso(text: Column) -> Column:
    """'115/07/09' -> '2026-07-09'."""
    part = F.split(text, "/")
    year = F.get(part, F.lit(0)).try_cast("int") + ERA_OFFSET
    return F.when(
        (F.size(part) == 3) & year.isNotNull(),
        F.concat_ws("-", year.cast("string"), F.get(part, F.lit(1)), F.get(part, F.lit(2))),
    )


def iso_to_era(day: Column) -> Column:
    """2026-07-09 -> '115/07/09'."""
    year = (F.year(day) - ERA_OFFSET).cast("string")
    return F.when(day.isNotNull(), F.concat_ws("/", year, F.date_format(day, "MM"), F.date_format(day, "dd")))


def split_symbol(raw: Column) -> Column:
    """struct(stock_id, market) of a vendor symbol; the market is UNKNOWN without a suffix."""
    symbol = F.upper(stripped(raw))
    suffix = F.regexp_extract(symbol, r"\.TWO?$", 0)
    market = (
        F.when(suffix == VENDOR_SUFFIX[MARKET_A], MARKET_A)
        .when(suffix == VENDOR_SUFFIX[MARKET_B], MARKET_B)
        .otherwise("UNKNOWN")
    )
    return F.struct(F.regexp_replace(symbol, r"\.TWO?$", "").alias("stock_id"), market.alias("market"))


def vendor_symbol(stock_id: Column, market: Column) -> Column:
    """Vendor symbol of an instrument; null (a reject) for a market the vendor does not cover."""
    suffix = F.when(market == MARKET_A, VENDOR_SUFFIX[MARKET_A]).when(market == MARKET_B, VENDOR_SUFFIX[MARKET_B])
    return F.concat(stock_id, suffix)


def id_format(stock_id: Column) -> Column:
    """Shape of an identifier: four digits, five digits, has a letter, or other."""
    return (
        F.when(stock_id.rlike(r"^\d{4}$"), "four_digits")
        .when(stock_id.rlike(r"^\d{5}$"), "five_digits")
        .when(stock_id.rlike("[A-Za-z]"), "has_letter")
        .otherwise("other")
    )
