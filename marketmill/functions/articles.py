"""Column expressions for news articles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketmill.functions.parsing import stripped

# Product-list segments that are not instrument codes.
NOT_CODES = ["US", "USS", "TW", "TWS", "STOCK", "COMMON", "ETF"]


def strip_html(markup: Column) -> Column:
    """Text with tags removed and outer white space trimmed."""
    return stripped(F.regexp_replace(F.coalesce(markup, F.lit("")), "<[^>]+>", ""))


def article_id(source_id: Column, fallback: Column) -> Column:
    """The publisher's id, or the whole hash of title or address: a prefix of it would in time merge unrelated articles."""
    return F.coalesce(F.nullif(source_id, F.lit("")), F.md5(fallback))


def published_at(epoch_seconds: Column, run_date: Column) -> Column:
    """ISO stamp in UTC; the run date when the publisher gave no time."""
    utc = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=F.floor(epoch_seconds))
    return F.when(
        epoch_seconds > 0, F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    ).otherwise(run_date)


def distinct_nonempty(items: Column) -> Column:
    """Items in first-seen order without repeats, nulls and empty strings."""
    return F.array_distinct(F.filter(F.coalesce(items, F.array().cast("array<string>")), lambda x: x != ""))


def listed_codes(listings: Column) -> Column:
    """Codes of array<struct<code,...>>."""
    return F.transform(listings, lambda item: item["code"])


def product_codes(products: Column) -> Column:
    """Second ':' segment of each product string, without segments that are not codes."""
    second = F.transform(products, lambda p: F.trim(F.get(F.split(p, ":"), F.lit(1))))
    return F.filter(second, lambda code: ~code.isin(NOT_CODES))


def related_codes(listings: Column, products: Column, dashed: Column) -> Column:
    """Instruments an article is about, from its three code fields.

    A dash in the third field counts as the ':X:' of a product string.
    """
    none = F.array().cast("array<string>")
    dashed_products = F.transform(dashed, lambda s: F.replace(s, F.lit("-"), F.lit(":X:")))
    return distinct_nonempty(
        F.concat(
            F.coalesce(listed_codes(listings), none),
            F.coalesce(product_codes(products), none),
            F.coalesce(product_codes(dashed_products), none),
        )
    )
