"""News articles of two publishers, cleaned and merged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketmill.functions import articles as A
from marketmill.functions.parsing import stripped


def with_clean_content(articles: DataFrame, markup: str) -> DataFrame:
    """The whole plain content, and its length."""
    plain = A.strip_html(F.col(markup))
    return articles.select(
        *[c for c in articles.columns if c != markup],
        plain.alias("content"),
        F.length(plain).cast("bigint").alias("plain_chars"),
    )


def first_per_id(*sources: DataFrame, position: str = "position") -> DataFrame:
    """One article per id; an earlier source wins, then the lower position within it.

    The winner of each id is found on numbers alone: source and position in one,
    whose minimum is a hash aggregate that combines on the map side, so an id
    repeated very often never gathers in one task and no text is sorted. The
    winners are then joined back to the articles. The position tells the rows
    of a source apart.
    """
    merged = None
    for rank, source in enumerate(sources):
        place = (F.lit(rank).cast("decimal(20,0)") * F.lit("9223372036854775808").cast("decimal(20,0)") + F.col(position).cast("decimal(20,0)")).cast("decimal(38,0)")
        ranked = source.withColumn("place", place)
        merged = ranked if merged is None else merged.unionByName(ranked)
    first = merged.groupBy("article_id").agg(F.min("place").alias("place"))
    return merged.join(first, ["article_id", "place"], "left_semi").drop("place")


def format_feed(articles: DataFrame, run_date: Column) -> DataFrame:
    """Articles of the first publisher, from its nested fields to the common columns; untitled ones go."""
    title = stripped(F.col("title"))
    return with_clean_content(articles.where(title != ""), "markup").select(
        A.article_id(F.col("source_id"), title).alias("article_id"),
        title.alias("title"),
        F.coalesce(stripped(F.col("summary")), F.lit("")).alias("summary"),
        "content", "plain_chars", "url", "position",
        A.published_at(F.col("epoch"), run_date).alias("published_at"),
        F.coalesce("category", F.lit("")).alias("category"),
        F.concat_ws(",", A.distinct_nonempty(F.col("keyword"))).alias("keyword"),
        F.concat_ws(",", A.related_codes(F.col("market"), F.col("products"), F.col("stocks"))).alias("related_stocks"),
        F.lit("feed").alias("source_name"),
        run_date.alias("fetched_date"),
    )


def format_vendor(articles: DataFrame, run_date: Column) -> DataFrame:
    """Articles of the second publisher, which carry a symbol instead of code lists; no title or address, no article."""
    title = stripped(F.col("title"))
    return articles.where((title != "") & (F.col("url") != "")).select(
        A.article_id(F.lit(None).cast("string"), F.col("url")).alias("article_id"),
        title.alias("title"),
        F.coalesce(stripped(F.col("summary")), F.lit("")).alias("summary"),
        F.lit("").alias("content"), F.lit(0).cast("bigint").alias("plain_chars"), "url", "position",
        A.published_at(F.col("epoch"), run_date).alias("published_at"),
        F.lit("tw_stock").alias("category"),
        F.lit("").alias("keyword"),
        F.regexp_replace("symbol", r"\.(TW|TWO)$", "").alias("related_stocks"),
        F.lit("vendor").alias("source_name"),
        run_date.alias("fetched_date"),
    )
