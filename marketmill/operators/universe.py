"""Official instrument lists, instrument and industry dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketmill import schemas as S
from marketmill.functions import parsing as P


def latest_snapshot(snapshots: DataFrame, partition: str = "dt") -> DataFrame:
    """Rows of the newest dated snapshot; the scalar subquery prunes the other partitions."""
    newest = snapshots.agg(F.max(partition).alias(partition)).scalar()
    return snapshots.where(F.col(partition) == newest)


def clean_list(records: DataFrame, market: str) -> DataFrame:
    """The six used columns of a raw list; an unusable listing date is null."""
    return records.select(
        F.col(S.LIST_ID).alias("stock_id"),
        F.col(S.LIST_COMPANY).alias("company_name"),
        F.col(S.LIST_SHORT_NAME).alias("stock_name"),
        F.col(S.LIST_INDUSTRY).alias("industry_code"),
        P.compact_date(F.col(S.LIST_LISTING_DATE[market])).alias("listing_date"),
        F.lit(market).alias("market"),
    )


def merge_lists(list_a: DataFrame, list_b: DataFrame) -> DataFrame:
    return list_a.unionByName(list_b)


def stage_universe(universe: DataFrame) -> DataFrame:
    return universe.select(*S.names(S.UNIVERSE))


def stock_dimension(universe: DataFrame) -> DataFrame:
    return universe.select(*S.names(S.UNIVERSE))


def industry_dimension(universe: DataFrame, seed: DataFrame) -> DataFrame:
    """Every industry code in use with its name; codes are reduced before the name lookup."""
    codes = universe.where(F.col("industry_code").isNotNull()).select("industry_code").distinct()
    return codes.join(seed, "industry_code", "left").select("industry_code", "industry_name").distinct()


def industry_picker(dimension: DataFrame) -> DataFrame:
    named = dimension.where(F.col("industry_name").isNotNull())
    return named.select("industry_code", "industry_name").distinct().orderBy("industry_code")


def ids_missing_from(left: DataFrame, right: DataFrame) -> DataFrame:
    """Identifiers of the left table that the right one does not have."""
    return left.select("stock_id").distinct().join(right.select("stock_id"), "stock_id", "left_anti")


def id_format_counts(ids: DataFrame) -> DataFrame:
    return ids.groupBy(P.id_format(F.col("stock_id")).alias("id_format")).agg(
        F.count(F.lit(1)).alias("id_count")
    )


def id_length_histogram(rows: DataFrame, subset: str = "is_subset") -> DataFrame:
    """Rows per identifier length, for a subset and its control group."""
    return rows.groupBy(F.col(subset), F.length("stock_id").alias("id_length")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
