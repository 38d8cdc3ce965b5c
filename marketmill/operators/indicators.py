"""Technical indicators per instrument.

Every window partitions by instrument and orders by day, so one exchange and
one sort serve all of them. The input holds one row per instrument and day
(the unique-key rule in quality.py), which bounds a window partition by the
number of trading days, a few thousand rows, however much an instrument trades.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

# Rows before a day that its values depend on: 19 for the 20-row mean.
HISTORY_ROWS = 19

FACT_COLUMNS = [
    "trade_date", "stock_id", "market", "open_price", "high_price", "low_price", "close_price",
    "average_price", "trade_volume", "trade_value", "transaction_count", "change_amount",
]


def series() -> WindowSpec:
    return Window.partitionBy("stock_id").orderBy("trade_date")


def _mean_of_last(value: Column | str, rows: int) -> Column:
    return F.avg(value).over(series().rowsBetween(1 - rows, Window.currentRow))


def with_prev_close(quotes: DataFrame) -> DataFrame:
    return quotes.withColumn("prior_close", F.lag("close_price").over(series()))


def with_gain_loss(priced: DataFrame) -> DataFrame:
    """Size of the rise and of the fall since the previous row; 0 where either close is missing."""
    change = F.col("close_price") - F.col("prior_close")
    return priced.select(
        "*",
        F.when(change > 0, change).otherwise(0.0).alias("gain"),
        F.when(change < 0, -change).otherwise(0.0).alias("loss"),
    )


def moving_average(quotes: DataFrame, rows: int) -> DataFrame:
    """Mean close of the last n rows; early rows use what there is, null closes are left out."""
    return quotes.withColumn(f"ma{rows}", _mean_of_last("close_price", rows))


def relative_strength(changes: DataFrame, rows: int = 14) -> DataFrame:
    """Simple-mean RSI of the last n rows; 100 when there was no fall."""
    means = changes.select(
        "*", _mean_of_last("gain", rows).alias("mean_gain"), _mean_of_last("loss", rows).alias("mean_loss")
    )
    gain, loss = F.col("mean_gain"), F.col("mean_loss")
    rsi = F.when(loss == 0, 100.0).otherwise(100 * gain / (gain + loss))
    return means.withColumn(f"rsi{rows}", rsi).drop("mean_gain", "mean_loss")


def stock_fact(quotes: DataFrame) -> DataFrame:
    """Quotes with MA5, MA20 and RSI14."""
    changes = with_gain_loss(with_prev_close(quotes.select(*FACT_COLUMNS)))
    measured = relative_strength(moving_average(moving_average(changes, 5), 20))
    return measured.select(*FACT_COLUMNS, "ma5", "ma20", "rsi14")


def latest_vs_previous(quotes: DataFrame) -> DataFrame:
    """Newest close of every instrument and its change against the row before."""
    prior = F.coalesce("prior_close", "close_price")
    newest = F.max_by(F.struct("trade_date", "close_price", prior.alias("prior")), "trade_date")
    return (
        with_prev_close(quotes.select("stock_id", "trade_date", "close_price"))
        .groupBy("stock_id")
        .agg(newest.alias("n"))
        .select(
            "stock_id", "n.trade_date", "n.close_price",
            (F.col("n.close_price") - F.col("n.prior")).alias("close_change"),
        )
    )
