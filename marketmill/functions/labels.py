"""Labels shown next to indicator and pipeline numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rsi_band(rsi: Column) -> Column:
    return (
        F.when(rsi.isNull(), "n/a")
        .when(rsi > 70, "overbought")
        .when(rsi < 30, "oversold")
        .otherwise("neutral")
    )


def health_band(success_pct: Column) -> Column:
    return F.when(success_pct >= 95, "green").when(success_pct >= 80, "orange").otherwise("red")
