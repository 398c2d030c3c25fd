"""Running rate tables and sliding account activity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def windowed_rates(
    stream: DataFrame, key: str, positive: Column, ts: str = "ts", width: str = "1 hour", delay: str = "2 hours"
) -> DataFrame:
    """Rows, positives and rate per time window and ``key``; a window is emitted once it cannot change."""
    return (
        stream.withWatermark(ts, delay)
        .groupBy(F.window(ts, width).alias("w"), key)
        .agg(F.count(F.lit(1)).alias("transactions"), F.sum(positive.cast("int")).alias("laundering"))
        .select(
            F.col("w.start").alias("window_start"), key, "transactions", "laundering",
            (F.col("laundering") / F.col("transactions")).alias("laundering_rate"),
        )
    )


def sliding_activity(
    stream: DataFrame, account: str, amount: str, ts: str = "ts", width: str = "24 hours", slide: str = "1 hour",
    delay: str = "2 hours",
) -> DataFrame:
    """Rows and amount per account in sliding windows; state leaves with the watermark."""
    return (
        stream.withWatermark(ts, delay)
        .groupBy(F.window(ts, width, slide).alias("w"), account)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(amount).cast("decimal(18,4)")).cast("double").alias("amount"))
        .select(F.col("w.start").alias("window_start"), account, "n", "amount")
    )
