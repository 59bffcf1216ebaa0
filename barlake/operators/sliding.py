"""Sliding-window price statistics, the same for a table and for a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sliding_stats(
    quotes: DataFrame,
    width: str = "5 minutes",
    slide: str = "1 minute",
    watermark: str = "1 minute",
) -> DataFrame:
    """Average, lowest, highest price and number of quotes per symbol and window.

    Each row is expanded into its windows and aggregated within its input partition
    before the shuffle, so a hot symbol sends one row per window and partition.
    """
    return (
        quotes.withWatermark("timestamp", watermark)
        .groupBy("symbol", F.window("timestamp", width, slide))
        .agg(
            F.avg("price").alias("avg_price"),
            F.min("price").alias("min_price"),
            F.max("price").alias("max_price"),
            F.count(F.lit(1)).alias("trade_count"),
        )
    )


def flat_windows(stats: DataFrame) -> DataFrame:
    """Window bounds as columns, for sinks without nested types."""
    bounds = [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")]
    return stats.select("symbol", *bounds, *[c for c in stats.columns if c not in ("symbol", "window")])
