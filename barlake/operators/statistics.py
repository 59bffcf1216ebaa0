"""Grouped statistics and dashboard charts over bars and prices.

All are partial-then-final aggregations: a hot symbol is reduced to one row per input
partition before the shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.functions.keys import instant
from barlake.functions.metrics import BAR_METRICS, PRICE_METRICS, pick
from barlake.functions.numbers import exact_avg, exact_total, report_round


def symbol_stats(bars: DataFrame, symbol: str) -> DataFrame:
    """One row even for an unknown symbol: count 0, the rest NULL."""
    return bars.filter(F.col("symbol") == symbol).agg(
        F.count(F.lit(1)).alias("record_count"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        exact_avg(F.col("close_price")).alias("avg_price"),
        exact_avg(F.col("volume").cast("decimal(20,0)")).alias("avg_volume"),
    )


def all_stats(bars: DataFrame) -> DataFrame:
    return (
        bars.groupBy("symbol")
        .agg(
            F.count(F.lit(1)).alias("record_count"),
            F.min("date").alias("first_date"),
            F.max("date").alias("last_date"),
            report_round(exact_avg(F.col("close_price")), 2).alias("avg_price"),
            report_round(exact_avg(F.col("volume").cast("decimal(20,0)")), 0).alias("avg_volume"),
        )
        .orderBy("symbol")
    )


def performance_summary(bars: DataFrame) -> DataFrame:
    return (
        bars.groupBy("symbol")
        .agg(
            F.min("date").alias("start_date"),
            F.max("date").alias("end_date"),
            report_round(exact_avg(F.col("close_price")), 2).alias("avg_price"),
            report_round(exact_avg(F.col("daily_change_percent")), 4).alias("avg_daily_change"),
        )
        .orderBy(F.desc_nulls_last("avg_daily_change"), "symbol")
    )


def price_trends(bars: DataFrame, limit: int = 1000) -> DataFrame:
    """Average close per day and symbol; the limit keeps the oldest days."""
    return (
        bars.groupBy("date", "symbol")
        .agg(exact_avg(F.col("close_price")).alias("avg_close"))
        .orderBy("date", "symbol")
        .limit(limit)
    )


def trading_volume(bars: DataFrame, limit: int = 1000) -> DataFrame:
    return (
        bars.groupBy("date", "symbol")
        .agg(exact_total(F.col("volume")).alias("total_volume"))
        .orderBy("date", "symbol")
        .limit(limit)
    )


def avg_daily_change(bars: DataFrame) -> DataFrame:
    return bars.agg(exact_avg(F.col("daily_change_percent")).alias("avg_change"))


def avg_daily_change_by_day(bars: DataFrame) -> DataFrame:
    """The same number at its declared one-day grain."""
    return (
        bars.groupBy("date")
        .agg(exact_avg(F.col("daily_change_percent")).alias("avg_change"))
        .orderBy("date")
    )


def top_performers(bars: DataFrame, limit: int = 10) -> DataFrame:
    return (
        bars.groupBy("symbol")
        .agg(
            exact_avg(F.col("daily_change_percent")).alias("avg_change"),
            exact_total(F.col("volume")).alias("total_volume"),
            exact_avg(F.col("close_price")).alias("avg_price"),
        )
        .orderBy(F.desc_nulls_last("avg_change"), "symbol")
        .limit(limit)
    )


def price_range(bars: DataFrame, limit: int = 500) -> DataFrame:
    """Average high and low per day and symbol, cut in (date, symbol) order."""
    return (
        bars.groupBy("date", "symbol")
        .agg(
            exact_avg(F.col("high_price")).alias("avg_high"),
            exact_avg(F.col("low_price")).alias("avg_low"),
        )
        .orderBy("date", "symbol")
        .limit(limit)
    )


def bar_metrics(
    bars: DataFrame, by: list[str] | None = None, names: list[str] | None = None
) -> DataFrame:
    return bars.groupBy(*(by or [])).agg(*pick(BAR_METRICS, names))


def price_metrics(
    prices: DataFrame, by: list[str] | None = None, names: list[str] | None = None
) -> DataFrame:
    return prices.groupBy(*(by or [])).agg(*pick(PRICE_METRICS, names))


def top_by_metric(
    bars: DataFrame, names: list[str], by: str = "symbol", limit: int = 10
) -> DataFrame:
    """The groups with the highest first metric, with all named metrics beside it."""
    ranked = [F.desc_nulls_last(names[0]), by]
    return bar_metrics(bars, [by], names).orderBy(*ranked).limit(limit)


def distinct_symbols(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count_distinct("symbol").alias("symbols"))


def freshness(prices: DataFrame, as_of: dt.datetime, target_seconds: int = 120) -> DataFrame:
    """Seconds from each symbol's last price to ``as_of``, and whether that is in target."""
    lag = F.unix_micros(instant(as_of)) - F.unix_micros("last_timestamp")
    return (
        prices.groupBy("symbol")
        .agg(F.max("timestamp").alias("last_timestamp"))
        .withColumn("lag_seconds", lag / F.lit(1000000.0))
        .withColumn("is_fresh", F.col("lag_seconds") < target_seconds)
    )
