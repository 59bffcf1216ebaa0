"""Batch jobs: daily load, historical metrics, backfill."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.operators.quarantine import accepted, rejected
from barlake.operators.rolling import rolling_metrics
from barlake.operators.statistics import all_stats, performance_summary
from barlake.operators.validate import check_bar_records, clean_nulls
from barlake.session import shared_dir
from barlake.sources.landing import day_bars, history
from barlake.sources.warehouse import Warehouse


@dataclass(frozen=True)
class Report:
    execution_date: dt.date | None
    status: str
    records_loaded: int
    rejected: int = 0


def daily_bars(
    raw: DataFrame, day: dt.date, symbols: list[str] | DataFrame | None = None, zone: str | None = None
) -> DataFrame:
    """The day's first bar of each symbol; symbols without one are absent."""
    return day_bars(raw, day, symbols, zone)


def run_daily_etl(
    warehouse: Warehouse,
    raw: DataFrame,
    day: dt.date,
    symbols: list[str] | DataFrame | None = None,
    zone: str | None = None,
    quarantine: str | None = None,
) -> Report:
    """Extract, validate, load, report. Running a day again replaces its bars.

    The checked rows are staged, so that loading and quarantining read the source once.
    """
    warehouse.create_missing()
    spark = warehouse.spark
    checked = check_bar_records(clean_nulls(daily_bars(raw, day, symbols, zone), ["symbol", "date"]))
    staged = shared_dir(spark, "daily-etl")
    checked.write.parquet(staged)
    checked = spark.read.schema(checked.schema).parquet(staged)

    try:
        total, bad = checked.agg(F.count(F.lit(1)), F.count_if(F.col("reasons") != "")).first()
        if bad and quarantine:
            rejected(checked).write.mode("append").parquet(quarantine)
        loaded = warehouse.upsert_bars(accepted(checked)) if total > bad else 0
    finally:
        warehouse.discard(staged)
    # A day without data loads nothing, as does one of unusable rows: both are skipped.
    status = "success" if loaded else "skipped"
    warehouse.log_run("daily_etl", day, status, loaded)
    return Report(day, status, loaded, bad)


def run_historical_etl(
    raw: DataFrame,
    as_of: dt.date,
    symbols: list[str] | DataFrame | None = None,
    period: str = "1mo",
    zone: str | None = None,
    split_rows: int | None = None,
) -> DataFrame:
    """Bars of a period with rolling metrics; nothing is stored.

    Metrics come before zeros are blanked: a flat day has a change of 0 here. Give
    ``split_rows`` where the landed files may hold a symbol's day many times.
    """
    return rolling_metrics(history(raw, as_of, symbols, period=period, zone=zone), split_rows)


def run_everything(warehouse: Warehouse, raw: DataFrame, as_of: dt.date, symbols: DataFrame | None = None) -> DataFrame:
    """From landed bars to a summary: create the tables, load all bars, compute the rolling
    metrics of what is stored, and give each symbol's statistics with its latest metrics."""
    run_backfill(warehouse, raw, as_of, symbols, "max")
    bars = warehouse.read("daily_aggregates")
    rolled = rolling_metrics(bars).select("symbol", "date", "ma_5", "ma_20", "volatility_5")
    last = rolled.groupBy("symbol").agg(F.max(F.struct("date", "ma_5", "ma_20", "volatility_5")).alias("last"))
    newest = last.select("symbol", "last.ma_5", "last.ma_20", "last.volatility_5")
    return performance_summary(bars).join(all_stats(bars).select("symbol", "record_count", "avg_volume"), "symbol").join(newest, "symbol")


def run_backfill(
    warehouse: Warehouse,
    raw: DataFrame,
    as_of: dt.date,
    symbols: list[str] | DataFrame | None = None,
    period: str = "1mo",
    zone: str | None = None,
) -> dict[str, object]:
    """Load a period of all symbols at once; of a symbol's bars on one day the last counts."""
    warehouse.create_missing()
    bars = history(raw, as_of, symbols, period=period, zone=zone, keep_ts=True)
    loaded = warehouse.upsert_bars(bars, sequence="ts")
    warehouse.log_run("historical_backfill", as_of, "success", loaded)
    return {"status": "success", "period": period, "total_loaded": loaded}
