"""Point and range reads, and the filters placed before a dashboard query."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.functions.keys import instant
from barlake.schemas import DEFAULT_SYMBOLS


def stock_by_symbol(stocks: DataFrame, symbol: str) -> DataFrame:
    return stocks.filter(F.col("symbol") == symbol)


def active_symbols(stocks: DataFrame) -> DataFrame:
    """Symbols whose flag is true; an unknown flag is not true."""
    return stocks.filter(F.col("is_active")).select("symbol")


def prices_since(prices: DataFrame, symbol: str, since: dt.datetime) -> DataFrame:
    """Inclusive lower bound, oldest first (ties by id)."""
    wanted = (F.col("symbol") == symbol) & (F.col("timestamp") >= instant(since))
    return prices.filter(wanted).orderBy("timestamp", "stock_price_id")


def bar_at(bars: DataFrame, symbol: str, date: dt.date) -> DataFrame:
    return bars.filter((F.col("symbol") == symbol) & (F.col("date") == F.lit(date)))


def bars_between(bars: DataFrame, symbol: str, start: dt.date, end: dt.date) -> DataFrame:
    """Both ends included, oldest first."""
    wanted = (F.col("symbol") == symbol) & F.col("date").between(F.lit(start), F.lit(end))
    return bars.filter(wanted).orderBy("date")


def in_universe(rows: DataFrame, symbols: list[str] | DataFrame | None = None) -> DataFrame:
    """Rows of the given symbols; none or an empty list means the default five.

    A universe that is itself a table is semi-joined, and the planner broadcasts it
    only if its size allows.
    """
    if isinstance(symbols, DataFrame):
        return rows.join(symbols.select("symbol"), "symbol", "left_semi")
    return rows.filter(F.col("symbol").isin(list(symbols or DEFAULT_SYMBOLS)))


def dashboard_filter(
    bars: DataFrame,
    as_of: dt.date,
    symbols: list[str] | None = None,
    last_days: int | None = 30,
) -> DataFrame:
    """Symbol filter (default all) and the days before ``as_of`` (default 30, None for all).

    Comparisons are on the bare columns, so they prune partitions and reach the scan.
    """
    if symbols:
        bars = bars.filter(F.col("symbol").isin(symbols))
    if last_days is not None:
        start = as_of - dt.timedelta(days=last_days)
        bars = bars.filter((F.col("date") >= F.lit(start)) & (F.col("date") < F.lit(as_of)))
    return bars
