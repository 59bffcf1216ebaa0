"""The dashboard's charts: a filter, a query, a row limit."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from barlake.operators import statistics
from barlake.operators.lookups import dashboard_filter
from barlake.operators.ranking import latest_prices
from barlake.sources.warehouse import Warehouse

# Chart names and how many rows each shows unless asked otherwise.
ROW_LIMITS = {
    "Stock Price Trends": 1000,
    "Trading Volume": 1000,
    "Average Daily Change": 1,
    "Top Performers": 10,
    "Price Range (High-Low)": 500,
    "Latest Prices": 20,
}

BAR_CHARTS = {
    "Stock Price Trends": statistics.price_trends,
    "Trading Volume": statistics.trading_volume,
    "Average Daily Change": lambda bars, limit: statistics.avg_daily_change(bars),
    "Top Performers": statistics.top_performers,
    "Price Range (High-Low)": statistics.price_range,
}


def bar_chart(
    name: str,
    bars: DataFrame,
    as_of: dt.date,
    symbols: list[str] | None = None,
    last_days: int | None = 30,
    limit: int | None = None,
) -> DataFrame:
    """A chart over bars: symbols and days are filtered first, then the query is run."""
    if name not in BAR_CHARTS:
        raise ValueError(f"unknown chart: {name}")
    rows = ROW_LIMITS[name] if limit is None else limit
    return BAR_CHARTS[name](dashboard_filter(bars, as_of, symbols, last_days), rows)


def stored_bar_chart(
    name: str,
    warehouse: Warehouse,
    as_of: dt.date,
    symbols: list[str] | None = None,
    last_days: int | None = 30,
    limit: int | None = None,
) -> DataFrame:
    """The same over the stored table, reading only the months of the days shown."""
    if last_days is None:
        bars = warehouse.read("daily_aggregates")
    else:
        bars = warehouse.bars(as_of - dt.timedelta(days=last_days), as_of)
    return bar_chart(name, bars, as_of, symbols, last_days, limit)


def latest_prices_chart(
    prices: DataFrame, symbols: list[str] | None = None, limit: int | None = None
) -> DataFrame:
    if symbols:
        prices = prices.filter(prices["symbol"].isin(symbols))
    return latest_prices(prices, ROW_LIMITS["Latest Prices"] if limit is None else limit)
