"""Named metrics over bars and quotes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from barlake.functions.numbers import exact_avg, exact_total

BAR_METRICS: dict[str, Callable[[], Column]] = {
    "avg_close": lambda: exact_avg(F.col("close_price")),
    "total_volume": lambda: exact_total(F.col("volume")),
    "avg_daily_change": lambda: exact_avg(F.col("daily_change_percent")),
    "count": lambda: F.count(F.lit(1)),
}

# ``latest_price`` is the highest price: the name is kept because dashboards use it.
# ``last_price`` is the price at the latest instant.
PRICE_METRICS: dict[str, Callable[[], Column]] = {
    "latest_price": lambda: F.max("price"),
    "avg_price": lambda: exact_avg(F.col("price")),
    "total_volume": lambda: exact_total(F.col("volume")),
    "last_price": lambda: F.max(F.struct("timestamp", "stock_price_id", "price"))["price"],
}


def pick(metrics: dict[str, Callable[[], Column]], names: list[str] | None = None) -> list[Column]:
    wanted = list(metrics) if names is None else names
    unknown = [n for n in wanted if n not in metrics]
    if unknown:
        raise ValueError(f"unknown metrics: {unknown}")
    return [metrics[n]().alias(n) for n in wanted]
