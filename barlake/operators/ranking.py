"""Latest rows, first rows, top movers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_price(prices: DataFrame, symbol: str) -> DataFrame:
    """At most one row; equal instants are decided by id."""
    newest = [F.desc("timestamp"), F.desc("stock_price_id")]
    return prices.filter(F.col("symbol") == symbol).orderBy(*newest).limit(1)


def latest_price_per_symbol(prices: DataFrame) -> DataFrame:
    """An aggregate, not a window: each input partition sends one row per symbol."""
    rest = [c for c in prices.columns if c not in ("timestamp", "stock_price_id", "symbol")]
    newest = F.max(F.struct("timestamp", "stock_price_id", *rest)).alias("newest")
    return prices.groupBy("symbol").agg(newest).select("symbol", "newest.*")


def latest_prices(prices: DataFrame, limit: int = 20) -> DataFrame:
    newest = [F.desc("timestamp"), F.desc("stock_price_id")]
    rows = prices.orderBy(*newest).limit(limit)
    return rows.select("symbol", "price", "volume", "timestamp")


def latest_bars(bars: DataFrame, limit: int = 100) -> DataFrame:
    return bars.orderBy(F.desc("date"), "symbol").limit(limit)


def first_bar_per_symbol(bars: DataFrame) -> DataFrame:
    """The earliest bar of each symbol, by aggregation: by date, by instant if the bars carry
    one (``ts``), ties by the remaining columns."""
    order = [c for c in ("date", "ts") if c in bars.columns]
    rest = [c for c in bars.columns if c not in ("symbol", *order)]
    first = F.min(F.struct(*order, *rest)).alias("first")
    return bars.groupBy("symbol").agg(first).select("symbol", "first.*")


def top_movers(bars: DataFrame, k: int = 10) -> DataFrame:
    """The k largest gains and the k largest losses on each symbol's latest day."""
    latest = F.max(F.struct("date", "daily_change_percent", "close_price")).alias("last")
    moved = (
        bars.groupBy("symbol")
        .agg(latest)
        .select("symbol", "last.*")
        .filter(F.col("daily_change_percent").isNotNull())
    )
    gainers = (
        moved.filter("daily_change_percent > 0")
        .orderBy(F.desc("daily_change_percent"), "symbol")
        .limit(k)
        .withColumn("side", F.lit("gainer"))
    )
    losers = (
        moved.filter("daily_change_percent < 0")
        .orderBy("daily_change_percent", "symbol")
        .limit(k)
        .withColumn("side", F.lit("loser"))
    )
    return gainers.unionByName(losers)
