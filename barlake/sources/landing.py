"""Provider files landed in a folder: daily bars, live quotes, company facts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barlake.operators.lookups import in_universe
from barlake.operators.normalize import bar_date, normalize_bars, normalize_companies, normalize_quotes
from barlake.operators.ranking import first_bar_per_symbol
from barlake.schemas import RAW_BARS, RAW_COMPANIES, RAW_QUOTES

# The period names a history can be asked for.
PERIODS = {
    "1d": ("days", 1),
    "5d": ("days", 5),
    "1mo": ("months", 1),
    "3mo": ("months", 3),
    "6mo": ("months", 6),
    "1y": ("months", 12),
    "2y": ("months", 24),
    "5y": ("months", 60),
    "10y": ("months", 120),
}
FORMATS = ("parquet", "orc", "csv", "json")


def read_landed(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", streaming: bool = False
) -> DataFrame:
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}")
    reader = (spark.readStream if streaming else spark.read).schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.load(path)


def period_start(period: str, as_of: dt.date) -> dt.date | None:
    """First day of a period that ends at ``as_of``; None means no lower bound."""
    if period == "max":
        return None
    if period == "ytd":
        return as_of.replace(month=1, day=1)
    if period not in PERIODS:
        raise ValueError(f"unknown period: {period}")
    unit, n = PERIODS[period]
    if unit == "days":
        return as_of - dt.timedelta(days=n)
    months = as_of.year * 12 + as_of.month - 1 - n
    first = dt.date(months // 12, months % 12 + 1, 1)
    following = dt.date((months + 1) // 12, (months + 1) % 12 + 1, 1)
    return first.replace(day=min(as_of.day, (following - dt.timedelta(days=1)).day))


def raw_bars_between(
    raw: DataFrame, start: dt.date | None, end: dt.date | None, zone: str | None = None
) -> DataFrame:
    """Bars dated in [start, end). A bound on the bare timestamp, a day wider when the
    exchange is in another zone, lets the scan skip row groups."""
    day = dt.timedelta(days=1 if zone else 0)
    date = bar_date(F.col("ts"), zone)
    if start is not None:
        raw = raw.filter((F.col("ts") >= F.lit(start - day).cast("timestamp")) & (date >= F.lit(start)))
    if end is not None:
        raw = raw.filter((F.col("ts") < F.lit(end + day).cast("timestamp")) & (date < F.lit(end)))
    return raw


def history(
    raw: DataFrame,
    as_of: dt.date,
    symbols: list[str] | DataFrame | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
    period: str = "1mo",
    zone: str | None = None,
    strict_symbol: bool = False,
    keep_ts: bool = False,
) -> DataFrame:
    """Normalised daily bars of the given symbols, all in one scan.

    The dates count only if both are given (end excluded); otherwise the period up to
    and including ``as_of`` does.
    """
    if not (start and end):
        start, end = period_start(period, as_of), as_of + dt.timedelta(days=1)
    wanted = raw_bars_between(in_universe(raw, symbols), start, end, zone)
    return normalize_bars(wanted, zone, strict_symbol, keep_ts)


def day_bars(
    raw: DataFrame, day: dt.date, symbols: list[str] | DataFrame | None = None, zone: str | None = None
) -> DataFrame:
    """The first bar of each symbol on one day; symbols without one are absent."""
    following = day + dt.timedelta(days=1)
    bars = history(raw, day, symbols, day, following, zone=zone, keep_ts=True)
    return first_bar_per_symbol(bars).drop("ts")


def yesterday_bars(
    raw: DataFrame, today: dt.date, symbols: list[str] | DataFrame | None = None, zone: str | None = None
) -> DataFrame:
    return day_bars(raw, today - dt.timedelta(days=1), symbols, zone)


def read_bars(spark: SparkSession, path: str, fmt: str = "parquet", streaming: bool = False) -> DataFrame:
    return read_landed(spark, path, RAW_BARS, fmt, streaming)


def read_quotes(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    symbols: list[str] | DataFrame | None = None,
    streaming: bool = False,
) -> DataFrame:
    """Live quotes; those without a price are dropped."""
    return normalize_quotes(in_universe(read_landed(spark, path, RAW_QUOTES, fmt, streaming), symbols))


def read_companies(
    spark: SparkSession, path: str, symbols: list[str] | DataFrame, fmt: str = "parquet"
) -> DataFrame:
    """Facts per asked symbol; a symbol without a record keeps only its name."""
    known = normalize_companies(read_landed(spark, path, RAW_COMPANIES, fmt))
    if isinstance(symbols, DataFrame):
        asked = symbols.select("symbol").distinct()
    else:
        asked = spark.createDataFrame([(s,) for s in dict.fromkeys(symbols)], "symbol string")
    return asked.join(known, "symbol", "left")
