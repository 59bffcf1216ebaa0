"""Landed provider rows to table rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.functions.keys import key_uuid
from barlake.functions.numbers import change_percent, daily_change, to_decimal, zero_as_null
from barlake.operators.quarantine import accepted, accepted_groups, either, with_reasons
from barlake.schemas import BAR_CHANGES, BAR_PRICES, PERCENT, PRICE, QUOTE_SOURCE

_RAW_PRICES = {"open_price": "Open", "close_price": "Close", "high_price": "High", "low_price": "Low"}


def bar_date(ts: Column, zone: str | None = None) -> Column:
    """Calendar date of a bar's own timestamp, in the exchange's zone if one is given."""
    return F.to_date(F.from_utc_timestamp(ts, zone) if zone else ts)


def _out_of_range(raw: Column, narrow: Column) -> Column:
    """A finite number that has no table value. (An infinite price is a missing one.)"""
    return narrow.isNull() & (F.abs(raw) < float("inf")) & ~F.isnan(raw)


def check_bars(raw: DataFrame, zone: str | None = None, keep_ts: bool = False) -> DataFrame:
    """Normalise landed bars; unusable rows carry reasons. ``keep_ts`` keeps each bar's own
    instant, which orders the bars of a day.

    NaN is an error, an infinite or unparsable price is a missing one, a volume of
    zero is a missing one. ``adj_close`` is the close as delivered.
    """
    prices = {name: to_decimal(F.col(source)) for name, source in _RAW_PRICES.items()}
    typed = raw.select(
        "symbol",
        bar_date(F.col("ts"), zone).alias("date"),
        "ts",
        *[p.alias(name) for name, p in prices.items()],
        F.nullif(F.col("Volume"), F.lit(0)).try_cast("bigint").alias("volume"),
        *[F.col(s).try_cast("double").alias(f"_raw_{s}") for s in _RAW_PRICES.values()],
    )
    open_price, close_price = F.col("open_price"), F.col("close_price")
    changed = typed.withColumns(
        {
            "adj_close": close_price,
            "daily_change": daily_change(open_price, close_price).try_cast(PRICE),
            "_percent": change_percent(open_price, close_price),
        }
    )
    nan = [F.isnan(f"_raw_{s}") for s in _RAW_PRICES.values()]
    overflow = [_out_of_range(F.col(f"_raw_{s}"), F.col(n)) for n, s in _RAW_PRICES.items()]
    checked = with_reasons(
        changed.withColumn("daily_change_percent", F.col("_percent").try_cast(PERCENT)),
        ("symbol missing", F.col("symbol").isNull()),
        ("date missing", F.col("date").isNull()),
        ("not a number", either(nan)),
        ("price out of range", either(overflow)),
        (
            "percent out of range",
            F.col("_percent").isNotNull() & F.col("daily_change_percent").isNull(),
        ),
    )
    instant = ["ts"] if keep_ts else []
    return checked.select("symbol", "date", *instant, *BAR_PRICES, "volume", *BAR_CHANGES, "reasons")


def normalize_bars(
    raw: DataFrame, zone: str | None = None, strict_symbol: bool = False, keep_ts: bool = False
) -> DataFrame:
    """Good bars only. ``strict_symbol`` drops every bar of a symbol that has a bad one."""
    checked = check_bars(raw, zone, keep_ts)
    return accepted_groups(checked, "symbol") if strict_symbol else accepted(checked)


def normalize_quotes(raw: DataFrame) -> DataFrame:
    """Landed quotes to price rows; a quote without a usable price is dropped.

    The id is computed from the quote, so a re-run names the same quote the same way.
    """
    instant = F.coalesce("fetched_at", F.current_timestamp())
    typed = raw.select(
        "symbol",
        to_decimal(F.col("last_price")).alias("price"),
        F.col("last_volume").try_cast("bigint").alias("volume"),
        to_decimal(F.col("bid")).alias("bid"),
        to_decimal(F.col("ask")).alias("ask"),
        instant.alias("timestamp"),
        F.lit(QUOTE_SOURCE).alias("source"),
    ).filter(F.col("price").isNotNull())
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in typed.columns]
    return typed.select(key_uuid(*parts).alias("stock_price_id"), *typed.columns)


def normalize_companies(raw: DataFrame) -> DataFrame:
    """Company facts: the long name if there is one, else the short name."""
    name = F.coalesce(F.nullif("longName", F.lit("")), F.nullif("shortName", F.lit("")))
    return raw.select(
        "symbol",
        name.alias("company_name"),
        "sector",
        "industry",
        F.col("marketCap").alias("market_cap"),
        "currency",
    )


def zero_bars_as_null(bars: DataFrame) -> DataFrame:
    """Zero prices and zero changes become NULL, as the bar table stores them.

    Volume keeps its zeros. A flat day has no stored change, so it does not count in
    an average of changes.
    """
    columns = [c for c in (*BAR_PRICES, *BAR_CHANGES) if c in bars.columns]
    return bars.withColumns({c: zero_as_null(F.col(c)) for c in columns})


def zero_quotes_as_null(quotes: DataFrame) -> DataFrame:
    """Zero bid and ask become NULL; a zero price stays."""
    return quotes.withColumns({c: zero_as_null(F.col(c)) for c in ("bid", "ask")})


def with_bar_defaults(bars: DataFrame) -> DataFrame:
    """Fill the id (from symbol and date) where a source brings none."""
    derived = key_uuid(F.col("symbol"), F.col("date"))
    given = F.col("daily_aggregate_id") if "daily_aggregate_id" in bars.columns else F.lit(None)
    return bars.withColumn("daily_aggregate_id", F.coalesce(given.cast("string"), derived))


def with_quote_defaults(quotes: DataFrame, source: str = QUOTE_SOURCE) -> DataFrame:
    """Fill id and source where a source brings none.

    A random id is only drawn for rows without one, and only ingest calls this: the
    result is written before anything else reads it.
    """
    columns = quotes.columns
    given = F.col("stock_price_id").cast("string") if "stock_price_id" in columns else F.lit(None)
    named = F.col("source") if "source" in columns else F.lit(None)
    return quotes.withColumns(
        {
            "stock_price_id": F.coalesce(given.cast("string"), F.uuid()),
            "source": F.coalesce(named.cast("string"), F.lit(source)),
        }
    )


def with_stock_defaults(stocks: DataFrame) -> DataFrame:
    """Fill id (from the symbol) and the active flag where a source brings none."""
    columns = stocks.columns
    given = F.col("stock_id") if "stock_id" in columns else F.lit(None)
    active = F.col("is_active") if "is_active" in columns else F.lit(None)
    return stocks.withColumns(
        {
            "stock_id": F.coalesce(given.cast("string"), key_uuid(F.col("symbol"))),
            "is_active": F.coalesce(active.cast("boolean"), F.lit(True)),
        }
    )


def concat_bars(*parts: DataFrame) -> DataFrame:
    """One frame from per-source frames; columns are matched by name."""
    if not parts:
        raise ValueError("give at least one frame; an empty one still has a schema")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
