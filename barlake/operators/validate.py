"""Record rules: lengths, decimal places, required fields, ranges, keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from barlake.functions.numbers import exact
from barlake.operators.quarantine import either, with_reasons
from barlake.schemas import (
    BAR_CHANGES,
    BAR_PRICES,
    MAX_COMPANY_NAME,
    MAX_SECTOR,
    MAX_SYMBOL,
    PERCENT,
    PRICE,
)

# Fixed value: a plain decimal number with at most four places, trailing zeros aside.
FOUR_PLACES = r"^\s*[+-]?(\d+\.?\d{0,4}0*|\.\d{1,4}0*)\s*$"
# Fixed value: an integer, possibly written with a zero fraction.
INTEGER_TEXT = r"^\s*[+-]?\d+(\.0+)?\s*$"

Check = tuple[str, Column]


def has_four_places(text: Column) -> Column:
    """Does this numeric text have at most four decimal places? (``1.50000`` does.)

    Plain notation is judged on its digits, because a number with more than 18 places
    would be rounded by parsing it; exponent notation is judged on its value.
    """
    value = exact(text)
    exponent = text.contains("e") | text.contains("E")
    return F.coalesce(
        text.rlike(FOUR_PLACES) | (exponent & (value == F.bround(value, 4))), F.lit(False)
    )


def number_checks(name: str, target: DecimalType) -> list[Check]:
    """Checks for an optional decimal column of any numeric or text type."""
    text = F.col(name).cast("string")
    present = F.col(name).isNotNull()
    parsed = exact(text).isNotNull()
    return [
        (f"{name}: not a number", present & ~parsed),
        (f"{name}: more than 4 places", present & parsed & ~has_four_places(text)),
        (f"{name}: out of range", present & parsed & text.try_cast(target).isNull()),
    ]


def integer_checks(name: str) -> list[Check]:
    text = F.col(name).cast("string")
    bad = ~text.rlike(INTEGER_TEXT) | exact(text).try_cast("bigint").isNull()
    return [(f"{name}: not an integer", F.col(name).isNotNull() & bad)]


def required_checks(*names: str) -> list[Check]:
    return [(f"{n}: missing", F.col(n).isNull()) for n in names]


def length_checks(limits: dict[str, int]) -> list[Check]:
    return [(f"{n}: longer than {m}", F.length(n) > m) for n, m in limits.items()]


def _checked(rows: DataFrame, checks: list[Check], types: dict[str, object]) -> DataFrame:
    """Attach reasons, then cast; text numbers of accepted rows fit their type."""
    casts = {n: F.col(n).cast("string").try_cast(t) for n, t in types.items() if t != "bigint"}
    casts |= {
        n: exact(F.col(n).cast("string")).try_cast("bigint") for n, t in types.items() if t == "bigint"
    }
    return with_reasons(rows, *checks).withColumns(casts)


def check_bar_records(rows: DataFrame) -> DataFrame:
    types: dict[str, object] = {n: PRICE for n in (*BAR_PRICES, "daily_change")}
    types |= {"daily_change_percent": PERCENT, "volume": "bigint"}
    checks = required_checks("symbol", "date") + length_checks({"symbol": MAX_SYMBOL})
    for name in BAR_PRICES + BAR_CHANGES:
        checks += number_checks(name, types[name])
    return _checked(rows, checks + integer_checks("volume"), types)


def check_price_records(rows: DataFrame) -> DataFrame:
    types: dict[str, object] = {n: PRICE for n in ("price", "bid", "ask")} | {"volume": "bigint"}
    checks = required_checks("symbol", "price", "timestamp") + length_checks({"symbol": MAX_SYMBOL})
    for name in ("price", "bid", "ask"):
        checks += number_checks(name, PRICE)
    return _checked(rows, checks + integer_checks("volume"), types)


def check_stock_records(rows: DataFrame) -> DataFrame:
    limits = {"symbol": MAX_SYMBOL, "company_name": MAX_COMPANY_NAME, "sector": MAX_SECTOR}
    return with_reasons(rows, *required_checks("symbol"), *length_checks(limits))


def check_price_range(quotes: DataFrame, cap: float, floor: float = 0.0) -> DataFrame:
    """Stream rule: the price lies strictly between floor and cap."""
    price = F.col("price")
    outside = ~F.coalesce((price > F.lit(floor)) & (price < F.lit(cap)), F.lit(False))
    return with_reasons(quotes, ("price outside range", outside))


def check_bar_shape(bars: DataFrame) -> DataFrame:
    """Open and close lie between low and high wherever all four are known."""
    low, high = F.col("low_price"), F.col("high_price")
    outside = [(F.col(c) < low) | (F.col(c) > high) for c in ("open_price", "close_price")]
    return with_reasons(bars, ("outside low and high", either(outside)))


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their counts (partially aggregated)."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def clean_nulls(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.dropna(subset=keys)


def with_processing_time(rows: DataFrame) -> DataFrame:
    return rows.withColumn("processed_at", F.current_timestamp())
