"""Money arithmetic as column expressions.

Two roundings exist and are not interchangeable: values entering the system round
half to even (:func:`to_decimal`), report columns half up (:func:`report_round`).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wide enough to hold any price exactly before it is rounded.
EXACT = "decimal(38,18)"


def exact(value: Column) -> Column:
    """The decimal a number or a numeric text spells, NULL if it spells none."""
    return value.try_cast(EXACT)


def to_decimal(value: Column, places: int = 4, precision: int = 12) -> Column:
    """Parse exactly, round half to even, then narrow; NULL when it does not fit.

    Casting straight to the narrow type would round half up.
    """
    return F.bround(exact(value), places).try_cast(f"decimal({precision},{places})")


def daily_change(open_price: Column, close_price: Column) -> Column:
    """close - open, defined only for a positive open and a non-zero close."""
    return F.when((open_price > 0) & (close_price != 0), close_price - open_price)


def change_percent(open_price: Column, close_price: Column) -> Column:
    """Change in percent of the open, half-even to four places, not yet narrowed.

    The numerator is scaled up first: decimal(22,10) / decimal(12,4) keeps 22 places,
    more than any tie at the fifth place needs to be told apart. Twelve digits before the
    point hold a hundred times the widest change of two prices.
    """
    hundredfold = (daily_change(open_price, close_price) * F.lit(100)).try_cast("decimal(22,10)")
    return F.bround(hundredfold / open_price, 4)


def zero_as_null(value: Column) -> Column:
    return F.nullif(value, F.lit(0).cast("decimal(1,0)"))


def exact_total(count: Column) -> Column:
    """SUM of an integer column, wider than its own type: totals of a large table pass 64 bits."""
    return F.sum(count.cast("decimal(20,0)"))


def exact_avg(value: Column) -> Column:
    """AVG of a decimal column as a double; widen integers to decimal(20,0) first.

    The sum is exact, so the result does not depend on how rows were partitioned;
    Spark's own decimal AVG would cut it to eight places.
    """
    return F.try_divide(F.sum(value).cast("double"), F.count(value))


def report_round(value: Column, places: int) -> Column:
    """SQL ROUND of a double: scale, round half away from zero, scale back.

    Spark's own ``round`` works on the shortest decimal text of the double, which moves
    some ties (1.005 is stored as slightly less and stays 1.00 here).
    """
    scale = F.lit(10.0**places)
    return F.round(value * scale, 0) / scale
