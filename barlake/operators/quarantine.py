"""Splitting checked rows into accepted and rejected ones.

A check adds one column, ``reasons``: a text that is empty for a good row. Both halves
are plain filters on it. A caller that writes both should stage the checked
frame first, or the source is read twice.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.session import shared_dir

REASONS = "reasons"
SEPARATOR = "; "


def reasons(*checks: tuple[str, Column]) -> Column:
    """Names of the checks whose condition is true (NULL counts as false)."""
    return F.concat_ws(SEPARATOR, *[F.when(bad, F.lit(name)) for name, bad in checks])


def either(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def with_reasons(rows: DataFrame, *checks: tuple[str, Column]) -> DataFrame:
    """Attach ``reasons``.

    The text passes through a one-element ``explode``: a filter on its result stays
    where it is, instead of being pushed below the projections with every check and
    every parsed value written out, and computed, a second time.
    """
    named = rows.withColumn("_why", reasons(*checks))
    return named.select(*rows.columns, F.explode_outer(F.array("_why")).alias(REASONS))


def accepted(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(REASONS) == "").drop(REASONS)


def rejected(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(REASONS) != "")


def accepted_groups(checked: DataFrame, key: str) -> DataFrame:
    """Only rows of groups without a single rejected row.

    The checked rows are written once, so the source is read and checked once for both
    sides. The rejected keys are aggregated per input partition before they are shuffled,
    so a key with very many bad rows travels as one row per partition.
    """
    path = shared_dir(checked.sparkSession, "checked")
    checked.write.parquet(path)
    written = checked.sparkSession.read.schema(checked.schema).parquet(path)
    bad_keys = rejected(written).select(key).distinct()
    return accepted(written).join(bad_keys, key, "left_anti")


def reject_counts(checked: DataFrame) -> DataFrame:
    return (
        rejected(checked)
        .select(F.explode(F.split(REASONS, SEPARATOR)).alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
