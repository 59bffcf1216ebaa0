"""Upsert as a plan: reduce the batch to one row per key, then merge it into old rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_row_per_key(
    rows: DataFrame,
    keys: list[str],
    last: list[str],
    first: list[str],
    sequence: str | None = None,
) -> DataFrame:
    """What applying the rows one after another would leave behind.

    ``last`` columns come from the key's last row, ``first`` columns from its first one,
    in ``sequence`` order (rows with equal sequence are ordered by their values, so the
    result is defined; without a sequence the caller makes sure that keys are unique).
    ``_copies`` counts the rows behind each key. The aggregate is
    partial before the shuffle: many copies of one key do not meet in one task.
    """
    order = [F.col(sequence).alias("_seq")] if sequence else []
    newest = F.max(F.struct(*order, *last)).alias("_newest")
    oldest = F.min(F.struct(*order, *last, *first)).alias("_oldest")
    grouped = rows.groupBy(*keys).agg(newest, oldest, F.count(F.lit(1)).alias("_copies"))
    return grouped.select(
        *keys,
        *[F.col(f"_newest.{c}").alias(c) for c in last],
        *[F.col(f"_oldest.{c}").alias(c) for c in first],
        "_copies",
    )


def merge(old: DataFrame, new: DataFrame, keys: list[str], updated: list[str]) -> DataFrame:
    """Old rows with ``updated`` columns replaced where the key recurs, plus the new keys.

    Both sides are unique on the keys. Written as left joins rather than one full outer
    join: a small batch is then broadcast by its size and the old rows are not shuffled.
    """
    columns = old.columns
    replacement = new.select(*keys, F.struct(*updated).alias("_new"))
    hit = F.col("_new").isNotNull()
    kept = old.join(replacement, keys, "left").select(
        *[
            F.when(hit, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in updated else F.col(c)
            for c in columns
        ]
    )
    known = old.select(*keys).join(new.select(*keys), keys, "left_semi")
    added = new.join(known, keys, "left_anti").select(*columns)
    return kept.unionByName(added)


def unseen(rows: DataFrame, target: DataFrame, keys: list[str], shuffled: bool = False) -> DataFrame:
    """Rows whose key is not in the target.

    The target is first cut down to the keys at hand, so a small batch is broadcast to
    it and a large target is not shuffled. ``shuffled`` says that the batch is large,
    whatever the planner takes it for: nothing is broadcast.
    """
    dealt = (lambda frame: frame.hint("merge")) if shuffled else (lambda frame: frame)
    known = target.select(*keys).join(dealt(rows.select(*keys).distinct()), keys, "left_semi")
    return rows.join(dealt(known.distinct()), keys, "left_anti")
