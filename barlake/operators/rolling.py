"""Rolling metrics over the last rows (not days) of each symbol."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barlake.session import shared_dir

# Frame lengths in rows.
SHORT = 5
LONG = 20


def _mean(value: Column, window: WindowSpec) -> Column:
    # Exact decimal sum, so the mean does not depend on the order of additions.
    return F.try_divide(F.sum(value).over(window).cast("double"), F.count(value).over(window))


def _metrics(bars: DataFrame, group: list[str], columns: list[str]) -> DataFrame:
    ordered = W.partitionBy(*group).orderBy("date", *columns)
    short, long = ordered.rowsBetween(1 - SHORT, 0), ordered.rowsBetween(1 - LONG, 0)
    change = F.col("daily_change_percent").cast("double")
    return bars.withColumns(
        {
            "ma_5": _mean(F.col("close_price"), short),
            "ma_20": _mean(F.col("close_price"), long),
            "volatility_5": F.stddev_samp(change).over(short),
        }
    )


def rolling_metrics(bars: DataFrame, split_rows: int | None = None) -> DataFrame:
    """ma_5, ma_20 and volatility_5 (sample deviation of the day's change in percent).

    Rows of a symbol are ordered by date, rows of one date by their other columns; a missing
    symbol is a symbol and a missing date comes first. Missing cells are skipped inside a
    frame; one observation has no deviation.

    One shuffle by symbol. Bars are unique per symbol and date, which bounds a symbol by the
    number of days: a century of bars is 36,525 rows. For input without that key,
    ``split_rows`` deals all rows in order to blocks of about that many, whatever symbols and
    dates they share, and each block borrows the rows before it: the results are the same.
    """
    columns = [c for c in bars.columns if c not in ("symbol", "date")]
    if split_rows is None:
        return _metrics(bars, ["symbol"], columns)
    if split_rows < LONG:
        raise ValueError(f"split_rows must be at least {LONG}")

    blocks = max(1, -(-bars.count() // split_rows))
    # Written, so that a lost task cannot deal rows to other blocks than before.
    path = shared_dir(bars.sparkSession, "rolling")
    dealt = bars.repartitionByRange(blocks, "symbol", "date", *columns).withColumn("_block", F.spark_partition_id())
    dealt.write.parquet(path)
    dealt = bars.sparkSession.read.schema(dealt.schema).parquet(path)

    # One row for each symbol and block: where its rows begin and end in the symbol's order.
    in_order = W.partitionBy("symbol").orderBy("_block")
    sizes = dealt.groupBy("symbol", "_block").agg(F.count(F.lit(1)).alias("_rows"))
    placed = sizes.withColumn("_end", F.sum("_rows").over(in_order))
    # A frame reaches back over at most LONG - 1 rows, so over as many blocks at most.
    later = F.collect_list(F.struct(F.col("_block").alias("to"), (F.col("_end") - F.col("_rows")).alias("begin"))).over(
        in_order.rowsBetween(1, LONG - 1)
    )
    followed = placed.select(F.col("symbol").alias("_symbol"), F.col("_block").alias("_from"), "_end", later.alias("_later"))
    newest_first = W.partitionBy("symbol", "_block").orderBy(F.desc("date"), *[F.desc(c) for c in columns])
    tails = dealt.withColumn("_back", F.row_number().over(newest_first)).filter(F.col("_back") < LONG)
    same = F.col("symbol").eqNullSafe(F.col("_symbol")) & (F.col("_block") == F.col("_from"))
    borrowed = (
        tails.join(followed, same)
        .select(*bars.columns, "_back", "_end", F.explode("_later").alias("_next"))
        .filter(F.col("_next.begin") - F.col("_end") + F.col("_back") < LONG)
        .select(*bars.columns, F.col("_next.to").alias("_block"), F.lit(False).alias("_own"))
    )
    whole = dealt.withColumn("_own", F.lit(True)).unionByName(borrowed)
    return _metrics(whole, ["symbol", "_block"], columns).filter("_own").drop("_own", "_block")
