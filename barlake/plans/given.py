"""The given tables read as raw bars, quotes, stocks and topic messages.

Only an adapter: the tables hold orders and events, not markets. Each shape is raw
provider data, which the operators then normalise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.functions.numbers import to_decimal
from barlake.operators.normalize import normalize_bars
from barlake.session import prepare


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def _roll_up(ticks: DataFrame, order: list[str]) -> DataFrame:
    """Raw bars from (symbol, ts, price, quantity): first and last price by ``order``."""
    at = F.struct(*order, "price")
    return (
        ticks.groupBy("symbol", F.date_trunc("day", "ts").alias("ts"))
        .agg(
            F.min(at)["price"].alias("Open"),
            F.max("price").alias("High"),
            F.min("price").alias("Low"),
            F.max(at)["price"].alias("Close"),
            F.sum("quantity").cast("bigint").alias("Volume"),
        )
        .select("symbol", "ts", "Open", "High", "Low", "Close", "Volume")
    )


def raw_part_bars(spark: SparkSession, folder: str) -> DataFrame:
    """A bar per part and ship date: the price of a line is its price per piece."""
    line = table(spark, folder, "lineitem")
    ticks = line.select(
        F.concat(F.lit("P"), "l_partkey").alias("symbol"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("quantity"),
        "l_orderkey",
        "l_linenumber",
    )
    # Hardly two lines share a part and a day, so sums before the shuffle would only widen the
    # rows; dealt by symbol, they need no other shuffle for a universe or for the days.
    return _roll_up(ticks.repartition("symbol"), ["l_orderkey", "l_linenumber"])


def raw_user_bars(spark: SparkSession, folder: str) -> DataFrame:
    """A bar per user and day over the values of the user's events."""
    ticks = table(spark, folder, "events").select(
        F.concat(F.lit("U"), "user_id").alias("symbol"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("price"),
        F.lit(1).alias("quantity"),
        F.col("ts").alias("at"),
        "event_id",
    )
    return _roll_up(ticks, ["at", "event_id"])


def raw_event_bars(spark: SparkSession, folder: str) -> DataFrame:
    """A bar per event: many on a day of a user, at their own instants."""
    value = F.col("value")
    return table(spark, folder, "events").select(
        F.concat(F.lit("U"), "user_id").alias("symbol"),
        F.col("ts").cast("timestamp").alias("ts"),
        value.alias("Open"),
        (value + 2).alias("High"),
        (value / 2).alias("Low"),
        (value + F.when(F.col("event_id") % 3 == 0, 0.25).otherwise(-0.125)).alias("Close"),
        (F.col("event_id") % 7).alias("Volume"),
    )


def raw_flag_bars(spark: SparkSession, folder: str) -> DataFrame:
    """A bar per return flag and ship date: three symbols share all rows."""
    line = table(spark, folder, "lineitem")
    ticks = line.select(
        F.col("l_returnflag").alias("symbol"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("quantity"),
        "l_orderkey",
        "l_linenumber",
    )
    return _roll_up(ticks, ["l_orderkey", "l_linenumber"])


def raw_quotes(spark: SparkSession, folder: str) -> DataFrame:
    """Landed quotes: an order quotes its customer, some without a price."""
    orders = table(spark, folder, "orders")
    total = F.col("o_totalprice")
    return orders.select(
        F.concat(F.lit("C"), "o_custkey").alias("symbol"),
        F.when(F.col("o_orderstatus") != "P", total).alias("last_price"),
        F.col("o_orderkey").alias("last_volume"),
        (total / 3).alias("bid"),
        F.when(F.col("o_orderstatus") == "F", float("inf")).otherwise(total / 7).alias("ask"),
        F.col("o_orderdate").cast("timestamp").alias("fetched_at"),
    )


def price_records(spark: SparkSession, folder: str) -> DataFrame:
    """Price records from orders as text, some of them unusable."""
    total = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_orderpriority").alias("symbol"),
        F.when(F.col("o_orderstatus") != "P", total).alias("price"),
        F.when(F.col("o_orderstatus") == "F", F.lit("n/a")).alias("bid"),
        total.alias("ask"),
        F.concat(F.col("o_custkey").cast("string"), F.lit(".0")).alias("volume"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
    )


def part_symbols(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(F.concat(F.lit("P"), "p_partkey").alias("symbol"))


def user_symbols(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    return events.select(F.concat(F.lit("U"), "user_id").alias("symbol")).distinct()


def part_bars(spark: SparkSession, folder: str) -> DataFrame:
    return normalize_bars(raw_part_bars(spark, folder))


def user_bars(spark: SparkSession, folder: str) -> DataFrame:
    return normalize_bars(raw_user_bars(spark, folder))


def numbered_uuid(number: Column) -> Column:
    return F.concat(F.lit("00000000-0000-0000-0000-"), F.lpad(number.cast("string"), 12, "0"))


def quotes(spark: SparkSession, folder: str) -> DataFrame:
    """An event is a quote of its type."""
    return table(spark, folder, "events").select(
        numbered_uuid(F.col("event_id")).alias("stock_price_id"),
        F.col("event_type").alias("symbol"),
        to_decimal(F.col("value")).alias("price"),
        F.get_json_object("props", "$.k").cast("bigint").alias("volume"),
        F.lit(None).cast("decimal(12,4)").alias("bid"),
        F.lit(None).cast("decimal(12,4)").alias("ask"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit("events").alias("source"),
    )


def _order_instant() -> Column:
    """One order per second from 2024 on."""
    return F.timestamp_seconds(F.lit(1704067200) + F.col("o_orderkey"))


def order_quotes(spark: SparkSession, folder: str) -> DataFrame:
    """An order is a quote of its customer's symbol, with a zero bid, one per second."""
    return table(spark, folder, "orders").select(
        F.concat(F.lit("10000000-0000-0000-0000-"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias(
            "stock_price_id"
        ),
        F.concat(F.lit("C"), "o_custkey").alias("symbol"),
        to_decimal(F.col("o_totalprice")).alias("price"),
        F.col("o_custkey").alias("volume"),
        F.lit(0).cast("decimal(12,4)").alias("bid"),
        to_decimal(F.col("o_totalprice") + 1).alias("ask"),
        _order_instant().alias("timestamp"),
        F.lit("orders").alias("source"),
    )


def stocks(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.concat(F.lit("P"), "p_partkey").alias("symbol"),
        F.col("p_name").alias("company_name"),
        F.col("p_type").alias("sector"),
        (F.col("p_size") % 2 == 0).alias("is_active"),
    )


def order_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Topic records from orders, many of them unusable.

    The priority is the symbol (one is too long). By status the price is text, a JSON
    number, or text with six places, and the source is given, null or absent.
    """
    total = F.col("o_totalprice")
    price = (
        F.when(F.col("o_orderstatus") == "F", total.cast("decimal(12,2)").cast("string"))
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit('"'), total.cast("decimal(12,2)"), F.lit('00"')))
        .otherwise(F.concat(F.lit('"'), total.cast("decimal(12,2)"), F.lit('0001"')))
    )
    source = F.when(F.col("o_orderstatus") == "O", ',"source":"orders"').otherwise("")
    value = F.concat(
        F.lit('{"stock_price_id":"'),
        numbered_uuid(F.col("o_orderkey")),
        F.lit('","symbol":"'),
        "o_orderpriority",
        F.lit('","price":'),
        price,
        F.lit(',"volume":"'),
        F.col("o_custkey").cast("string"),
        F.lit('","bid":0,"ask":"0.5","timestamp":"'),
        F.date_format(_order_instant(), "yyyy-MM-dd'T'HH:mm:ss"),
        F.lit('"'),
        source,
        F.lit("}"),
    )
    return table(spark, folder, "orders").select(
        F.col("o_orderpriority").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        _order_instant().alias("timestamp"),
    )


def order_records(spark: SparkSession, folder: str) -> DataFrame:
    """Bar records from orders as text, some of them unusable: long symbols, prices with
    too many places, missing dates."""
    total = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    return table(spark, folder, "orders").select(
        F.col("o_orderkey"),
        F.col("o_orderpriority").alias("symbol"),
        F.when(F.col("o_orderstatus") != "P", F.to_date("o_orderdate")).alias("date"),
        total.alias("open_price"),
        F.when(F.col("o_orderstatus") == "F", F.concat(total, F.lit("00000")))
        .otherwise(F.concat(total, F.lit("00100")))
        .alias("close_price"),
        total.alias("high_price"),
        F.lit(None).cast("string").alias("low_price"),
        total.alias("adj_close"),
        F.col("o_custkey").cast("string").alias("volume"),
        F.lit("0").alias("daily_change"),
        F.lit("0").alias("daily_change_percent"),
    )
