"""The registered queries: name to (session, folder of the given tables) to frame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, TimestampType

from barlake import schemas
from barlake.operators import lookups, ranking, statistics
from barlake.operators.messages import check_messages, decode_permissive, decode_strict, encode_quotes
from barlake.operators.normalize import check_bars, concat_bars, normalize_bars, normalize_quotes, zero_bars_as_null
from barlake.operators.quarantine import accepted, reject_counts
from barlake.operators.rolling import rolling_metrics
from barlake.operators.sliding import flat_windows, sliding_stats
from barlake.operators.validate import (
    check_bar_records,
    check_bar_shape,
    check_price_range,
    check_price_records,
    check_stock_records,
    with_processing_time,
)
from barlake.operators.validate import duplicate_keys as find_duplicates
from barlake.plans import dashboard, given, jobs
from barlake.session import shared_dir
from barlake.sources import landing, topics
from barlake.sources.warehouse import Warehouse
from barlake.streaming import jobs as stream_jobs

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the parametrised queries.
SYMBOL = "P17"
SYMBOLS = ["P1", "P17", "P42", "P99"]
START, END = dt.date(1997, 1, 1), dt.date(1999, 12, 31)
DAY = dt.date(2024, 1, 15)
QUOTE_SYMBOL = "click"
SINCE = dt.datetime(2024, 1, 10, 12, 0)
AS_OF = dt.datetime(2024, 1, 31)
TODAY = dt.date(2024, 1, 31)

REGISTRY: dict[str, Query] = {}


def _portable(rows: DataFrame) -> DataFrame:
    """Decimals as doubles, whole ones as integers, and instants without zone, as other engines print them."""
    columns = []
    for field in rows.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, DecimalType):
            column = column.cast("double" if field.dataType.scale else "bigint")
        elif isinstance(field.dataType, TimestampType):
            column = column.cast("timestamp_ntz")
        columns.append(column.alias(field.name))
    return rows.select(*columns)


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = lambda spark, folder: _portable(function(spark, folder))
    return function


def _warehouse(spark: SparkSession) -> Warehouse:
    return Warehouse(spark, shared_dir(spark, "warehouse")).create_missing()


def _plain(rows: DataFrame) -> DataFrame:
    """Without the columns that differ from run to run."""
    return rows.drop("daily_aggregate_id", "stock_id", "created_at", "updated_at")


# ---- point and range reads ----------------------------------------------------------


@query
def stock_by_symbol(spark, folder):
    return lookups.stock_by_symbol(given.stocks(spark, folder), SYMBOL)


@query
def active_symbols(spark, folder):
    return lookups.active_symbols(given.stocks(spark, folder))


@query
def prices_since(spark, folder):
    return lookups.prices_since(given.quotes(spark, folder), QUOTE_SYMBOL, SINCE)


@query
def bar_at(spark, folder):
    return lookups.bar_at(given.user_bars(spark, folder), "U7", DAY)


@query
def bars_range(spark, folder):
    return lookups.bars_between(given.part_bars(spark, folder), SYMBOL, START, END)


@query
def symbol_universe(spark, folder):
    universe = lookups.active_symbols(given.stocks(spark, folder))
    return lookups.in_universe(given.part_bars(spark, folder), universe)


@query
def dashboard_filtered(spark, folder):
    return dashboard.bar_chart("Stock Price Trends", given.part_bars(spark, folder), END, SYMBOLS, 1000)


@query
def dashboard_last_30_days(spark, folder):
    return dashboard.bar_chart("Top Performers", given.user_bars(spark, folder), TODAY)


@query
def company_info(spark, folder):
    companies = given.table(spark, folder, "supplier").select(
        F.col("s_suppkey").cast("string").alias("symbol"),
        F.when(F.col("s_acctbal") < 0, "").otherwise(F.col("s_name")).alias("longName"),
        F.concat(F.lit("S"), "s_suppkey").alias("shortName"),
        F.lit(None).cast("string").alias("sector"),
        F.col("s_nationkey").cast("string").alias("industry"),
        F.col("s_suppkey").alias("marketCap"),
        F.lit("USD").alias("currency"),
    )
    path = shared_dir(spark, "companies")
    companies.write.json(path)
    asked = companies.select("symbol").unionByName(
        given.table(spark, folder, "nation").select(F.col("n_name").alias("symbol"))
    )
    return landing.read_companies(spark, path, asked, "json")


# ---- statistics and charts ----------------------------------------------------------


@query
def symbol_stats(spark, folder):
    return statistics.symbol_stats(given.part_bars(spark, folder), SYMBOL)


@query
def symbol_stats_unknown(spark, folder):
    return statistics.symbol_stats(given.part_bars(spark, folder), "INVALID")


@query
def all_stats(spark, folder):
    return statistics.all_stats(given.part_bars(spark, folder))


@query
def performance_summary(spark, folder):
    return statistics.performance_summary(given.user_bars(spark, folder))


@query
def price_trends(spark, folder):
    return statistics.price_trends(given.part_bars(spark, folder))


@query
def trading_volume(spark, folder):
    return statistics.trading_volume(given.part_bars(spark, folder))


@query
def avg_daily_change(spark, folder):
    return statistics.avg_daily_change(given.user_bars(spark, folder))


@query
def avg_daily_change_by_day(spark, folder):
    return statistics.avg_daily_change_by_day(given.user_bars(spark, folder))


@query
def top_performers(spark, folder):
    return statistics.top_performers(given.user_bars(spark, folder))


@query
def top_performers_by_metric(spark, folder):
    return statistics.top_by_metric(given.user_bars(spark, folder), ["avg_daily_change", "total_volume"])


@query
def price_range(spark, folder):
    return statistics.price_range(given.part_bars(spark, folder))


@query
def bar_metrics(spark, folder):
    return statistics.bar_metrics(given.user_bars(spark, folder), ["symbol"])


@query
def price_metrics(spark, folder):
    return statistics.price_metrics(given.quotes(spark, folder), ["symbol"])


@query
def distinct_symbols(spark, folder):
    return statistics.distinct_symbols(given.part_bars(spark, folder))


@query
def freshness(spark, folder):
    return statistics.freshness(given.quotes(spark, folder), AS_OF, 600)


# ---- rolling metrics ------------------------------------------------------------------


def _rounded_volatility(rows: DataFrame) -> DataFrame:
    # Two correct deviations may differ in the last bits.
    return rows.withColumn("volatility_5", F.round("volatility_5", 6))


@query
def moving_averages(spark, folder):
    rows = rolling_metrics(given.part_bars(spark, folder))
    return rows.select("symbol", "date", "close_price", "ma_5", "ma_20")


@query
def moving_averages_hot(spark, folder):
    """Three symbols hold everything, one of them without a name, on many days twice: their
    rows are rolled in blocks."""
    bars = normalize_bars(given.raw_flag_bars(spark, folder))
    again = bars.filter(F.dayofmonth("date") <= 10).withColumn("close_price", F.col("low_price"))
    nameless = F.when(F.col("symbol") != "R", F.col("symbol"))
    rows = rolling_metrics(bars.unionByName(again).withColumn("symbol", nameless), split_rows=500)
    return rows.select("symbol", "date", "close_price", "ma_5", "ma_20")


@query
def volatility(spark, folder):
    rows = _rounded_volatility(rolling_metrics(given.user_bars(spark, folder)))
    return rows.select("symbol", "date", "daily_change_percent", "volatility_5")


@query
def historical_etl(spark, folder):
    raw = given.raw_user_bars(spark, folder)
    everyone = given.user_symbols(spark, folder)
    rows = jobs.run_historical_etl(raw, TODAY, everyone, "5d")
    return _rounded_volatility(rows).drop("open_price", "high_price", "low_price", "adj_close")


# ---- sorts, limits, top-k ---------------------------------------------------------------


@query
def latest_price(spark, folder):
    return ranking.latest_price(given.quotes(spark, folder), QUOTE_SYMBOL)


@query
def latest_price_per_symbol(spark, folder):
    return ranking.latest_price_per_symbol(given.quotes(spark, folder))


@query
def latest_bars(spark, folder):
    return ranking.latest_bars(given.part_bars(spark, folder))


@query
def latest_prices_chart(spark, folder):
    return dashboard.latest_prices_chart(given.quotes(spark, folder))


@query
def first_bar_per_symbol(spark, folder):
    return ranking.first_bar_per_symbol(given.part_bars(spark, folder))


@query
def daily_bars(spark, folder):
    raw = given.raw_event_bars(spark, folder)
    return jobs.daily_bars(raw, DAY, given.user_symbols(spark, folder))


@query
def yesterday_bars(spark, folder):
    raw = given.raw_event_bars(spark, folder)
    return landing.yesterday_bars(raw, DAY, given.user_symbols(spark, folder))


@query
def history_between_dates(spark, folder):
    """Landed as CSV, read back, start included and end excluded."""
    path = shared_dir(spark, "landed")
    given.raw_user_bars(spark, folder).write.option("header", True).csv(path)
    raw = landing.read_bars(spark, path, "csv")
    return landing.history(raw, TODAY, given.user_symbols(spark, folder), DAY, TODAY)


@query
def top_movers(spark, folder):
    return ranking.top_movers(given.user_bars(spark, folder))


# ---- normalisation, validation, messages --------------------------------------------------


@query
def normalized_bars(spark, folder):
    return given.user_bars(spark, folder)


@query
def normalized_bars_strict(spark, folder):
    return normalize_bars(given.raw_part_bars(spark, folder), strict_symbol=True)


@query
def rejected_bars(spark, folder):
    return reject_counts(check_bars(given.raw_part_bars(spark, folder)))


@query
def concatenated_bars(spark, folder):
    """Bars of two sources in one frame."""
    return concat_bars(given.user_bars(spark, folder), normalize_bars(given.raw_flag_bars(spark, folder)))


@query
def processing_time(spark, folder):
    """Every row is stamped, with one instant for all."""
    stamped = with_processing_time(given.quotes(spark, folder))
    return stamped.agg(
        F.count("processed_at").alias("stamped"), F.count_distinct("processed_at").alias("instants")
    )


@query
def validated_stocks(spark, folder):
    """Orders as stocks: a symbol that is missing or too long is refused."""
    records = given.price_records(spark, folder).select(
        F.when(F.col("price").isNotNull(), F.col("symbol")).alias("symbol"), "o_orderkey",
        F.lit("a company").alias("company_name"), F.lit("a sector").alias("sector"),
    )
    return reject_counts(check_stock_records(records))


@query
def creation_times(spark, folder):
    """created_at is set once: an upsert of known keys keeps it."""
    warehouse = _warehouse(spark)
    bars = given.user_bars(spark, folder)
    warehouse.upsert_bars(bars)
    before = warehouse.read("daily_aggregates").select("symbol", "date", F.col("created_at").alias("created_before"))
    kept = shared_dir(spark, "created")
    before.write.parquet(kept)
    warehouse.upsert_bars(bars.withColumn("volume", F.lit(1)))
    both = warehouse.read("daily_aggregates").join(spark.read.parquet(kept), ["symbol", "date"])
    same = F.count_if(F.col("created_at") == F.col("created_before"))
    return both.agg(F.count(F.lit(1)).alias("rows"), same.alias("kept"), F.sum("volume").alias("volume"))


@query
def zero_as_null(spark, folder):
    return zero_bars_as_null(given.user_bars(spark, folder))


@query
def validated_bars(spark, folder):
    return accepted(check_bar_records(given.order_records(spark, folder)))


@query
def validation_report(spark, folder):
    return reject_counts(check_bar_records(given.order_records(spark, folder)))


@query
def price_range_check(spark, folder):
    checked = check_price_range(given.quotes(spark, folder), cap=100.0, floor=1.0)
    return accepted(checked).groupBy("symbol").agg(F.count(F.lit(1)).alias("in_range"))


@query
def bar_shape_check(spark, folder):
    return accepted(check_bar_shape(given.user_bars(spark, folder))).select("symbol", "date")


@query
def landed_quotes(spark, folder):
    return normalize_quotes(given.raw_quotes(spark, folder)).drop("stock_price_id")


@query
def validated_prices(spark, folder):
    return accepted(check_price_records(given.price_records(spark, folder)))


@query
def duplicate_keys(spark, folder):
    lines = given.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    return find_duplicates(lines, ["l_orderkey", "l_linenumber"])


@query
def json_encode(spark, folder):
    records = encode_quotes(given.quotes(spark, folder))
    return records.select(*[F.col(c).cast("string").alias(c) for c in ("key", "value")])


@query
def json_decode_strict(spark, folder):
    return decode_strict(given.order_messages(spark, folder))


@query
def json_decode_rejects(spark, folder):
    return reject_counts(check_messages(given.order_messages(spark, folder)))


@query
def json_decode_permissive(spark, folder):
    return decode_permissive(given.order_messages(spark, folder))


# ---- writes ---------------------------------------------------------------------------------


@query
def upsert_stocks(spark, folder):
    """Parts, then parts again with another name and sector, and customers as new ones."""
    warehouse = _warehouse(spark)
    first = given.stocks(spark, folder)
    warehouse.upsert_stocks(first)
    again = first.select(
        "symbol",
        F.upper("company_name").alias("company_name"),
        F.lit(None).cast("string").alias("sector"),
        F.lit(True).alias("is_active"),
    )
    customers = given.table(spark, folder, "customer").select(
        F.concat(F.lit("C"), "c_custkey").alias("symbol"),
        F.col("c_name").alias("company_name"),
        F.col("c_mktsegment").alias("sector"),
        F.lit(True).alias("is_active"),
    )
    warehouse.upsert_stocks(again.unionByName(customers))
    return _plain(warehouse.read("stocks"))


@query
def upsert_bars(spark, folder):
    """Daily bars of users, then one bar per event in event order: the last one stays."""
    warehouse = _warehouse(spark)
    warehouse.upsert_bars(given.user_bars(spark, folder))
    value = F.col("value").cast("decimal(12,4)")
    each = given.table(spark, folder, "events").select(
        F.concat(F.lit("U"), "user_id").alias("symbol"),
        F.to_date("ts").alias("date"),
        *[value.alias(c) for c in ("open_price", "close_price", "high_price", "low_price")],
        F.lit(None).cast("decimal(12,4)").alias("adj_close"),
        F.get_json_object("props", "$.k").cast("bigint").alias("volume"),
        F.lit(0).cast("decimal(12,4)").alias("daily_change"),
        F.lit(0).cast("decimal(8,4)").alias("daily_change_percent"),
        "event_id",
    )
    warehouse.upsert_bars(each, sequence="event_id")
    return _plain(warehouse.read("daily_aggregates"))


@query
def append_prices(spark, folder):
    """Events, then events again together with orders: only the orders are new."""
    warehouse = _warehouse(spark)
    events, orders = given.quotes(spark, folder), given.order_quotes(spark, folder)
    warehouse.append_prices(events)
    warehouse.append_prices(events.unionByName(orders), on_duplicate="skip")
    return _plain(warehouse.read("stock_prices"))


@query
def seed_stocks(spark, folder):
    warehouse = _warehouse(spark)
    known = given.stocks(spark, folder)
    warehouse.seed_stocks(known)
    renamed = known.withColumn("company_name", F.lit("renamed"))
    customers = given.table(spark, folder, "customer").select(
        F.concat(F.lit("C"), "c_custkey").alias("symbol"),
        F.col("c_name").alias("company_name"),
        F.col("c_mktsegment").alias("sector"),
        F.lit(True).alias("is_active"),
    )
    warehouse.seed_stocks(renamed.unionByName(customers))
    warehouse.seed_stocks()
    return _plain(warehouse.read("stocks"))


@query
def load_by_position(spark, folder):
    warehouse = _warehouse(spark)
    rows = given.quotes(spark, folder).withColumn("created_at", F.col("timestamp"))
    renamed = rows.toDF(*[f"c{i}" for i in range(len(rows.columns))])
    warehouse.load(renamed, "stock_prices")
    return _plain(warehouse.read("stock_prices"))


@query
def query_with_parameters(spark, folder):
    warehouse = _warehouse(spark)
    warehouse.append_prices(given.quotes(spark, folder))
    text = """
        SELECT symbol, COUNT(*) AS n, MAX(price) AS highest
        FROM stock_prices WHERE price >= ? AND symbol <> ? GROUP BY symbol
    """
    return warehouse.sql(text, [50, QUOTE_SYMBOL])


@query
def stored_range_reads(spark, folder):
    """A bar range and a price range read from the partitions concerned."""
    warehouse = _warehouse(spark)
    warehouse.upsert_bars(given.user_bars(spark, folder))
    warehouse.append_prices(given.quotes(spark, folder))
    bars = warehouse.bars_between("U7", DAY, TODAY).select(
        "symbol", F.col("close_price").alias("price"), F.col("date").cast("timestamp").alias("at")
    )
    prices = warehouse.prices_since(QUOTE_SYMBOL, SINCE).select(
        "symbol", "price", F.col("timestamp").alias("at")
    )
    return bars.unionByName(prices)


@query
def stored_latest_reads(spark, folder):
    """Newest bars, newest prices and one symbol's newest price from the newest partitions."""
    warehouse = _warehouse(spark)
    warehouse.upsert_bars(given.user_bars(spark, folder))
    warehouse.append_prices(given.quotes(spark, folder))
    parts = [
        ("bars", warehouse.latest_bars().select("symbol", F.col("date").cast("timestamp").alias("at"))),
        ("prices", warehouse.latest_prices().select("symbol", F.col("timestamp").alias("at"))),
        ("price", warehouse.latest_price(QUOTE_SYMBOL).select("symbol", F.col("timestamp").alias("at"))),
    ]
    bars, prices, price = (rows.withColumn("part", F.lit(name)) for name, rows in parts)
    return bars.unionByName(prices).unionByName(price)


@query
def stored_chart(spark, folder):
    warehouse = _warehouse(spark)
    warehouse.upsert_bars(given.user_bars(spark, folder))
    return dashboard.stored_bar_chart("Price Range (High-Low)", warehouse, TODAY, last_days=7)


@query
def backfill(spark, folder):
    warehouse = _warehouse(spark)
    raw = given.raw_part_bars(spark, folder)
    jobs.run_backfill(warehouse, raw, dt.date(2030, 1, 1), given.part_symbols(spark, folder), "max")
    return _plain(warehouse.read("daily_aggregates"))


@query
def backfill_intraday(spark, folder):
    """A symbol has many bars on a day, the last counts."""
    warehouse = _warehouse(spark)
    raw = given.raw_event_bars(spark, folder)
    jobs.run_backfill(warehouse, raw, TODAY, given.user_symbols(spark, folder), "max")
    return _plain(warehouse.read("daily_aggregates"))


@query
def daily_etl(spark, folder):
    """Two days, the second one twice; a symbol has many bars on a day, the first counts."""
    warehouse = _warehouse(spark)
    raw = given.raw_event_bars(spark, folder)
    everyone = given.user_symbols(spark, folder)
    for day in (DAY, DAY + dt.timedelta(days=1), DAY + dt.timedelta(days=1)):
        jobs.run_daily_etl(warehouse, raw, day, everyone)
    return _plain(warehouse.read("daily_aggregates"))


@query
def run_report(spark, folder):
    warehouse = _warehouse(spark)
    raw = given.raw_event_bars(spark, folder)
    everyone = given.user_symbols(spark, folder)
    for day in (DAY, dt.date(2000, 1, 1)):
        jobs.run_daily_etl(warehouse, raw, day, everyone)
    return warehouse.read("job_runs").drop("completed_at")


# ---- streams ------------------------------------------------------------------------------------


@query
def sliding_window_stats(spark, folder):
    return flat_windows(sliding_stats(given.quotes(spark, folder)))


def _published(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_dir(spark, "topic")
    topics.publish(given.quotes(spark, folder), fmt="parquet", path=path)
    return topics.read_topic(spark, fmt="parquet", path=path)


@query
def publish_quotes(spark, folder):
    path = shared_dir(spark, "topic")
    topics.publish(given.quotes(spark, folder), fmt="parquet", path=path)
    rows = spark.read.schema(schemas.TOPIC_RECORDS).parquet(path)
    return rows.groupBy(F.col("key").cast("string").alias("key")).agg(F.count(F.lit(1)).alias("messages"))


@query
def sliding_stats_stream(spark, folder):
    """The aggregate job on the topic: windows closed by the watermark, as files."""
    path, checkpoint = shared_dir(spark, "windows"), shared_dir(spark, "checkpoint")
    stream_jobs.run_aggregation_job(
        _published(spark, folder), "parquet", path, checkpoint, drain=True
    )
    columns = flat_windows(sliding_stats(given.quotes(spark, folder))).schema
    return spark.read.schema(columns).parquet(path)


@query
def sliding_stats_late(spark, folder):
    """The same in three micro-batches, the last of which sends the first hour once more, too
    late: it is left out."""
    path, checkpoint, topic = (shared_dir(spark, name) for name in ("windows", "checkpoint", "topic"))
    quotes = given.quotes(spark, folder)
    early = F.col("timestamp") < F.to_timestamp(F.lit("2024-01-16 00:00:00"))
    hour = F.col("timestamp") < F.to_timestamp(F.lit("2024-01-01 01:00:00"))
    for part in (early, ~early, hour):
        topics.publish(quotes.filter(part).coalesce(1), fmt="parquet", path=topic)
    records = topics.read_topic(spark, {"maxFilesPerTrigger": "1"}, "parquet", topic)
    stream_jobs.run_aggregation_job(records, "parquet", path, checkpoint, drain=True)
    return spark.read.schema(flat_windows(sliding_stats(quotes)).schema).parquet(path)


@query
def publish_rounds(spark, folder):
    """Landed quotes, one file for each round, published round after round."""
    landed, topic, checkpoint = (shared_dir(spark, name) for name in ("landed", "topic", "checkpoint"))
    for part in range(3):
        given.raw_quotes(spark, folder).filter(F.col("last_volume") % 3 == part).coalesce(1).write.mode("append").parquet(landed)
    reader = spark.readStream.schema(schemas.RAW_QUOTES).option("maxFilesPerTrigger", 1).parquet(landed)
    sent = stream_jobs.publish_continuously(normalize_quotes(reader), checkpoint, fmt="parquet", path=topic, drain=True)
    rows = spark.read.schema(schemas.TOPIC_RECORDS).parquet(topic)
    return rows.agg(F.count(F.lit(1)).alias("messages"), F.lit(len(sent)).alias("rounds"))


@query
def sliding_stats_updates(spark, folder):
    """The same in update mode: the newest state of every window, open ones included, after
    a second run with a checkpoint of its own."""
    path, records = shared_dir(spark, "windows"), _published(spark, folder)
    for _ in range(2):
        checkpoint = shared_dir(spark, "checkpoint")
        stream_jobs.keep_latest_windows(records, path, checkpoint).awaitTermination()
    return stream_jobs.latest_windows(spark, path)


@query
def stream_to_parquet(spark, folder):
    path, checkpoint = shared_dir(spark, "prices"), shared_dir(spark, "checkpoint")
    records = _published(spark, folder)
    stream_jobs.run_streaming_job(records, "parquet", path, checkpoint, drain=True)
    rows = spark.read.schema(decode_permissive(records).schema).parquet(path)
    return rows.drop("kafka_timestamp")


@query
def stream_rejects(spark, folder):
    """The consumer pipeline on half-broken messages: what it stores and what it refuses."""
    warehouse = _warehouse(spark)
    path, refused = shared_dir(spark, "topic"), shared_dir(spark, "rejects")
    given.order_messages(spark, folder).write.parquet(path)
    records = topics.read_topic(spark, fmt="parquet", path=path)
    stream_jobs.run_consumer_pipeline(
        records, warehouse, shared_dir(spark, "checkpoint"), quarantine=refused
    )
    schema = "value binary, record_timestamp timestamp, reasons string"
    bad = spark.read.schema(schema).parquet(refused).groupBy("reasons")
    good = warehouse.read("stock_prices").groupBy(F.lit("").alias("reasons"))
    return bad.agg(F.count(F.lit(1)).alias("rows")).unionByName(good.agg(F.count(F.lit(1)).alias("rows")))


@query
def pipeline_stops_at_n(spark, folder):
    """Ten files of messages, one for each micro-batch: the job ends before the one that
    would exceed the limit, and a second run goes on from there."""
    warehouse = _warehouse(spark)
    path, checkpoint = shared_dir(spark, "topic"), shared_dir(spark, "checkpoint")
    quotes = given.quotes(spark, folder)
    # Read once; a task writes each file.
    part = F.coalesce(F.crc32("stock_price_id") % 10, F.lit(0)).cast("int")
    topics.publish(quotes.filter("stock_price_id IS NOT NULL").repartitionById(10, part), fmt="parquet", path=path)
    limit = quotes.count() // 3
    runs = []
    for most in (limit, None):
        records = topics.read_topic(spark, {"maxFilesPerTrigger": "1"}, "parquet", path)
        runs.append(stream_jobs.run_consumer_pipeline(records, warehouse, checkpoint, max_messages=most))
    stored = warehouse.read("stock_prices").agg(F.count(F.lit(1)).alias("stored"))
    return stored.select("stored", F.lit(0 < runs[0] <= limit).alias("kept_to_limit"), F.lit(sum(runs)).cast("long").alias("written"))


@query
def stream_to_warehouse(spark, folder):
    """Topic to price table, from a topic that holds every message twice, the second time
    dated a day later."""
    warehouse = _warehouse(spark)
    path = shared_dir(spark, "topic")
    quotes = given.quotes(spark, folder)
    later = quotes.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 1 DAY"))
    for sent in (quotes, later):
        topics.publish(sent, fmt="parquet", path=path)
    records = topics.read_topic(spark, {"maxFilesPerTrigger": "4"}, "parquet", path)
    stream_jobs.run_consumer_pipeline(records, warehouse, shared_dir(spark, "checkpoint"))
    return _plain(warehouse.read("stock_prices"))
