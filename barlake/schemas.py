"""Table, landing and message schemas, and the values they default to.

Every reader in the package uses one of these schemas, so nothing is inferred: a
partition directory ``symbol=0700`` stays text and an empty directory still reads
as a typed, empty table.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

PRICE = DecimalType(12, 4)
PERCENT = DecimalType(8, 4)

STOCKS = StructType(
    [
        StructField("stock_id", StringType(), False),
        StructField("symbol", StringType(), False),
        StructField("company_name", StringType()),
        StructField("sector", StringType()),
        StructField("is_active", BooleanType()),
        StructField("created_at", TimestampType()),
        StructField("updated_at", TimestampType()),
    ]
)

STOCK_PRICES = StructType(
    [
        StructField("stock_price_id", StringType(), False),
        StructField("symbol", StringType(), False),
        StructField("price", PRICE, False),
        StructField("volume", LongType()),
        StructField("bid", PRICE),
        StructField("ask", PRICE),
        StructField("timestamp", TimestampType(), False),
        StructField("source", StringType()),
        StructField("created_at", TimestampType()),
    ]
)

DAILY_AGGREGATES = StructType(
    [
        StructField("daily_aggregate_id", StringType(), False),
        StructField("symbol", StringType(), False),
        StructField("date", DateType(), False),
        StructField("open_price", PRICE),
        StructField("close_price", PRICE),
        StructField("high_price", PRICE),
        StructField("low_price", PRICE),
        StructField("adj_close", PRICE),
        StructField("volume", LongType()),
        StructField("daily_change", PRICE),
        StructField("daily_change_percent", PERCENT),
        StructField("created_at", TimestampType()),
    ]
)

JOB_RUNS = StructType(
    [
        StructField("job", StringType(), False),
        StructField("execution_date", DateType()),
        StructField("status", StringType(), False),
        StructField("records_loaded", LongType(), False),
        StructField("completed_at", TimestampType(), False),
    ]
)

# Landed provider files.
RAW_BARS = StructType(
    [
        StructField("symbol", StringType()),
        StructField("ts", TimestampType()),
        StructField("Open", DoubleType()),
        StructField("High", DoubleType()),
        StructField("Low", DoubleType()),
        StructField("Close", DoubleType()),
        StructField("Volume", LongType()),
    ]
)

RAW_QUOTES = StructType(
    [
        StructField("symbol", StringType()),
        StructField("last_price", DoubleType()),
        StructField("last_volume", LongType()),
        StructField("bid", DoubleType()),
        StructField("ask", DoubleType()),
        StructField("fetched_at", TimestampType()),
    ]
)

RAW_COMPANIES = StructType(
    [
        StructField("symbol", StringType()),
        StructField("longName", StringType()),
        StructField("shortName", StringType()),
        StructField("sector", StringType()),
        StructField("industry", StringType()),
        StructField("marketCap", LongType()),
        StructField("currency", StringType()),
    ]
)

# Topic records as the Kafka source presents them, and the JSON inside ``value``.
TOPIC_RECORDS = StructType(
    [
        StructField("key", BinaryType()),
        StructField("value", BinaryType()),
        StructField("timestamp", TimestampType()),
    ]
)

QUOTE_MESSAGE = StructType(
    [
        StructField("stock_price_id", StringType()),
        StructField("symbol", StringType()),
        StructField("price", StringType()),
        StructField("volume", LongType()),
        StructField("bid", StringType()),
        StructField("ask", StringType()),
        StructField("timestamp", StringType()),
        StructField("source", StringType()),
    ]
)

BAR_PRICES = ["open_price", "close_price", "high_price", "low_price", "adj_close"]
BAR_CHANGES = ["daily_change", "daily_change_percent"]
BAR_VALUES = [*BAR_PRICES, "volume", *BAR_CHANGES]

# Column lengths.
MAX_SYMBOL = 10
MAX_COMPANY_NAME = 255
MAX_SECTOR = 100

# Defaults, and the rows the stocks table starts with.
QUOTE_SOURCE = "yahoo_finance"
MESSAGE_SOURCE = "kafka"
TOPIC = "stock_prices"
SEED_STOCKS = [
    ("AAPL", "Apple Inc.", "Technology"),
    ("GOOGL", "Alphabet Inc.", "Technology"),
    ("MSFT", "Microsoft Corporation", "Technology"),
    ("AMZN", "Amazon.com Inc.", "Consumer Cyclical"),
    ("META", "Meta Platforms Inc.", "Technology"),
]
DEFAULT_SYMBOLS = ["AAPL", "GOOGL", "MSFT", "AMZN", "META"]
