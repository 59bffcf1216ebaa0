"""Quotes to topic records and back."""

from __future__ import annotations

from functools import lru_cache

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.functions.keys import iso_text, parse_instant, parse_uuid
from barlake.functions.numbers import exact, zero_as_null
from barlake.operators.quarantine import accepted, with_reasons
from barlake.operators.validate import INTEGER_TEXT, has_four_places
from barlake.schemas import MAX_SYMBOL, MESSAGE_SOURCE, PRICE, QUOTE_MESSAGE


def encode_quotes(quotes: DataFrame) -> DataFrame:
    """key = symbol, value = JSON: prices as text, explicit nulls, zero bid/ask as null."""
    message = F.struct(
        "stock_price_id",
        "symbol",
        F.col("price").cast("string").alias("price"),
        F.col("volume"),
        zero_as_null(F.col("bid")).cast("string").alias("bid"),
        zero_as_null(F.col("ask")).cast("string").alias("ask"),
        iso_text(F.col("timestamp")).alias("timestamp"),
        "source",
    )
    return quotes.select(
        F.col("symbol").cast("binary").alias("key"),
        F.to_json(message, {"ignoreNullFields": "false"}).cast("binary").alias("value"),
    )


def decode_permissive(records: DataFrame) -> DataFrame:
    """Every record becomes a row; whatever cannot be read is NULL."""
    decoded = records.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.from_json(F.col("value").cast("string"), QUOTE_MESSAGE).alias("data"),
    )
    return decoded.select(
        "kafka_key",
        "kafka_timestamp",
        "data.stock_price_id",
        "data.symbol",
        F.col("data.price").try_cast(PRICE).alias("price"),
        "data.volume",
        F.col("data.bid").try_cast(PRICE).alias("bid"),
        F.col("data.ask").try_cast(PRICE).alias("ask"),
        F.try_to_timestamp("data.timestamp").alias("timestamp"),
        "data.source",
    )


_MEMBERS = ("stock_price_id", "symbol", "price", "volume", "bid", "ask", "timestamp", "source")


def _kind(name: str, *kinds: str) -> Column:
    """Is this member of one of these variant types? False for an absent one."""
    return F.coalesce(F.col(f"_kind_{name}").isin(*kinds), F.lit(False))


def _is_float(name: str) -> Column:
    return F.coalesce(F.substring(f"_kind_{name}", 1, 6).isin("DECIMA", "DOUBLE", "FLOAT"), F.lit(False))


def _text(name: str) -> Column:
    return F.when(F.col(f"_kind_{name}") == "STRING", F.col(f"_text_{name}"))


def _number(name: str) -> Column:
    """A member's number as text, NULL if it is none.

    A JSON float stands for the binary fraction nearest to it, which has four decimal
    places or fewer only if it is a multiple of 1/16. Others are no prices: senders
    must write prices as text.
    """
    text = F.col(f"_text_{name}")
    sixteenths = text.try_cast("double") * 16
    return (
        F.when(_kind(name, "STRING", "BIGINT"), F.trim(text))
        .when(_is_float(name) & (sixteenths == F.floor(sixteenths)), text)
        .when(_kind(name, "BOOLEAN"), F.when(text == "true", "1").otherwise("0"))
    )


def _given(name: str) -> Column:
    """Is this member there and neither null nor empty, zero or false?"""
    text = F.col(f"_text_{name}")
    zero = ~_kind(name, "STRING") & (text.try_cast("double") == 0)
    empty = text.isin("", "[]", "{}") | (_kind(name, "BOOLEAN") & (text == "false"))
    return text.isNotNull() & ~F.coalesce(zero | empty, F.lit(False))


def _price_problem(text: Column, parsed: Column) -> Column:
    return ~F.coalesce(has_four_places(text) & parsed.isNotNull(), F.lit(False))


# Each member as a variant keeps apart an absent one, a null, a text and a number.
_VARIANTS = ", ".join([*[f"{name} variant" for name in _MEMBERS], "_broken string"])
_STRICT = {
    "columnNameOfCorruptRecord": "_broken", "allowSingleQuotes": "false", "allowNonNumericNumbers": "false",
}


def _members(records: DataFrame) -> DataFrame:
    """The variant type and the text of each member of the JSON object, read in one pass. Of
    members with one name the last counts."""
    text = F.try_validate_utf8(F.col("value").cast("string"))
    body = records.select(
        "value", F.col("timestamp").alias("record_timestamp"), F.from_json(text, _VARIANTS, _STRICT).alias("_body")
    )
    return body.select("value", "record_timestamp", *_member_columns(records.sparkSession.sparkContext))


@lru_cache(maxsize=1)
def _member_columns(context: SparkContext) -> list[Column]:
    return [
        (F.col("_body").isNull() | F.col("_body._broken").isNotNull()).alias("_unreadable"),
        *[F.schema_of_variant(f"_body.{n}").alias(f"_kind_{n}") for n in _MEMBERS],
        *[F.try_variant_get(f"_body.{n}", "$", "string").alias(f"_text_{n}") for n in _MEMBERS],
    ]


def check_messages(records: DataFrame) -> DataFrame:
    """Strict decode: price rows with the reasons why a message is unusable.

    Required are a UUID, a symbol of at most ten characters, a price and an instant.
    ``source`` may be absent, but not null. Falsy bid and ask mean none. The raw value
    is kept for the quarantine.
    """
    spelled, typed, checks = _check_columns(records.sparkSession.sparkContext)
    checked = with_reasons(_members(records).select(*spelled).withColumns(typed), *checks)
    return checked.select(*QUOTE_MESSAGE.names, "value", "record_timestamp", "reasons")


@lru_cache(maxsize=1)
def _check_columns(context: SparkContext) -> tuple[list, dict[str, Column], list[tuple[str, Column]]]:
    """The expressions of the check, some thousand calls to the JVM: made once for a session."""
    spelled = [
        "value",
        "record_timestamp",
        "_unreadable",
        parse_uuid(_text("stock_price_id")).alias("stock_price_id"),
        _text("symbol").alias("symbol"),
        _number("price").alias("_price"),
        F.when(_is_float("volume"), F.col("_text_volume")).otherwise(_number("volume")).alias("_volume"),
        F.col("_text_volume").isNotNull().alias("_has_volume"),
        _is_float("volume").alias("_is_float"),
        _given("bid").alias("_has_bid"),
        _number("bid").alias("_bid"),
        _given("ask").alias("_has_ask"),
        _number("ask").alias("_ask"),
        parse_instant(_text("timestamp")).alias("timestamp"),
        F.when(F.col("_kind_source").isNull(), MESSAGE_SOURCE).otherwise(_text("source")).alias("source"),
    ]
    typed = {
        "price": F.col("_price").try_cast(PRICE),
        "volume": F.coalesce(
            F.col("_volume").try_cast("bigint"),
            F.when(F.col("_volume").rlike(INTEGER_TEXT) | F.col("_is_float"), _whole(F.col("_volume"))),
        ),
        "bid": F.when(F.col("_has_bid"), F.col("_bid").try_cast(PRICE)),
        "ask": F.when(F.col("_has_ask"), F.col("_ask").try_cast(PRICE)),
    }
    checks = [
        ("not JSON", F.col("_unreadable")),
        ("stock_price_id", F.col("stock_price_id").isNull()),
        ("symbol", F.col("symbol").isNull() | (F.length("symbol") > MAX_SYMBOL)),
        ("price", _price_problem(F.col("_price"), F.col("price"))),
        ("volume", F.col("_has_volume") & F.col("volume").isNull()),
        ("bid", F.col("_has_bid") & _price_problem(F.col("_bid"), F.col("bid"))),
        ("ask", F.col("_has_ask") & _price_problem(F.col("_ask"), F.col("ask"))),
        ("timestamp", F.col("timestamp").isNull()),
        ("source", F.col("source").isNull()),
    ]
    return spelled, typed, checks


def _whole(text: Column) -> Column:
    value = exact(text)
    return F.when(value == F.floor(value), value.try_cast("bigint"))


def decode_strict(records: DataFrame) -> DataFrame:
    """Only the usable messages, as price rows."""
    return accepted(check_messages(records)).drop("value", "record_timestamp")
