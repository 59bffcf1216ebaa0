import datetime as dt
import json
from decimal import Decimal

import pytest

from barlake.operators.messages import check_messages, decode_permissive, decode_strict, encode_quotes
from barlake.operators.quarantine import rejected
from barlake.schemas import TOPIC_RECORDS

ID = "12345678-90ab-cdef-1234-567890abcdef"
NOW = dt.datetime(2024, 1, 1, 10, 0, 0)
GOOD = {"stock_price_id": ID, "symbol": "AAPL", "price": "150.25", "volume": 100, "bid": "150.2", "ask": None,
        "timestamp": "2024-01-01T10:00:00", "source": "test"}


def records(spark, *values):
    raw = [v if isinstance(v, bytes) else (v if isinstance(v, str) else json.dumps(v)).encode() for v in values]
    return spark.createDataFrame([(b"AAPL", bytearray(v), NOW) for v in raw], TOPIC_RECORDS)


def without(*names):
    return {k: v for k, v in GOOD.items() if k not in names}


def test_strict_reads_a_good_message(spark):
    (row,) = decode_strict(records(spark, GOOD)).collect()
    assert row.asDict() == {
        "stock_price_id": ID, "symbol": "AAPL", "price": Decimal("150.2500"), "volume": 100,
        "bid": Decimal("150.2000"), "ask": None, "timestamp": NOW, "source": "test",
    }


REJECTED = [
    (b"invalid json", "not JSON"),
    (b"\xff\xfe", "not JSON"),
    ({"symbol": "AAPL"}, "stock_price_id; price; timestamp"),
    (GOOD | {"stock_price_id": "x"}, "stock_price_id"),
    (GOOD | {"stock_price_id": 5}, "stock_price_id"),
    (GOOD | {"symbol": "ABCDEFGHIJK"}, "symbol"),
    (GOOD | {"symbol": 700}, "symbol"),
    (GOOD | {"price": 150.1}, "price"),
    (GOOD | {"price": "1.00001"}, "price"),
    (GOOD | {"price": "NaN"}, "price"),
    (GOOD | {"price": "100000000"}, "price"),
    (GOOD | {"price": None}, "price"),
    (GOOD | {"volume": 1.5}, "volume"),
    (GOOD | {"volume": "x"}, "volume"),
    (GOOD | {"bid": "x"}, "bid"),
    (GOOD | {"ask": {"a": 1}}, "ask"),
    (GOOD | {"timestamp": "yesterday"}, "timestamp"),
    (GOOD | {"timestamp": 1}, "timestamp"),
    (GOOD | {"source": None}, "source"),
    (GOOD | {"source": 1}, "source"),
]


def test_strict_rejections_name_their_reason(spark):
    checked = check_messages(records(spark, *[m for m, _ in REJECTED]))
    got = {bytes(r.value): r.reasons for r in rejected(checked).collect()}
    for message, reason in REJECTED:
        raw = message if isinstance(message, bytes) else json.dumps(message).encode()
        expected = reason if reason != "not JSON" else got[raw].split("; ")[0]
        assert got[raw].startswith(expected) and (reason == "not JSON" or got[raw] == reason), (raw, got[raw])


ACCEPTED = [
    (without("source"), "source", "kafka"),
    (GOOD | {"price": 150.25}, "price", Decimal("150.25")),
    (GOOD | {"price": 150}, "price", Decimal("150")),
    (GOOD | {"price": "1.50000"}, "price", Decimal("1.5")),
    (GOOD | {"price": "1e2"}, "price", Decimal("100")),
    (GOOD | {"price": " 12 "}, "price", Decimal("12")),
    (GOOD | {"price": True}, "price", Decimal("1")),
    (GOOD | {"volume": "12"}, "volume", 12),
    (GOOD | {"volume": 2.0}, "volume", 2),
    (GOOD | {"volume": None}, "volume", None),
    (without("volume"), "volume", None),
    (GOOD | {"bid": ""}, "bid", None),
    (GOOD | {"bid": 0}, "bid", None),
    (GOOD | {"bid": "0"}, "bid", Decimal("0")),
    (GOOD | {"bid": []}, "bid", None),
    (GOOD | {"bid": False}, "bid", None),
    (GOOD | {"stock_price_id": ID.replace("-", "").upper()}, "stock_price_id", ID),
    (GOOD | {"timestamp": "2024-01-01T12:00:00+02:00"}, "timestamp", NOW),
]


def test_strict_acceptances(spark):
    for message, name, value in ACCEPTED:
        message["symbol"] = f"S{ACCEPTED.index((message, name, value))}" if name != "symbol" else message["symbol"]
    rows = {r.symbol: r for r in decode_strict(records(spark, *[m for m, _, _ in ACCEPTED])).collect()}
    for message, name, value in ACCEPTED:
        assert rows[message["symbol"]][name] == value, message


def test_permissive_keeps_every_row(spark):
    rows = decode_permissive(records(spark, GOOD, "invalid json", GOOD | {"price": "abc", "timestamp": "zzz", "volume": "12"})).collect()
    assert len(rows) == 3
    assert rows[0].price == Decimal("150.25") and rows[0].kafka_key == "AAPL" and rows[0].timestamp == NOW
    assert rows[1].symbol is None and rows[1].kafka_key == "AAPL"
    assert (rows[2].price, rows[2].timestamp, rows[2].volume, rows[2].symbol) == (None, None, None, "AAPL")


def test_permissive_price_rounds_half_up(spark):
    assert decode_permissive(records(spark, GOOD | {"price": "1.00005"})).first().price == Decimal("1.0001")


def quotes(spark, **changes):
    row = {"stock_price_id": ID, "symbol": "AAPL", "price": Decimal("150.25"), "volume": None, "bid": Decimal(0),
           "ask": Decimal("150.3"), "timestamp": NOW, "source": "test"} | changes
    schema = "stock_price_id string, symbol string, price decimal(12,4), volume long, bid decimal(12,4), ask decimal(12,4), timestamp timestamp, source string"
    return spark.createDataFrame([tuple(row.values())], schema)


def test_encode(spark):
    row = encode_quotes(quotes(spark)).first()
    assert bytes(row.key) == b"AAPL"
    assert json.loads(bytes(row.value)) == {
        "stock_price_id": ID, "symbol": "AAPL", "price": "150.2500", "volume": None, "bid": None,
        "ask": "150.3000", "timestamp": "2024-01-01T10:00:00", "source": "test",
    }


def test_round_trip(spark):
    before = quotes(spark, volume=7, bid=Decimal("1.5"), timestamp=dt.datetime(2024, 1, 1, 10, 0, 0, 123456))
    records_ = encode_quotes(before).selectExpr("key", "value", "timestamp'2024-01-01' AS timestamp")
    assert decode_strict(records_).collect() == before.collect()
