import datetime as dt
from decimal import Decimal

import pytest

from barlake.operators.normalize import (
    check_bars, concat_bars, normalize_bars, normalize_companies, normalize_quotes,
    with_quote_defaults, with_stock_defaults, zero_bars_as_null, zero_quotes_as_null,
)
from barlake.operators.quarantine import accepted, reject_counts, rejected
from barlake.operators.validate import (
    check_bar_records, check_bar_shape, check_price_range, check_price_records, check_stock_records,
    clean_nulls, duplicate_keys,
)
from barlake.schemas import DAILY_AGGREGATES, RAW_BARS, RAW_COMPANIES, RAW_QUOTES

T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
NAN, INF = float("nan"), float("inf")


def bars(spark, *rows):
    return spark.createDataFrame(list(rows), RAW_BARS)


def test_bar_is_rounded_and_its_change_computed(spark):
    raw = bars(spark, ("AAPL", T1, 100.0, 106.0, 99.0, 105.0, 1_000_000), ("AAPL", T2, 1.00005, 1.1, 1.0, 1.00015, 0))
    first, second = normalize_bars(raw).orderBy("date").collect()
    assert first.date == dt.date(2024, 1, 1)
    assert (first.daily_change, first.daily_change_percent) == (Decimal("5"), Decimal("5"))
    assert first.adj_close == first.close_price == Decimal("105")
    assert first.volume == 1_000_000
    assert (second.open_price, second.close_price, second.volume) == (Decimal("1.0000"), Decimal("1.0002"), None)


def test_no_change_without_positive_open_and_close(spark):
    raw = bars(
        spark, ("A", T1, 0.0, 1.0, 1.0, 1.0, 1), ("B", T1, 1.0, 1.0, 1.0, 0.0, 1),
        ("C", T1, None, 1.0, 1.0, 1.0, 1), ("D", T1, -1.0, 1.0, 1.0, 2.0, 1), ("E", T1, 2.0, 2.0, 2.0, 2.0, 1),
    )
    got = {r.symbol: (r.daily_change, r.daily_change_percent) for r in normalize_bars(raw).collect()}
    assert got == {**{s: (None, None) for s in "ABCD"}, "E": (Decimal(0), Decimal(0))}


def test_bad_bars_are_quarantined_one_by_one_or_by_symbol(spark):
    raw = bars(
        spark, ("A", T1, NAN, 1.0, 1.0, 1.0, 1), ("A", T2, 1.0, 1.0, 1.0, 1.0, 1),
        ("B", T1, 1.0, INF, 1.0, 1.0, 1), ("C", T1, 1e9, 1e9, 1e9, 1e9, 1),
        ("D", T1, 0.01, 400.0, 0.01, 400.0, 1), (None, T1, 1.0, 1.0, 1.0, 1.0, 1),
    )
    checked = check_bars(raw)
    assert {(r.symbol, r.reasons) for r in rejected(checked).collect()} == {
        ("A", "not a number"), ("C", "price out of range"), ("D", "percent out of range"), (None, "symbol missing"),
    }
    assert sorted(r.symbol for r in accepted(checked).collect()) == ["A", "B"]
    assert accepted(checked).filter("symbol = 'B'").first().high_price is None
    assert [r.symbol for r in normalize_bars(raw, strict_symbol=True).collect()] == ["B"]
    assert {r.reason: r.rows for r in reject_counts(checked).collect()}["not a number"] == 1


def test_bar_date_in_exchange_zone(spark):
    raw = bars(spark, ("A", dt.datetime(2024, 1, 2, 3, 0), 1.0, 1.0, 1.0, 1.0, 1))
    assert normalize_bars(raw).first().date == dt.date(2024, 1, 2)
    assert normalize_bars(raw, zone="America/New_York").first().date == dt.date(2024, 1, 1)


def test_quotes(spark):
    raw = spark.createDataFrame(
        [("AAPL", 150.25, 1_000_000, 150.20, 150.30, T1), ("GONE", None, 1, None, None, T1)], RAW_QUOTES
    )
    (row,) = normalize_quotes(raw).collect()
    assert (row.symbol, row.price, row.bid, row.ask, row.volume, row.source) == (
        "AAPL", Decimal("150.25"), Decimal("150.2"), Decimal("150.3"), 1_000_000, "yahoo_finance")
    assert row.stock_price_id == normalize_quotes(raw).first().stock_price_id


def test_company_names_fall_back(spark):
    raw = spark.createDataFrame(
        [("A", "Long", "Short", "s", "i", 1, "USD"), ("B", "", "Short", None, None, None, None), ("C", None, "", None, None, None, None)],
        RAW_COMPANIES,
    )
    assert {r.symbol: r.company_name for r in normalize_companies(raw).collect()} == {"A": "Long", "B": "Short", "C": None}


def test_zeros_become_null_but_volume_and_price_stay(spark):
    raw = bars(spark, ("A", T1, 2.0, 2.0, 0.0, 2.0, 5))
    row = zero_bars_as_null(normalize_bars(raw)).first()
    assert (row.low_price, row.daily_change, row.daily_change_percent, row.volume) == (None, None, None, 5)
    quotes = spark.createDataFrame([(Decimal(0), Decimal(0), Decimal(1))], "price decimal(12,4), bid decimal(12,4), ask decimal(12,4)")
    row = zero_quotes_as_null(quotes).first()
    assert (row.price, row.bid, row.ask) == (Decimal(0), None, Decimal(1))


def test_defaults(spark):
    quote = with_quote_defaults(spark.createDataFrame([("A",)], "symbol string")).first()
    assert len(quote.stock_price_id) == 36 and quote.source == "yahoo_finance"
    stock = with_stock_defaults(spark.createDataFrame([("A",)], "symbol string")).first()
    assert stock.is_active and len(stock.stock_id) == 36


def test_concat_keeps_the_schema_when_empty(spark):
    empty = spark.createDataFrame([], DAILY_AGGREGATES)
    assert concat_bars(empty, empty).schema == empty.schema
    with pytest.raises(ValueError):
        concat_bars()


RECORD = "symbol string, date date, open_price string, close_price string, high_price string, low_price string, adj_close string, volume string, daily_change string, daily_change_percent string"


def test_bar_records(spark):
    day = dt.date(2024, 1, 1)
    good = ("A", day, "1.5", "1.50000", None, "2", "1e1", "12", "0", "9999.9999")
    rows = [
        good,
        ("ABCDEFGHIJK", *good[1:]),
        ("B", None, *good[2:]),
        ("C", day, "1.00001", *good[3:]),
        ("D", day, "abc", *good[3:]),
        ("E", day, "NaN", *good[3:]),
        ("F", day, *good[2:7], "1.5", *good[8:]),
        ("G", day, *good[2:9], "10000"),
        ("H", day, *good[2:7], "2.0", *good[8:]),
        ("I", day, "1.0000000000000000000000001", *good[3:]),
    ]
    checked = check_bar_records(spark.createDataFrame(rows, RECORD))
    assert {r.symbol for r in accepted(checked).collect()} == {"A", "H"}
    reasons = {r.symbol: r.reasons for r in rejected(checked).collect()}
    assert reasons["ABCDEFGHIJK"] == "symbol: longer than 10"
    assert reasons["B"] == "date: missing"
    assert reasons["C"] == reasons["I"] == "open_price: more than 4 places"
    assert reasons["D"] == reasons["E"] == "open_price: not a number"
    assert reasons["F"] == "volume: not an integer"
    assert reasons["G"] == "daily_change_percent: out of range"
    row = accepted(checked).filter("symbol = 'A'").first()
    assert (row.close_price, row.adj_close, row.volume) == (Decimal("1.5"), Decimal("10"), 12)


def test_price_and_stock_records(spark):
    prices = spark.createDataFrame(
        [("A", "1", None, None, None, T1), ("B", None, None, None, None, T1), ("C", "1", "x", None, None, T1), ("D", "1", None, None, None, None)],
        "symbol string, price string, bid string, ask string, volume string, timestamp timestamp",
    )
    assert [r.symbol for r in accepted(check_price_records(prices)).collect()] == ["A"]
    stocks = spark.createDataFrame([("A", "x" * 255, "y"), ("B", "x" * 256, "y"), ("C", "x", "y" * 101)], "symbol string, company_name string, sector string")
    assert [r.symbol for r in accepted(check_stock_records(stocks)).collect()] == ["A"]


def test_range_shape_and_key_rules(spark):
    prices = spark.createDataFrame([("A", 0.0), ("B", 5.0), ("C", 10.0), ("D", None)], "symbol string, price double")
    assert [r.symbol for r in accepted(check_price_range(prices, 10.0)).collect()] == ["B"]
    shape = spark.createDataFrame([("A", 1.0, 2.0, 3.0, 1.0), ("B", 4.0, 2.0, 3.0, 1.0), ("C", None, 2.0, 3.0, 1.0)], "symbol string, open_price double, close_price double, high_price double, low_price double")
    assert {r.symbol for r in accepted(check_bar_shape(shape)).collect()} == {"A", "C"}
    twice = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert [tuple(r) for r in duplicate_keys(twice, ["k"]).collect()] == [(1, 2)]
    assert clean_nulls(prices, ["price"]).count() == 3


def test_extreme_prices_are_rejected_not_raised(spark):
    rows = [("A", dt.datetime(2024, 1, 1), 99999999.0, 1.0, 1.0, -99999999.0, 1), ("B", dt.datetime(2024, 1, 1), 0.0001, 1.0, 1.0, 99999999.0, 1)]
    raw = spark.createDataFrame(rows, "symbol string, ts timestamp, Open double, High double, Low double, Close double, Volume long")
    got = {r.symbol: r.reasons for r in check_bars(raw).collect()}
    assert got == {"A": "", "B": "percent out of range"}


def test_every_reason_is_counted(spark):
    nan = float("nan")
    rows = [
        (None, dt.datetime(2024, 1, 1), 1.0, 1.0, 1.0, 1.0, 1),
        ("B", None, 1.0, 1.0, 1.0, 1.0, 1),
        ("C", dt.datetime(2024, 1, 1), nan, 1.0, 1.0, 1.0, 1),
        ("D", dt.datetime(2024, 1, 1), 1e9, 1.0, 1.0, 1.0, 1),
        ("E", dt.datetime(2024, 1, 1), 0.0001, 1.0, 1.0, 1e6, 1),
    ]
    raw = spark.createDataFrame(rows, "symbol string, ts timestamp, Open double, High double, Low double, Close double, Volume long")
    got = {r.reason: r["rows"] for r in reject_counts(check_bars(raw)).collect()}
    assert got == {"symbol missing": 1, "date missing": 1, "not a number": 1, "price out of range": 1, "percent out of range": 1}


def test_first_and_last_bar_of_a_day_go_by_instant(spark, warehouse):
    from barlake.plans import jobs

    at = lambda hour: dt.datetime(2024, 1, 15, hour)
    rows = [("A", at(15), 50.0, 60.0, 40.0, 55.0, 1), ("A", at(9), 100.0, 110.0, 90.0, 105.0, 1)]
    raw = spark.createDataFrame(rows, "symbol string, ts timestamp, Open double, High double, Low double, Close double, Volume long")
    assert [float(r.open_price) for r in jobs.daily_bars(raw, dt.date(2024, 1, 15), ["A"]).collect()] == [100.0]
    jobs.run_backfill(warehouse, raw, dt.date(2024, 1, 20), ["A"], period="max")
    assert [float(r.open_price) for r in warehouse.read("daily_aggregates").collect()] == [50.0]
