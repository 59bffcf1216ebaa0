import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from barlake.functions.keys import iso_text, key_uuid, parse_instant, parse_uuid
from barlake.functions.metrics import BAR_METRICS, pick
from barlake.functions.numbers import change_percent, exact_avg, report_round, to_decimal, zero_as_null


def one(frame):
    return [r[0] for r in frame.collect()]


def test_to_decimal_parses_texts_and_drops_the_rest(spark):
    rows = spark.createDataFrame([("150.25",), ("100",), ("99.99",), (None,), ("not a number",)], "v string")
    assert one(rows.select(to_decimal(F.col("v")))) == [
        Decimal("150.2500"), Decimal("100.0000"), Decimal("99.9900"), None, None,
    ]


def test_to_decimal_rounds_half_to_even(spark):
    rows = spark.createDataFrame([(1.00005,), (1.00015,), (-1.00005,), (2.00025,)], "v double")
    got = one(rows.select(to_decimal(F.col("v"))))
    assert [str(v) for v in got] == ["1.0000", "1.0002", "-1.0000", "2.0002"]


def test_to_decimal_out_of_range_is_null(spark):
    rows = spark.createDataFrame([(1e8,), (float("inf"),), (float("nan"),), (99999999.0,)], "v double")
    assert one(rows.select(to_decimal(F.col("v")))) == [None, None, None, Decimal("99999999.0000")]


def test_change_percent_is_exact_at_ties(spark):
    rows = spark.createDataFrame([("100", "105"), ("20000", "20000.0010"), ("20000", "20000.0030"), ("0", "5"), ("5", "0")], "o string, c string")
    price = [F.col(x).cast("decimal(12,4)") for x in ("o", "c")]
    got = one(rows.select(change_percent(*price)))
    # 0.000005 % and 0.000015 % are no ties at four places; 5 % is plain.
    assert [None if v is None else str(v) for v in got] == ["5.0000", "0.0000", "0.0000", None, None]
    tie = spark.createDataFrame([("2000", "2000.0010"), ("2000", "2000.0030")], "o string, c string")
    assert [str(v) for v in one(tie.select(change_percent(*price)))] == ["0.0000", "0.0002"]


def test_zero_as_null(spark):
    rows = spark.createDataFrame([(Decimal("0"),), (Decimal("1"),), (None,)], "v decimal(12,4)")
    assert one(rows.select(zero_as_null(F.col("v")))) == [None, Decimal("1.0000"), None]


def test_exact_avg_is_the_double_of_the_exact_sum(spark):
    rows = spark.createDataFrame([(Decimal("0.1"),), (Decimal("0.2"),), (None,)], "v decimal(12,4)")
    assert one(rows.agg(exact_avg(F.col("v")))) == [0.3 / 2]
    assert one(rows.filter("false").agg(exact_avg(F.col("v")))) == [None]


def test_report_round_scales_first(spark):
    rows = spark.createDataFrame([(1.005,), (2.5,), (-2.5,), (0.125,)], "v double")
    assert one(rows.select(report_round(F.col("v"), 2))) == [1.0, 2.5, -2.5, 0.13]
    assert one(rows.select(report_round(F.col("v"), 0))) == [1.0, 3.0, -3.0, 0.0]


def test_uuid_spellings(spark):
    plain = "12345678-90ab-cdef-1234-567890abcdef"
    texts = [plain, plain.upper(), plain.replace("-", ""), "{" + plain + "}", "urn:uuid:" + plain,
             plain[:-1], plain + "0", "x" * 36, "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "v string")
    assert one(rows.select(parse_uuid(F.col("v")))) == [plain] * 5 + [None] * 5


def test_key_uuid_is_stable_and_valid(spark):
    rows = spark.createDataFrame([("AAPL", dt.date(2024, 1, 1))] * 2, "s string, d date")
    ids = one(rows.select(key_uuid(F.col("s"), F.col("d"))))
    assert ids[0] == ids[1]
    assert one(rows.select(parse_uuid(key_uuid(F.col("s"), F.col("d")))))[0] == ids[0]


def test_instants(spark):
    texts = ["2024-01-01T10:00:00", "2024-01-01 10:00:00.123456", "2024-01-01T10:00:00+02:00",
             "2024-01-01T10:00:00Z", "2024-01-01", "2024", "zzz", "2024-13-01", None]
    rows = spark.createDataFrame([(t,) for t in texts], "v string")
    got = one(rows.select(F.date_format(parse_instant(F.col("v")), "yyyy-MM-dd HH:mm:ss.SSSSSS")))
    assert got == ["2024-01-01 10:00:00.000000", "2024-01-01 10:00:00.123456", "2024-01-01 08:00:00.000000",
                   "2024-01-01 10:00:00.000000", "2024-01-01 00:00:00.000000", None, None, None, None]
    assert one(rows.limit(2).select(iso_text(parse_instant(F.col("v"))))) == [
        "2024-01-01T10:00:00", "2024-01-01T10:00:00.123456"]


def test_unknown_metric_is_refused():
    with pytest.raises(ValueError):
        pick(BAR_METRICS, ["median"])


def test_literal_instants_do_not_depend_on_the_machine(spark):
    import os
    import time

    from barlake.functions.keys import instant

    zone = os.environ.get("TZ")
    os.environ["TZ"] = "America/New_York"
    time.tzset()
    try:
        text = F.date_format(instant(dt.datetime(2024, 1, 1, 12)), "yyyy-MM-dd HH:mm")
        assert one(spark.range(1).select(text)) == ["2024-01-01 12:00"]
    finally:
        os.environ.pop("TZ") if zone is None else os.environ.__setitem__("TZ", zone)
        time.tzset()


INSTANTS = [
    "20240115T101500", "2024-01-15T10:15:00+0530", "2024-01-15 10", "2024-01-15T10:15:00,5", "20240115", "2024-W03-1", "2024W03",
    "2024-W03-7T1015", "2024-01-15T10:15:00.123456789-01:02:03", "2024-01-15x101500+05", "2024-01-15T10:15:00Z", "2024-0115",
    "202401-15", "2024-02-30", "2024-W54-1", "2023-W53-1", "2024-01-15T25", "2024-01-15T10:1500", "2024-01-15T10:15:00+24:00", "", "T10",
    "2024-01-15T10:15:00.", "2020-W53-7",
]


def test_instants_in_every_iso_spelling(spark):
    def known(text):
        try:
            at = dt.datetime.fromisoformat(text)
        except ValueError:
            return None
        return (at if at.tzinfo else at.replace(tzinfo=dt.timezone.utc)).astimezone(dt.timezone.utc).replace(tzinfo=None)

    rows = spark.createDataFrame([(t,) for t in INSTANTS], "t string")
    got = {r.t: r.at for r in rows.select("t", parse_instant(F.col("t")).cast("timestamp_ntz").alias("at")).collect()}
    assert got == {t: known(t) for t in INSTANTS}
