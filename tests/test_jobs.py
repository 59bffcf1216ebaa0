import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from barlake.plans import jobs
from barlake.schemas import RAW_BARS, RAW_COMPANIES, RAW_QUOTES
from barlake.sources import landing

D = dt.date
DAY = dt.datetime(2024, 1, 15)


def raw(spark):
    rows = []
    for symbol in ("AAPL", "MSFT", "OTHER"):
        for back in range(40):
            at = DAY - dt.timedelta(days=back)
            rows.append((symbol, at, 100.0 + back, 120.0 + back, 90.0, 101.0 + back, 10 + back))
    return spark.createDataFrame(rows, RAW_BARS)


@pytest.mark.parametrize(
    "period, start",
    [("1d", D(2024, 3, 30)), ("5d", D(2024, 3, 26)), ("1mo", D(2024, 2, 29)), ("3mo", D(2023, 12, 31)), ("1y", D(2023, 3, 31)),
     ("10y", D(2014, 3, 31)), ("ytd", D(2024, 1, 1)), ("max", None)],
)
def test_period_start(period, start):
    assert landing.period_start(period, D(2024, 3, 31)) == start


def test_unknown_period():
    with pytest.raises(ValueError):
        landing.period_start("2d", D(2024, 1, 1))


def test_history_dates_count_only_in_pairs(spark):
    both = landing.history(raw(spark), D(2024, 1, 15), ["AAPL"], D(2024, 1, 10), D(2024, 1, 12))
    assert sorted(r.date.day for r in both.collect()) == [10, 11]
    alone = landing.history(raw(spark), D(2024, 1, 15), ["AAPL"], start=D(2024, 1, 14), period="5d")
    assert alone.count() == 6
    assert landing.history(raw(spark), D(2024, 1, 15), period="max").select("symbol").distinct().count() == 2


def test_day_and_yesterday(spark):
    assert sorted(r.symbol for r in landing.day_bars(raw(spark), D(2024, 1, 15)).collect()) == ["AAPL", "MSFT"]
    assert landing.yesterday_bars(raw(spark), D(2024, 1, 16), ["AAPL"]).first().date == D(2024, 1, 15)
    assert landing.day_bars(raw(spark), D(2025, 1, 1)).isEmpty()


def test_date_bound_reaches_the_scan(spark, tmp_path):
    raw(spark).write.parquet(str(tmp_path / "bars"))
    bars = landing.read_bars(spark, str(tmp_path / "bars"))
    plan = landing.history(bars, D(2024, 1, 15), ["AAPL"])._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "EqualTo(symbol,AAPL)" in plan.replace(" ", "")


@pytest.mark.parametrize("fmt", landing.FORMATS)
def test_landed_formats(spark, tmp_path, fmt):
    quotes = spark.createDataFrame([("AAPL", 150.25, 10, 150.2, None, DAY), ("0700", None, 1, 1.0, 1.0, DAY)], RAW_QUOTES)
    writer = quotes.write.format(fmt)
    (writer.option("header", True) if fmt == "csv" else writer).save(str(tmp_path / fmt))
    (row,) = landing.read_quotes(spark, str(tmp_path / fmt), fmt, ["AAPL", "0700"]).collect()
    assert (row.symbol, row.price, row.bid, row.ask, row.timestamp) == ("AAPL", Decimal("150.25"), Decimal("150.2"), None, DAY)


def test_company_without_record_keeps_its_symbol(spark, tmp_path):
    spark.createDataFrame([("AAPL", "Apple Inc.", "Apple", "Tech", "Phones", 3, "USD")], RAW_COMPANIES).write.json(str(tmp_path / "c"))
    got = {r.symbol: r.company_name for r in landing.read_companies(spark, str(tmp_path / "c"), ["AAPL", "NONE"], "json").collect()}
    assert got == {"AAPL": "Apple Inc.", "NONE": None}


def test_daily_etl_is_repeatable_and_reports(spark, warehouse, tmp_path):
    bad = spark.createDataFrame([("TOOLONGSYMBOL", DAY, 1.0, 1.0, 1.0, 1.0, 1)], RAW_BARS)
    source = raw(spark).unionByName(bad)
    symbols = ["AAPL", "MSFT", "TOOLONGSYMBOL"]
    for _ in range(2):
        report = jobs.run_daily_etl(warehouse, source, D(2024, 1, 15), symbols, quarantine=str(tmp_path / "bad"))
        assert (report.status, report.records_loaded, report.rejected) == ("success", 2, 1)
    assert warehouse.read("daily_aggregates").count() == 2
    assert spark.read.parquet(str(tmp_path / "bad")).first().reasons == "symbol: longer than 10"
    assert jobs.run_daily_etl(warehouse, source, D(2030, 1, 1)).status == "skipped"
    assert jobs.run_daily_etl(warehouse, source, D(2024, 1, 15), ["TOOLONGSYMBOL"]).status == "skipped"
    assert sorted(r.status for r in warehouse.read("job_runs").collect()) == ["skipped", "skipped", "success", "success"]


def test_historical_etl_keeps_flat_days_and_stores_nothing(spark, warehouse):
    flat = spark.createDataFrame([("AAPL", DAY, 1.0, 1.0, 1.0, 1.0, 1), ("AAPL", DAY - dt.timedelta(days=1), 1.0, 2.0, 1.0, 2.0, 1)], RAW_BARS)
    rows = jobs.run_historical_etl(flat, D(2024, 1, 15)).orderBy("date").collect()
    assert [r.daily_change_percent for r in rows] == [Decimal(100), Decimal(0)]
    assert round(rows[1].volatility_5, 4) == 70.7107
    assert jobs.run_historical_etl(flat, D(2030, 1, 1)).isEmpty()
    assert warehouse.read("daily_aggregates").isEmpty()


def test_backfill(spark, warehouse):
    result = jobs.run_backfill(warehouse, raw(spark), D(2024, 1, 15), period="1mo")
    assert result == {"status": "success", "period": "1mo", "total_loaded": 64}
    assert jobs.run_backfill(warehouse, raw(spark), D(2024, 1, 15), period="max")["total_loaded"] == 80
    assert warehouse.read("daily_aggregates").count() == 80


def test_part_bars_are_shuffled_once(spark, tmp_path, capsys):
    """By symbol, for the bars, the universe and the rows of a key alike."""
    from barlake.operators.merge import one_row_per_key
    from barlake.plans import given
    from barlake.sources.landing import history

    line = spark.range(60).select(
        (F.col("id") % 4).alias("l_partkey"), F.expr("date'1995-01-01' + cast(id % 5 as int)").alias("l_shipdate"),
        (F.col("id") + 10.0).alias("l_extendedprice"), F.lit(2.0).alias("l_quantity"),
        F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"),
    )
    line.write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.range(3).select(F.col("id").alias("p_partkey")).write.parquet(str(tmp_path / "part.parquet"))
    raw, parts = given.raw_part_bars(spark, str(tmp_path)), given.part_symbols(spark, str(tmp_path))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        bars = history(raw, D(2030, 1, 1), parts, period="max", keep_ts=True)
        single = one_row_per_key(bars, ["symbol", "date"], ["close_price"], ["open_price"], "ts")
        single.explain()
        assert capsys.readouterr().out.count("Exchange") == 2  # lines and parts
        assert single.count() == 15 and single.agg(F.sum("_copies")).first()[0] == 15
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
