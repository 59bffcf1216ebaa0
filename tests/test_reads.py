import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from barlake.operators import lookups, ranking, statistics

D = dt.date
BARS = "symbol string, date date, close_price decimal(12,4), volume long, daily_change_percent decimal(8,4)"
PRICES = "stock_price_id string, symbol string, price decimal(12,4), volume long, timestamp timestamp"
NOON = dt.datetime(2024, 1, 1, 12)


@pytest.fixture
def bars(spark):
    return spark.createDataFrame(
        [
            ("AAPL", D(2024, 1, 1), Decimal("150"), 1_000_000, Decimal("1.5")),
            ("AAPL", D(2024, 1, 2), Decimal("152"), 1_200_000, None),
            ("GOOGL", D(2024, 1, 2), Decimal("142"), None, Decimal("-2")),
        ],
        BARS,
    )


@pytest.fixture
def prices(spark):
    return spark.createDataFrame(
        [
            ("a", "AAPL", Decimal("150"), 1, NOON - dt.timedelta(hours=2)),
            ("b", "AAPL", Decimal("151"), 2, NOON - dt.timedelta(hours=1)),
            ("c", "AAPL", Decimal("149"), 3, NOON),
            ("d", "AAPL", Decimal("148"), 4, NOON),
            ("e", "MSFT", Decimal("400"), 5, NOON - dt.timedelta(seconds=30)),
        ],
        PRICES,
    )


def test_lookups(spark):
    stocks = spark.createDataFrame([("AAPL", True), ("MSFT", False), ("X", None)], "symbol string, is_active boolean")
    assert lookups.stock_by_symbol(stocks, "INVALID").isEmpty()
    assert [r.symbol for r in lookups.active_symbols(stocks).collect()] == ["AAPL"]
    assert [r.symbol for r in lookups.in_universe(stocks, []).orderBy("symbol").collect()] == ["AAPL", "MSFT"]
    assert [r.symbol for r in lookups.in_universe(stocks, ["X"]).collect()] == ["X"]
    assert lookups.in_universe(stocks, stocks.filter("is_active")).count() == 1


def test_prices_since_is_inclusive_and_ordered(prices):
    since = NOON - dt.timedelta(hours=1)
    assert [r.stock_price_id for r in lookups.prices_since(prices, "AAPL", since).collect()] == ["b", "c", "d"]


def test_ranges(bars):
    assert lookups.bar_at(bars, "AAPL", D(2024, 1, 2)).count() == 1
    assert lookups.bar_at(bars, "AAPL", D(2024, 1, 3)).isEmpty()
    assert lookups.bars_between(bars, "AAPL", D(2024, 1, 1), D(2024, 1, 2)).count() == 2


def test_dashboard_filter_excludes_the_reference_day(bars):
    assert lookups.dashboard_filter(bars, D(2024, 1, 2)).count() == 1
    assert lookups.dashboard_filter(bars, D(2024, 1, 3), ["GOOGL"], None).count() == 1
    assert lookups.dashboard_filter(bars, D(2024, 2, 15)).count() == 0


def test_symbol_stats(bars):
    row = statistics.symbol_stats(bars, "AAPL").first()
    assert tuple(row) == (2, D(2024, 1, 1), D(2024, 1, 2), 151.0, 1_100_000.0)
    assert tuple(statistics.symbol_stats(bars, "INVALID").first()) == (0, None, None, None, None)


def test_grouped_statistics(bars):
    rows = statistics.all_stats(bars).collect()
    assert [r.symbol for r in rows] == ["AAPL", "GOOGL"]
    assert rows[1].avg_volume is None
    summary = statistics.performance_summary(bars).collect()
    assert [(r.symbol, r.avg_daily_change) for r in summary] == [("AAPL", 1.5), ("GOOGL", -2.0)]
    assert statistics.price_trends(bars, 1).first().date == D(2024, 1, 1)
    assert statistics.avg_daily_change(bars).first()[0] == -0.25
    assert [r.avg_change for r in statistics.avg_daily_change_by_day(bars).collect()] == [1.5, -2.0]
    assert [r.symbol for r in statistics.top_performers(bars, 1).collect()] == ["AAPL"]
    assert statistics.distinct_symbols(bars).first()[0] == 2
    assert set(statistics.bar_metrics(bars, names=["avg_close", "count"]).columns) == {"avg_close", "count"}


def test_null_averages_rank_last(spark):
    rows = spark.createDataFrame([("A", None), ("B", Decimal("-1")), ("C", Decimal("-1"))], "symbol string, daily_change_percent decimal(8,4)")
    rows = rows.withColumns({"close_price": F.lit(1).cast("decimal(12,4)"), "volume": F.lit(1), "date": F.current_date()})
    assert [r.symbol for r in statistics.performance_summary(rows).collect()] == ["B", "C", "A"]


def test_price_metrics(prices):
    row = statistics.price_metrics(prices, ["symbol"]).filter("symbol = 'AAPL'").first()
    assert (row.latest_price, row.last_price, row.total_volume, row.avg_price) == (Decimal("151"), Decimal("148"), 10, 149.5)


def test_latest_price_breaks_ties_by_id(prices):
    assert ranking.latest_price(prices, "AAPL").first().stock_price_id == "d"
    assert ranking.latest_price(prices, "INVALID").isEmpty()
    each = {r.symbol: r.stock_price_id for r in ranking.latest_price_per_symbol(prices).collect()}
    assert each == {"AAPL": "d", "MSFT": "e"}
    assert [r.price for r in ranking.latest_prices(prices, 2).collect()] == [Decimal("148"), Decimal("149")]


def test_latest_and_first_bars(bars):
    assert [(r.symbol, r.date.day) for r in ranking.latest_bars(bars, 2).collect()] == [("AAPL", 2), ("GOOGL", 2)]
    assert {r.symbol: r.date.day for r in ranking.first_bar_per_symbol(bars).collect()} == {"AAPL": 1, "GOOGL": 2}


def test_top_movers_uses_the_latest_day_only(bars):
    rows = ranking.top_movers(bars, 5).collect()
    assert [(r.symbol, r.side) for r in rows] == [("GOOGL", "loser")]


def test_freshness(prices):
    rows = {r.symbol: (r.lag_seconds, r.is_fresh) for r in statistics.freshness(prices, NOON + dt.timedelta(seconds=90)).collect()}
    assert rows == {"AAPL": (90.0, True), "MSFT": (120.0, False)}


def test_top_k_needs_no_full_sort(bars):
    plan = ranking.latest_bars(bars)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_charts_filter_then_limit(bars, prices):
    from barlake.plans import dashboard

    trend = dashboard.bar_chart("Stock Price Trends", bars, D(2024, 1, 3), ["AAPL"], limit=1)
    assert [r.date.day for r in trend.collect()] == [1]
    assert dashboard.bar_chart("Average Daily Change", bars, D(2024, 1, 3)).first().avg_change == -0.25
    assert dashboard.latest_prices_chart(prices, ["MSFT"]).count() == 1
    with pytest.raises(ValueError):
        dashboard.bar_chart("Pie", bars, D(2024, 1, 3))


def test_top_by_metric(bars):
    rows = statistics.top_by_metric(bars, ["avg_daily_change", "total_volume"]).collect()
    assert [(r.symbol, r.total_volume) for r in rows] == [("AAPL", 2_200_000), ("GOOGL", None)]


def test_totals_pass_64_bits(spark):
    from barlake.operators import statistics

    rows = [("A", dt.date(2024, 1, d), Decimal(1), 9 * 10**18) for d in (1, 2)]
    bars = spark.createDataFrame(rows, "symbol string, date date, close_price decimal(12,4), volume long")
    assert statistics.all_stats(bars).first().avg_volume == 9e18
    assert statistics.symbol_stats(bars, "A").first().avg_volume == 9e18
    assert bars.groupBy().agg(statistics.exact_total(bars["volume"]).alias("v")).first().v == 18 * 10**18


def test_an_asked_limit_is_kept(spark):
    from barlake.plans import dashboard

    rows = [(f"S{n}", Decimal(1), 1, dt.datetime(2024, 1, 1), str(n)) for n in range(6000)]
    prices = spark.createDataFrame(rows, "symbol string, price decimal(12,4), volume long, timestamp timestamp, stock_price_id string")
    assert dashboard.latest_prices_chart(prices, limit=5500).count() == 5500
    assert dashboard.latest_prices_chart(prices, limit=0).count() == 0
    assert dashboard.latest_prices_chart(prices).count() == 20
