import datetime as dt
import math
import random
from decimal import Decimal

import pandas as pd
import pytest

from barlake.operators.rolling import rolling_metrics

SCHEMA = "symbol string, date date, close_price decimal(12,4), daily_change_percent decimal(8,4)"


def random_bars(spark, symbols, days, seed=7):
    rng = random.Random(seed)
    rows = []
    for s in symbols:
        for d in sorted(rng.sample(range(days), days // 2)):
            close = None if rng.random() < 0.1 else Decimal(rng.randint(1, 10**6)).scaleb(-4)
            change = None if rng.random() < 0.1 else Decimal(rng.randint(-(10**6), 10**6)).scaleb(-4)
            rows.append((s, dt.date(2020, 1, 1) + dt.timedelta(days=d), close, change))
    return spark.createDataFrame(rows, SCHEMA)


def test_matches_pandas_rolling(spark):
    got = rolling_metrics(random_bars(spark, "ABC", 200)).toPandas().sort_values(["symbol", "date"]).reset_index(drop=True)
    values = got.assign(
        close=pd.to_numeric(got.close_price), change=pd.to_numeric(got.daily_change_percent)
    ).groupby("symbol")
    for column, source, size, how in (("ma_5", "close", 5, "mean"), ("ma_20", "close", 20, "mean"), ("volatility_5", "change", 5, "std")):
        want = values[source].transform(lambda x: getattr(x.rolling(size, min_periods=1), how)())
        assert got[column].isna().equals(want.isna()), column
        assert (got[column] - want).abs().max() < 1e-6


def test_first_rows(spark):
    rows = [("AAPL", dt.date(2024, 1, 1), Decimal("152"), Decimal("1")), ("AAPL", dt.date(2024, 1, 2), Decimal("155"), Decimal("3")), ("GOOGL", dt.date(2024, 1, 1), Decimal("142"), None)]
    first, second, other = rolling_metrics(spark.createDataFrame(rows, SCHEMA)).orderBy("symbol", "date").collect()
    assert (first.ma_5, first.volatility_5) == (152.0, None)
    assert second.ma_5 == second.ma_20 == 153.5
    assert math.isclose(second.volatility_5, math.sqrt(2))
    assert (other.ma_5, other.volatility_5) == (142.0, None)


@pytest.mark.parametrize("split_rows", [20, 33, 100, 10_000])
def test_split_groups_give_the_same_rows(spark, split_rows):
    hot = random_bars(spark, ["HOT"], 2400, seed=1)
    bars = hot.unionByName(random_bars(spark, ["A", "B"], 90, seed=2))
    whole = rolling_metrics(bars).orderBy("symbol", "date").collect()
    parts = rolling_metrics(bars, split_rows).select(*rolling_metrics(bars).columns)
    assert parts.orderBy("symbol", "date").collect() == whole


def test_split_with_sparse_months(spark):
    """Months of one row next to months of many: a block may be tiny."""
    rng = random.Random(3)
    rows = []
    for month in range(60):
        for day in rng.sample(range(1, 28), rng.choice([1, 1, 1, 27])):
            rows.append(("S", dt.date(2015 + month // 12, month % 12 + 1, day), Decimal(rng.randint(1, 999)), Decimal(rng.randint(-99, 99))))
    bars = spark.createDataFrame(rows, SCHEMA)
    whole = rolling_metrics(bars).orderBy("date").collect()
    parts = rolling_metrics(bars, 20).select(*rolling_metrics(bars).columns).orderBy("date").collect()
    assert parts == whole


def test_empty_in_empty_out(spark):
    assert rolling_metrics(spark.createDataFrame([], SCHEMA)).isEmpty()


def test_split_must_cover_a_frame(spark):
    with pytest.raises(ValueError):
        rolling_metrics(spark.createDataFrame([], SCHEMA), 19)


@pytest.mark.parametrize("split_rows", [20, 23])
def test_missing_symbols_dates_and_shared_days_survive_the_split(spark, split_rows):
    rows = [(s, d, Decimal(n), Decimal(n % 7)) for s in ("A", None) for d in (None, dt.date(2024, 1, 1), dt.date(2024, 1, 2)) for n in range(15)]
    bars = spark.createDataFrame(rows, "symbol string, date date, close_price decimal(12,4), daily_change_percent decimal(8,4)")
    key = lambda frame: sorted(map(repr, frame.collect()))
    assert key(rolling_metrics(bars, split_rows).select(*rolling_metrics(bars).columns)) == key(rolling_metrics(bars))
