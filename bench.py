"""Headline timings: load the tables once, then query them as stored.

Prints one JSON line. BENCH_SF_DIR names the folder of the given tables, BENCH_CPUS the
local threads. Each query runs once to warm up; the best of three further runs counts.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import tempfile
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from barlake.operators import lookups, ranking, statistics  # noqa: E402
from barlake.operators.messages import check_messages, decode_permissive, encode_quotes  # noqa: E402
from barlake.operators.rolling import rolling_metrics  # noqa: E402
from barlake.operators.sliding import flat_windows, sliding_stats  # noqa: E402
from barlake.plans import given, jobs  # noqa: E402
from barlake.session import build_session, shared_dir  # noqa: E402
from barlake.sources import topics  # noqa: E402
from barlake.sources.warehouse import Warehouse  # noqa: E402
from barlake.streaming import jobs as stream_jobs  # noqa: E402


def run(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def seconds(work: Callable[[], object]) -> float:
    began = time.perf_counter()
    work()
    return time.perf_counter() - began


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    warehouse = Warehouse(spark, shared_dir(spark, "warehouse")).create_missing()
    timings: dict[str, float] = {}

    raw = given.raw_part_bars(spark, folder)
    symbols = given.part_symbols(spark, folder)
    late = dt.date(2030, 1, 1)
    timings["backfill"] = seconds(lambda: jobs.run_backfill(warehouse, raw, late, symbols, "max"))
    quotes = given.quotes(spark, folder)
    timings["append_prices"] = seconds(lambda: warehouse.append_prices(quotes))
    timings["upsert_stocks"] = seconds(lambda: warehouse.upsert_stocks(given.stocks(spark, folder)))
    month = raw.filter(F.date_format("ts", "yyyy-MM") == "1998-06")
    timings["upsert_one_month"] = seconds(
        lambda: jobs.run_backfill(warehouse, month, late, symbols, "max")
    )

    bars, prices = warehouse.read("daily_aggregates"), warehouse.read("stock_prices")
    records = encode_quotes(quotes).withColumn("timestamp", F.current_timestamp())
    topic = shared_dir(spark, "records")
    records.repartition(int(cpus)).write.parquet(topic)
    messages = spark.read.parquet(topic)
    headline: dict[str, Callable[[], DataFrame]] = {
        "stock_by_symbol": lambda: lookups.stock_by_symbol(warehouse.read("stocks"), "P17"),
        "bars_range": lambda: warehouse.bars_between("P17", dt.date(1997, 1, 1), dt.date(1999, 12, 31)),
        "prices_since": lambda: warehouse.prices_since("click", dt.datetime(2024, 1, 10, 12)),
        "symbol_stats": lambda: statistics.symbol_stats(bars, "P17"),
        "all_stats": lambda: statistics.all_stats(bars),
        "performance_summary": lambda: statistics.performance_summary(bars),
        "price_trends": lambda: statistics.price_trends(bars),
        "trading_volume": lambda: statistics.trading_volume(bars),
        "top_performers": lambda: statistics.top_performers(bars),
        "price_range": lambda: statistics.price_range(bars),
        "price_metrics": lambda: statistics.price_metrics(prices, ["symbol"]),
        "latest_bars": lambda: warehouse.latest_bars(),
        "latest_price": lambda: warehouse.latest_price("click"),
        "latest_price_per_symbol": lambda: ranking.latest_price_per_symbol(prices),
        "top_movers": lambda: ranking.top_movers(bars),
        "rolling_metrics": lambda: rolling_metrics(bars),
        "sliding_stats": lambda: flat_windows(sliding_stats(prices)),
        "normalise_bars": lambda: given.part_bars(spark, folder),
        "json_decode_strict": lambda: check_messages(messages),
        "json_decode_permissive": lambda: decode_permissive(messages),
    }
    for name, query in headline.items():
        run(query())
        timings[name] = min(seconds(lambda: run(query())) for _ in range(3))

    stream = topics.read_topic(spark, fmt="parquet", path=topic)
    timings["sliding_stats_stream"] = seconds(
        lambda: stream_jobs.run_aggregation_job(
            stream, "parquet", shared_dir(spark, "windows"), shared_dir(spark, "checkpoint"), drain=True
        )
    )
    spark.stop()
    timings = {name: round(value, 3) for name, value in timings.items()}
    print(
        json.dumps(
            {
                "metric": "total seconds of loads, queries and stream",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
