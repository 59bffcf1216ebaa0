"""The benchmark's table queries on an embedded DuckDB with the same rows, for comparison.

    python tools/baseline.py [folder]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from barlake.plans.oracle import ORACLE, _PART, _WINDOWS  # noqa: E402

QUERIES = {
    "bars_range": """SELECT * FROM bars WHERE symbol = 'P17' AND date >= DATE '1997-01-01'
        AND date <= DATE '1999-12-31' ORDER BY date""",
    "symbol_stats": """SELECT count(*), min(date), max(date), avg(close_price), avg(volume)
        FROM bars WHERE symbol = 'P17'""",
    "all_stats": """SELECT symbol, count(*), min(date), max(date), round(avg(close_price), 2),
        round(avg(volume), 0) FROM bars GROUP BY symbol ORDER BY symbol""",
    "performance_summary": """SELECT symbol, min(date), max(date), round(avg(close_price), 2),
        round(avg(daily_change_percent), 4) AS c FROM bars GROUP BY symbol ORDER BY c DESC""",
    "price_trends": """SELECT date, symbol, avg(close_price) FROM bars GROUP BY date, symbol
        ORDER BY date, symbol LIMIT 1000""",
    "trading_volume": """SELECT date, symbol, sum(volume) FROM bars GROUP BY date, symbol
        ORDER BY date, symbol LIMIT 1000""",
    "top_performers": """SELECT symbol, avg(daily_change_percent) AS c, sum(volume), avg(close_price)
        FROM bars GROUP BY symbol ORDER BY c DESC LIMIT 10""",
    "price_range": """SELECT date, symbol, avg(high_price), avg(low_price) FROM bars
        GROUP BY date, symbol ORDER BY date, symbol LIMIT 500""",
    "latest_bars": "SELECT * FROM bars ORDER BY date DESC, symbol LIMIT 100",
    "rolling_metrics": """SELECT *, avg(close_price) OVER five, avg(close_price) OVER twenty,
        stddev_samp(daily_change_percent) OVER five FROM bars WINDOW
        five AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
        twenty AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""",
    "sliding_stats": f"{_WINDOWS} SELECT * FROM windows",
    "normalise_bars": f"{_PART} SELECT * FROM bars",
    "latest_price": ORACLE["latest_price"],
}


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    con = duckdb.connect(config={"threads": int(os.environ.get("BENCH_CPUS", "8"))})
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    con.execute(f"""CREATE TABLE bars AS {_PART} SELECT symbol, date, volume,
        {', '.join(f'CAST({c} AS DECIMAL(12, 4)) AS {c}' for c in (
            'open_price', 'close_price', 'high_price', 'low_price', 'adj_close',
            'daily_change', 'daily_change_percent'))} FROM bars""")
    timings = {}
    for name, text in QUERIES.items():
        runs = []
        for _ in range(4):
            began = time.perf_counter()
            con.execute(text).to_arrow_table()
            runs.append(time.perf_counter() - began)
        timings[name] = round(min(runs[1:]), 3)
    # One statement per row, the way bars are upserted one by one: rows per second.
    con.execute("CREATE TABLE target (symbol VARCHAR, date DATE, close DOUBLE, UNIQUE (symbol, date))")
    rows = con.execute("SELECT symbol, date, close_price FROM bars LIMIT 2000").fetchall()
    began = time.perf_counter()
    for row in rows:
        con.execute(
            "INSERT INTO target VALUES (?, ?, ?) ON CONFLICT (symbol, date) DO UPDATE SET close = EXCLUDED.close",
            row,
        )
    timings["upsert_rows_per_second"] = round(len(rows) / (time.perf_counter() - began))
    print(json.dumps(timings))


if __name__ == "__main__":
    main()
