"""The registered queries as DuckDB SQL over the given tables.

Prices are kept as integers of 1/10000 (``*_u``) where rounding or sums must be exact.
"""

from __future__ import annotations

# Raw bars: (symbol, date, o, h, l, c as double, v).
_PART_RAW = """
tick AS (
  SELECT 'P' || l_partkey AS symbol, CAST(l_shipdate AS DATE) AS date,
         l_extendedprice / l_quantity AS price, l_quantity AS quantity,
         l_orderkey AS k1, l_linenumber AS k2
  FROM lineitem)
"""
_USER_RAW = """
tick AS (
  SELECT 'U' || user_id AS symbol, CAST(ts AS DATE) AS date, value AS price,
         1 AS quantity, ts AS k1, event_id AS k2
  FROM events)
"""
_FLAG_RAW = _PART_RAW.replace("'P' || l_partkey", "l_returnflag")
_ROLL_UP = """
raw AS (
  SELECT symbol, date,
         arg_min(price, {'a': k1, 'b': k2, 'c': price}) AS o, max(price) AS h,
         min(price) AS l, arg_max(price, {'a': k1, 'b': k2, 'c': price}) AS c,
         CAST(sum(quantity) AS BIGINT) AS v
  FROM tick GROUP BY symbol, date)
"""


def _units(name: str) -> str:
    """Half-even to four places, in units of 1/10000."""
    exact = f"round_even(CAST(CAST({name} AS VARCHAR) AS DECIMAL(38, 18)), 4)"
    return f"CAST(CAST({exact} AS DECIMAL(20, 4)) * 10000 AS HUGEINT)"


_NORMALISE = f"""
unit AS (
  SELECT symbol, date, {_units('o')} AS o_u, {_units('h')} AS h_u, {_units('l')} AS l_u,
         {_units('c')} AS c_u, nullif(v, 0) AS v
  FROM raw),
guarded AS (
  SELECT *, o_u > 0 AND c_u <> 0 AS ok, abs(c_u - o_u) * 1000000 AS n FROM unit),
divided AS (
  SELECT *, CASE WHEN ok THEN n // o_u END AS q, CASE WHEN ok THEN n % o_u END AS r FROM guarded),
checked AS (
  SELECT symbol, date, o_u, h_u, l_u, c_u, v,
         CASE WHEN ok THEN c_u - o_u END AS d_u,
         CASE WHEN ok THEN sign(c_u - o_u)
              * (q + CASE WHEN 2 * r > o_u OR (2 * r = o_u AND q % 2 = 1) THEN 1 ELSE 0 END) END AS p_u
  FROM divided),
bar_u AS (
  SELECT * FROM checked WHERE abs(coalesce(p_u, 0)) <= 99999999),
bars AS (
  SELECT symbol, date, o_u / 10000.0 AS open_price, c_u / 10000.0 AS close_price,
         h_u / 10000.0 AS high_price, l_u / 10000.0 AS low_price, c_u / 10000.0 AS adj_close,
         v AS volume, d_u / 10000.0 AS daily_change, p_u / 10000.0 AS daily_change_percent
  FROM bar_u)
"""
_PART = f"WITH {_PART_RAW}, {_ROLL_UP}, {_NORMALISE}"
_FLAG = f"WITH {_FLAG_RAW}, {_ROLL_UP}, {_NORMALISE}"
_USER = f"WITH {_USER_RAW}, {_ROLL_UP}, {_NORMALISE}"


# A bar per event, at its own instant: normalised as the others, with the instant kept.
_EVENT_RAW = """
raw AS (
  SELECT 'U' || user_id AS symbol, CAST(ts AS DATE) AS date, ts, value AS o, value + 2 AS h, value / 2 AS l,
         value + CASE WHEN event_id % 3 = 0 THEN 0.25::DOUBLE ELSE -0.125::DOUBLE END AS c,
         CAST(event_id % 7 AS BIGINT) AS v
  FROM events)
"""
_EVENT = f"WITH {_EVENT_RAW}, {_NORMALISE.replace('SELECT symbol, date,', 'SELECT symbol, date, ts,')}"
_VALUES = ["open_price", "close_price", "high_price", "low_price", "adj_close", "volume", "daily_change",
           "daily_change_percent"]
_FIRST = f"row_number() OVER (PARTITION BY symbol, date ORDER BY ts, {', '.join(f'{c} NULLS FIRST' for c in _VALUES)}) = 1"
_LAST = f"row_number() OVER (PARTITION BY symbol, date ORDER BY ts DESC, {', '.join(f'{c} DESC NULLS LAST' for c in _VALUES)}) = 1"
_FIRST_BARS = f"{_EVENT}, every AS (SELECT * FROM bars), firsts AS (SELECT * EXCLUDE (ts) FROM every QUALIFY {_FIRST})"


def _avg(units: str) -> str:
    return f"CAST(sum({units}) AS DOUBLE) / 10000.0 / count({units})"


_AVG_VOLUME = "CAST(sum(v) AS DOUBLE) / count(v)"

_QUOTES = """
WITH quote AS (
  SELECT '00000000-0000-0000-0000-' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS stock_price_id,
         event_type AS symbol, CAST(CAST(value AS VARCHAR) AS DECIMAL(12, 4)) AS price,
         CAST(json_extract(props, '$.k') AS BIGINT) AS volume,
         CAST(NULL AS DOUBLE) AS bid, CAST(NULL AS DOUBLE) AS ask,
         ts AS timestamp, 'events' AS source
  FROM events)
"""
_QUOTE_COLUMNS = (
    "stock_price_id, symbol, CAST(price AS DOUBLE) AS price, volume, bid, ask, timestamp, source"
)

_MESSAGES = """
WITH message AS (
  SELECT '00000000-0000-0000-0000-' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS stock_price_id,
         o_orderpriority AS symbol, o_totalprice AS price, o_custkey AS volume,
         TIMESTAMP '2024-01-01' + to_seconds(o_orderkey) AS timestamp, o_orderstatus AS status,
         length(o_orderpriority) > 10 AS bad_symbol,
         CASE o_orderstatus WHEN 'O' THEN FALSE
              WHEN 'F' THEN o_totalprice * 16 <> floor(o_totalprice * 16)
              ELSE TRUE END AS bad_price
  FROM orders)
"""

_RECORDS = """
WITH record AS (
  SELECT o_orderkey, o_orderpriority AS symbol,
         CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS date,
         o_totalprice AS total, o_custkey AS volume,
         o_orderstatus = 'P' AS bad_date, length(o_orderpriority) > 10 AS bad_symbol,
         o_orderstatus <> 'F' AS bad_close
  FROM orders)
"""

_WINDOWS = f"""{_QUOTES}, spread AS (
  SELECT symbol, CAST(price * 10000 AS HUGEINT) AS u,
         time_bucket(INTERVAL 1 MINUTE, timestamp) - to_minutes(CAST(k AS INTEGER)) AS window_start
  FROM quote, range(5) AS r(k)),
windows AS (
  SELECT symbol, window_start, window_start + INTERVAL 5 MINUTE AS window_end,
         ((2 * sum(u) * 10000 + count(*)) // (2 * count(*))) / 100000000.0 AS avg_price,
         min(u) / 10000.0 AS min_price, max(u) / 10000.0 AS max_price, count(*) AS trade_count
  FROM spread GROUP BY symbol, window_start)
"""

_STOCKS = """
WITH part_stock AS (
  SELECT 'P' || p_partkey AS symbol, p_name AS company_name, p_type AS sector,
         p_size % 2 = 0 AS is_active FROM part),
customer_stock AS (
  SELECT 'C' || c_custkey AS symbol, c_name AS company_name, c_mktsegment AS sector,
         TRUE AS is_active FROM customer)
"""

_ALL_BAR_COLUMNS = "SELECT * FROM bars"

# The bar table's columns with zeros blanked.
_BLANKED = """
SELECT symbol, date, nullif(open_price, 0) AS open_price, nullif(close_price, 0) AS close_price,
       nullif(high_price, 0) AS high_price, nullif(low_price, 0) AS low_price,
       nullif(adj_close, 0) AS adj_close, volume, nullif(daily_change, 0) AS daily_change,
       nullif(daily_change_percent, 0) AS daily_change_percent
FROM bars
"""

_TREND = f"SELECT date, symbol, {_avg('c_u')} AS avg_close FROM bar_u"

_ROLLED = """
rolled AS (
  SELECT *, CAST(sum(c_u) OVER five AS DOUBLE) / 10000.0 / count(c_u) OVER five AS ma_5,
         CAST(sum(c_u) OVER twenty AS DOUBLE) / 10000.0 / count(c_u) OVER twenty AS ma_20,
         round(stddev_samp(p_u / 10000.0) OVER five, 6) AS volatility_5
  FROM bar_u {where}
  WINDOW five AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
         twenty AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))
"""

_HOT_ORDER = "ORDER BY date, o_u, c_u, h_u, l_u, a_u, v NULLS FIRST, d_u NULLS FIRST, p_u NULLS FIRST"

ORACLE: dict[str, str] = {
    # ---- point and range reads
    "stock_by_symbol": f"{_STOCKS} SELECT * FROM part_stock WHERE symbol = 'P17'",
    "active_symbols": f"{_STOCKS} SELECT symbol FROM part_stock WHERE is_active = TRUE",
    "prices_since": f"""{_QUOTES} SELECT {_QUOTE_COLUMNS} FROM quote
        WHERE symbol = 'click' AND timestamp >= TIMESTAMP '2024-01-10 12:00:00'
        ORDER BY timestamp""",
    "bar_at": f"{_USER} SELECT * FROM bars WHERE symbol = 'U7' AND date = DATE '2024-01-15'",
    "bars_range": f"""{_PART} SELECT * FROM bars WHERE symbol = 'P17'
        AND date >= DATE '1997-01-01' AND date <= DATE '1999-12-31' ORDER BY date""",
    "symbol_universe": f"""{_PART} SELECT * FROM bars WHERE symbol IN
        (SELECT 'P' || p_partkey FROM part WHERE p_size % 2 = 0)""",
    "dashboard_filtered": f"""{_PART} {_TREND}
        WHERE symbol IN ('P1', 'P17', 'P42', 'P99')
          AND date >= DATE '1999-12-31' - 1000 AND date < DATE '1999-12-31'
        GROUP BY date, symbol ORDER BY date, symbol LIMIT 1000""",
    "dashboard_last_30_days": f"""{_USER}
        SELECT symbol, {_avg('p_u')} AS avg_change, CAST(sum(v) AS BIGINT) AS total_volume,
               {_avg('c_u')} AS avg_price
        FROM bar_u WHERE date >= DATE '2024-01-01' AND date < DATE '2024-01-31'
        GROUP BY symbol ORDER BY avg_change DESC NULLS LAST, symbol LIMIT 10""",
    "company_info": """
        SELECT CAST(s_suppkey AS VARCHAR) AS symbol,
               CASE WHEN s_acctbal < 0 THEN 'S' || s_suppkey ELSE s_name END AS company_name,
               CAST(NULL AS VARCHAR) AS sector, CAST(s_nationkey AS VARCHAR) AS industry,
               s_suppkey AS market_cap, 'USD' AS currency
        FROM supplier
        UNION ALL SELECT n_name, NULL, NULL, NULL, NULL, NULL FROM nation""",
    # ---- statistics and charts
    "symbol_stats": f"""{_PART} SELECT count(*) AS record_count, min(date) AS first_date,
        max(date) AS last_date, {_avg('c_u')} AS avg_price, {_AVG_VOLUME} AS avg_volume
        FROM bar_u WHERE symbol = 'P17'""",
    "symbol_stats_unknown": f"""{_PART} SELECT count(*) AS record_count, min(date) AS first_date,
        max(date) AS last_date, {_avg('c_u')} AS avg_price, {_AVG_VOLUME} AS avg_volume
        FROM bar_u WHERE symbol = 'INVALID'""",
    "all_stats": f"""{_PART} SELECT symbol, count(*) AS record_count, min(date) AS first_date,
        max(date) AS last_date, round({_avg('c_u')}, 2) AS avg_price,
        round({_AVG_VOLUME}, 0) AS avg_volume
        FROM bar_u GROUP BY symbol ORDER BY symbol""",
    "performance_summary": f"""{_USER} SELECT symbol, min(date) AS start_date,
        max(date) AS end_date, round({_avg('c_u')}, 2) AS avg_price,
        round({_avg('p_u')}, 4) AS avg_daily_change
        FROM bar_u GROUP BY symbol ORDER BY avg_daily_change DESC NULLS LAST, symbol""",
    "price_trends": f"""{_PART} {_TREND} GROUP BY date, symbol ORDER BY date, symbol LIMIT 1000""",
    "trading_volume": f"""{_PART} SELECT date, symbol, CAST(sum(v) AS BIGINT) AS total_volume
        FROM bar_u GROUP BY date, symbol ORDER BY date, symbol LIMIT 1000""",
    "avg_daily_change": f"{_USER} SELECT {_avg('p_u')} AS avg_change FROM bar_u",
    "avg_daily_change_by_day": f"""{_USER} SELECT date, {_avg('p_u')} AS avg_change
        FROM bar_u GROUP BY date ORDER BY date""",
    "top_performers": f"""{_USER} SELECT symbol, {_avg('p_u')} AS avg_change,
        CAST(sum(v) AS BIGINT) AS total_volume, {_avg('c_u')} AS avg_price
        FROM bar_u GROUP BY symbol ORDER BY avg_change DESC NULLS LAST, symbol LIMIT 10""",
    "top_performers_by_metric": f"""{_USER} SELECT symbol, {_avg('p_u')} AS avg_daily_change,
        CAST(sum(v) AS BIGINT) AS total_volume
        FROM bar_u GROUP BY symbol ORDER BY avg_daily_change DESC NULLS LAST, symbol LIMIT 10""",
    "price_range": f"""{_PART} SELECT date, symbol, {_avg('h_u')} AS avg_high,
        {_avg('l_u')} AS avg_low
        FROM bar_u GROUP BY date, symbol ORDER BY date, symbol LIMIT 500""",
    "bar_metrics": f"""{_USER} SELECT symbol, {_avg('c_u')} AS avg_close,
        CAST(sum(v) AS BIGINT) AS total_volume, {_avg('p_u')} AS avg_daily_change,
        count(*) AS "count" FROM bar_u GROUP BY symbol""",
    "price_metrics": f"""{_QUOTES} SELECT symbol, CAST(max(price) AS DOUBLE) AS latest_price,
        CAST(sum(price) AS DOUBLE) / count(price) AS avg_price,
        CAST(sum(volume) AS BIGINT) AS total_volume,
        CAST(arg_max(price, {{'a': timestamp, 'b': stock_price_id}}) AS DOUBLE) AS last_price
        FROM quote GROUP BY symbol""",
    "distinct_symbols": f"{_PART} SELECT count(DISTINCT symbol) AS symbols FROM bars",
    "freshness": f"""{_QUOTES}, seen AS (
        SELECT symbol, max(timestamp) AS last_timestamp FROM quote GROUP BY symbol), lag AS (
        SELECT *, (epoch_us(TIMESTAMP '2024-01-31') - epoch_us(last_timestamp)) / 1000000.0 AS lag_seconds
        FROM seen)
        SELECT *, lag_seconds < 600 AS is_fresh FROM lag""",
    # ---- rolling metrics
    "moving_averages": f"""{_PART}, {_ROLLED.format(where='')}
        SELECT symbol, date, c_u / 10000.0 AS close_price, ma_5, ma_20 FROM rolled""",
    "moving_averages_hot": f"""{_FLAG}, twice AS (
        SELECT * REPLACE (CASE WHEN symbol <> 'R' THEN symbol END AS symbol) FROM (
            SELECT *, c_u AS a_u FROM bar_u
            UNION ALL SELECT * REPLACE (l_u AS c_u), c_u AS a_u FROM bar_u WHERE day(date) <= 10)),
        {_ROLLED.format(where='').replace('FROM bar_u', 'FROM twice').replace('ORDER BY date', _HOT_ORDER)}
        SELECT symbol, date, c_u / 10000.0 AS close_price, ma_5, ma_20 FROM rolled""",
    "volatility": f"""{_USER}, {_ROLLED.format(where='')}
        SELECT symbol, date, p_u / 10000.0 AS daily_change_percent, volatility_5 FROM rolled""",
    "historical_etl": f"""{_USER}, {_ROLLED.format(where="WHERE date >= DATE '2024-01-26' AND date < DATE '2024-02-01'")}
        SELECT symbol, date, c_u / 10000.0 AS close_price, v AS volume, d_u / 10000.0 AS daily_change,
               p_u / 10000.0 AS daily_change_percent, ma_5, ma_20, volatility_5 FROM rolled""",
    # ---- sorts, limits, top-k
    "latest_price": f"""{_QUOTES} SELECT {_QUOTE_COLUMNS} FROM quote WHERE symbol = 'click'
        ORDER BY timestamp DESC, stock_price_id DESC LIMIT 1""",
    "latest_price_per_symbol": f"""{_QUOTES} SELECT {_QUOTE_COLUMNS} FROM quote
        QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY timestamp DESC, stock_price_id DESC) = 1""",
    "latest_bars": f"{_PART} SELECT * FROM bars ORDER BY date DESC, symbol LIMIT 100",
    "latest_prices_chart": f"""{_QUOTES} SELECT symbol, CAST(price AS DOUBLE) AS price, volume, timestamp
        FROM quote ORDER BY timestamp DESC, stock_price_id DESC LIMIT 20""",
    "first_bar_per_symbol": f"""{_PART} SELECT * FROM bars
        QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date) = 1""",
    "daily_bars": f"{_FIRST_BARS} SELECT * FROM firsts WHERE date = DATE '2024-01-15'",
    "yesterday_bars": f"{_FIRST_BARS} SELECT * FROM firsts WHERE date = DATE '2024-01-14'",
    "history_between_dates": f"""{_USER} SELECT * FROM bars
        WHERE date >= DATE '2024-01-15' AND date < DATE '2024-01-31'""",
    "top_movers": f"""{_USER}, last AS (
        SELECT symbol, max(date) AS date, arg_max(p_u, date) AS p_u, arg_max(c_u, date) AS c_u
        FROM (SELECT symbol, date, coalesce(p_u, 0) AS p_u, c_u FROM bar_u) GROUP BY symbol),
        moved AS (SELECT symbol, date, p_u / 10000.0 AS daily_change_percent,
                         c_u / 10000.0 AS close_price FROM last),
        gainer AS (SELECT *, 'gainer' AS side FROM moved WHERE daily_change_percent > 0
                   ORDER BY daily_change_percent DESC, symbol LIMIT 10),
        loser AS (SELECT *, 'loser' AS side FROM moved WHERE daily_change_percent < 0
                  ORDER BY daily_change_percent, symbol LIMIT 10)
        SELECT * FROM gainer UNION ALL SELECT * FROM loser""",
    # ---- normalisation, validation, messages
    "normalized_bars": f"{_USER} {_ALL_BAR_COLUMNS}",
    "normalized_bars_strict": f"""{_PART} {_ALL_BAR_COLUMNS} WHERE symbol NOT IN
        (SELECT symbol FROM checked WHERE abs(coalesce(p_u, 0)) > 99999999)""",
    "rejected_bars": f"""{_PART} SELECT 'percent out of range' AS reason, count(*) AS rows
        FROM checked WHERE abs(coalesce(p_u, 0)) > 99999999 HAVING count(*) > 0""",
    "concatenated_bars": f"""SELECT * FROM ({_USER} {_ALL_BAR_COLUMNS})
        UNION ALL SELECT * FROM ({_FLAG} {_ALL_BAR_COLUMNS})""",
    "processing_time": "SELECT count(*) AS stamped, 1 AS instants FROM events",
    "validated_stocks": """SELECT 'symbol: missing' AS reason, count(*) AS rows FROM orders WHERE o_orderstatus = 'P'
        HAVING count(*) > 0 UNION ALL SELECT 'symbol: longer than 10', count(*) FROM orders
        WHERE o_orderstatus <> 'P' AND length(o_orderpriority) > 10 HAVING count(*) > 0""",
    "creation_times": f"{_USER} SELECT count(*) AS rows, count(*) AS kept, count(*) AS volume FROM bars",
    "zero_as_null": f"{_USER} {_BLANKED}",
    "validated_bars": f"""{_RECORDS} SELECT o_orderkey, symbol, date, total AS open_price,
        total AS close_price, total AS high_price, CAST(NULL AS DOUBLE) AS low_price,
        total AS adj_close, volume, 0.0::DOUBLE AS daily_change, 0.0::DOUBLE AS daily_change_percent
        FROM record WHERE NOT (bad_date OR bad_symbol OR bad_close)""",
    "validation_report": f"""{_RECORDS}
        SELECT 'date: missing' AS reason, count(*) AS rows FROM record WHERE bad_date
        UNION ALL SELECT 'symbol: longer than 10', count(*) FROM record WHERE bad_symbol
        UNION ALL SELECT 'close_price: more than 4 places', count(*) FROM record WHERE bad_close""",
    "price_range_check": f"""{_QUOTES} SELECT symbol, count(*) AS in_range FROM quote
        WHERE price > 1 AND price < 100 GROUP BY symbol""",
    "bar_shape_check": f"""{_USER} SELECT symbol, date FROM bars
        WHERE open_price BETWEEN low_price AND high_price
          AND close_price BETWEEN low_price AND high_price""",
    "landed_quotes": f"""SELECT 'C' || o_custkey AS symbol, {_units('o_totalprice')} / 10000.0 AS price,
        o_orderkey AS volume, {_units('o_totalprice / 3')} / 10000.0 AS bid,
        CASE WHEN o_orderstatus <> 'F' THEN {_units('o_totalprice / 7')} / 10000.0 END AS ask,
        o_orderdate AS timestamp, 'yahoo_finance' AS source
        FROM orders WHERE o_orderstatus <> 'P'""",
    "validated_prices": """SELECT o_orderkey, o_orderpriority AS symbol, o_totalprice AS price,
        CAST(NULL AS DOUBLE) AS bid, o_totalprice AS ask, o_custkey AS volume, o_orderdate AS timestamp
        FROM orders WHERE o_orderstatus = 'O' AND length(o_orderpriority) <= 10""",
    "duplicate_keys": """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "json_encode": f"""{_QUOTES} SELECT symbol AS key,
        '{{"stock_price_id":"' || stock_price_id || '","symbol":"' || symbol || '","price":"' || price
        || '","volume":' || volume || ',"bid":null,"ask":null,"timestamp":"'
        || regexp_replace(strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%f'), '\\.000000$', '')
        || '","source":"events"}}' AS value FROM quote""",
    "json_decode_strict": f"""{_MESSAGES} SELECT stock_price_id, symbol, price, volume,
        CAST(NULL AS DOUBLE) AS bid, 0.5::DOUBLE AS ask, timestamp,
        CASE status WHEN 'O' THEN 'orders' ELSE 'kafka' END AS source
        FROM message WHERE NOT (bad_symbol OR bad_price)""",
    "json_decode_rejects": f"""{_MESSAGES}
        SELECT 'symbol' AS reason, count(*) AS rows FROM message WHERE bad_symbol
        UNION ALL SELECT 'price', count(*) FROM message WHERE bad_price""",
    "json_decode_permissive": f"""{_MESSAGES} SELECT symbol AS kafka_key,
        timestamp AS kafka_timestamp, stock_price_id, symbol, price, CAST(NULL AS BIGINT) AS volume,
        0.0::DOUBLE AS bid, 0.5::DOUBLE AS ask, timestamp,
        CASE status WHEN 'O' THEN 'orders' END AS source FROM message""",
    # ---- writes
    "upsert_stocks": f"""{_STOCKS} SELECT symbol, upper(company_name) AS company_name,
        CAST(NULL AS VARCHAR) AS sector, is_active FROM part_stock
        UNION ALL SELECT symbol, company_name, sector, is_active FROM customer_stock""",
    "upsert_bars": """
        SELECT 'U' || user_id AS symbol, CAST(ts AS DATE) AS date,
               nullif(arg_max(value, event_id), 0) AS open_price,
               nullif(arg_max(value, event_id), 0) AS close_price,
               nullif(arg_max(value, event_id), 0) AS high_price,
               nullif(arg_max(value, event_id), 0) AS low_price, CAST(NULL AS DOUBLE) AS adj_close,
               CAST(arg_max(json_extract(props, '$.k'), event_id) AS BIGINT) AS volume,
               CAST(NULL AS DOUBLE) AS daily_change, CAST(NULL AS DOUBLE) AS daily_change_percent
        FROM events GROUP BY user_id, CAST(ts AS DATE)""",
    "append_prices": f"""{_QUOTES} SELECT {_QUOTE_COLUMNS} FROM quote
        UNION ALL
        SELECT '10000000-0000-0000-0000-' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0'),
               'C' || o_custkey, o_totalprice, o_custkey, NULL,
               CAST(CAST(o_totalprice AS DECIMAL(12, 2)) + 1 AS DOUBLE),
               TIMESTAMP '2024-01-01' + to_seconds(o_orderkey), 'orders'
        FROM orders""",
    "seed_stocks": f"""{_STOCKS} SELECT symbol, company_name, sector, TRUE AS is_active FROM part_stock
        UNION ALL SELECT symbol, company_name, sector, TRUE FROM customer_stock
        UNION ALL VALUES ('AAPL', 'Apple Inc.', 'Technology', TRUE),
            ('GOOGL', 'Alphabet Inc.', 'Technology', TRUE),
            ('MSFT', 'Microsoft Corporation', 'Technology', TRUE),
            ('AMZN', 'Amazon.com Inc.', 'Consumer Cyclical', TRUE),
            ('META', 'Meta Platforms Inc.', 'Technology', TRUE)""",
    "load_by_position": f"{_QUOTES} SELECT {_QUOTE_COLUMNS} FROM quote",
    "query_with_parameters": f"""{_QUOTES} SELECT symbol, count(*) AS n,
        CAST(max(price) AS DOUBLE) AS highest
        FROM quote WHERE price >= 50 AND symbol <> 'click' GROUP BY symbol""",
    "stored_range_reads": f"""{_USER}, {_QUOTES.replace('WITH', '', 1)}
        SELECT symbol, nullif(close_price, 0) AS price, CAST(date AS TIMESTAMP) AS at FROM bars
        WHERE symbol = 'U7' AND date >= DATE '2024-01-15' AND date <= DATE '2024-01-31'
        UNION ALL SELECT symbol, CAST(price AS DOUBLE), timestamp FROM quote
        WHERE symbol = 'click' AND timestamp >= TIMESTAMP '2024-01-10 12:00:00'""",
    "stored_latest_reads": f"""{_USER}, {_QUOTES.replace('WITH', '', 1)},
        a AS (SELECT symbol, CAST(date AS TIMESTAMP) AS at, 'bars' AS part FROM bars
              ORDER BY date DESC, symbol LIMIT 100),
        b AS (SELECT symbol, timestamp AS at, 'prices' AS part FROM quote
              ORDER BY timestamp DESC, stock_price_id DESC LIMIT 20),
        c AS (SELECT symbol, timestamp AS at, 'price' AS part FROM quote WHERE symbol = 'click'
              ORDER BY timestamp DESC, stock_price_id DESC LIMIT 1)
        SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c""",
    "stored_chart": f"""{_USER} SELECT date, symbol, {_avg('nullif(h_u, 0)')} AS avg_high,
        {_avg('nullif(l_u, 0)')} AS avg_low
        FROM bar_u WHERE date >= DATE '2024-01-24' AND date < DATE '2024-01-31'
        GROUP BY date, symbol ORDER BY date, symbol LIMIT 500""",
    "backfill": f"{_PART} {_BLANKED}",
    "backfill_intraday": f"""{_EVENT}, lasts AS (SELECT * EXCLUDE (ts) FROM bars QUALIFY {_LAST})
        {_BLANKED.replace('FROM bars', 'FROM lasts')}""",
    "daily_etl": f"""{_FIRST_BARS} {_BLANKED.replace('FROM bars', 'FROM firsts')}
        WHERE date IN (DATE '2024-01-15', DATE '2024-01-16')""",
    "run_report": f"""{_FIRST_BARS} SELECT 'daily_etl' AS job, DATE '2024-01-15' AS execution_date,
        'success' AS status, count(*) AS records_loaded FROM firsts WHERE date = DATE '2024-01-15'
        UNION ALL SELECT 'daily_etl', DATE '2000-01-01', 'skipped', 0""",
    # ---- streams
    "sliding_window_stats": f"{_WINDOWS} SELECT * FROM windows",
    "publish_quotes": f"{_QUOTES} SELECT symbol AS key, count(*) AS messages FROM quote GROUP BY symbol",
    "sliding_stats_stream": f"""{_WINDOWS} SELECT * FROM windows
        WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 1 MINUTE""",
    "sliding_stats_late": f"""{_WINDOWS} SELECT * FROM windows
        WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 1 MINUTE""",
    "publish_rounds": "SELECT count(*) AS messages, 3 AS rounds FROM orders WHERE o_orderstatus <> 'P'",
    "sliding_stats_updates": f"{_WINDOWS} SELECT * FROM windows",
    "stream_to_parquet": f"""{_QUOTES} SELECT symbol AS kafka_key, {_QUOTE_COLUMNS} FROM quote""",
    "stream_rejects": f"""{_MESSAGES}
        SELECT CASE WHEN bad_symbol AND bad_price THEN 'symbol; price' WHEN bad_symbol THEN 'symbol'
                    WHEN bad_price THEN 'price' ELSE '' END AS reasons, count(*) AS rows
        FROM message GROUP BY 1""",
    "pipeline_stops_at_n": f"""{_QUOTES} SELECT count(*) AS stored, TRUE AS kept_to_limit,
        count(*) AS written FROM quote""",
    "stream_to_warehouse": f"{_QUOTES} SELECT {_QUOTE_COLUMNS} FROM quote",
}
