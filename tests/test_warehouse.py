import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from barlake import schemas
from barlake.sources import snapshots
from barlake.sources import warehouse as warehouse_module
from barlake.sources.snapshots import ConcurrentWrite, Versions
from barlake.sources.warehouse import DAILY_AGGREGATES, STOCK_PRICES, KeyViolation

NOW = dt.datetime(2024, 1, 1, 12)
QUOTE = "stock_price_id string, symbol string, price decimal(12,4), volume long, bid decimal(12,4), ask decimal(12,4), timestamp timestamp, source string"
BAR = "symbol string, date date, open_price decimal(12,4), close_price decimal(12,4), high_price decimal(12,4), low_price decimal(12,4), adj_close decimal(12,4), volume long, daily_change decimal(12,4), daily_change_percent decimal(8,4), seq long"


def bar(symbol, date, close, seq=0, change="1", volume=1):
    price = None if close is None else Decimal(close)
    return (symbol, date, Decimal("148.50"), price, Decimal("151"), Decimal("147.80"), price, volume, Decimal(change), Decimal(change), seq)


def quote(id_, symbol="AAPL", price="150", at=NOW, bid=None):
    return (id_, symbol, Decimal(price), 1, bid, None, at, "test")


def test_create_missing_is_idempotent(spark, warehouse):
    warehouse.upsert_stocks(spark.createDataFrame([("AAPL", "Apple", "Tech")], "symbol string, company_name string, sector string"))
    warehouse.create_missing()
    assert warehouse.read("stocks").count() == 1
    assert warehouse.read("daily_aggregates").columns == schemas.DAILY_AGGREGATES.names
    assert warehouse.read("stock_prices").isEmpty()


def test_stock_upsert_keeps_id_flag_and_creation(spark, warehouse):
    schema = "symbol string, company_name string, sector string, is_active boolean"
    assert warehouse.upsert_stocks(spark.createDataFrame([("AAPL", "Apple", "Tech", False)], schema)) == 1
    before = warehouse.read("stocks").first()
    rows = [("AAPL", "Apple Inc.", None, True), ("MSFT", "Microsoft", "Tech", True)]
    assert warehouse.upsert_stocks(spark.createDataFrame(rows, schema)) == 2
    after = {r.symbol: r for r in warehouse.read("stocks").collect()}
    aapl = after["AAPL"]
    assert (aapl.company_name, aapl.sector, aapl.is_active) == ("Apple Inc.", None, False)
    assert (aapl.stock_id, aapl.created_at) == (before.stock_id, before.created_at)
    assert aapl.updated_at >= before.updated_at
    assert after["MSFT"].is_active


def test_bar_upsert_replaces_values_even_with_null(spark, warehouse):
    day = dt.date(2024, 1, 1)
    warehouse.upsert_bars(spark.createDataFrame([bar("AAPL", day, "150.25"), bar("AAPL", dt.date(2024, 2, 1), "1")], BAR))
    before = warehouse.bar_at("AAPL", day).first()
    warehouse.upsert_bars(spark.createDataFrame([bar("AAPL", day, None, change="0", volume=0), bar("NEW", day, "2")], BAR))
    after = warehouse.bar_at("AAPL", day).first()
    assert (after.close_price, after.adj_close, after.daily_change, after.volume) == (None, None, None, 0)
    assert (after.daily_aggregate_id, after.created_at) == (before.daily_aggregate_id, before.created_at)
    assert warehouse.read("daily_aggregates").count() == 3
    assert warehouse.bar_at("AAPL", dt.date(2024, 2, 1)).first().close_price == Decimal("1")


def test_zero_can_be_kept(spark, warehouse):
    day = dt.date(2024, 1, 1)
    warehouse.upsert_bars(spark.createDataFrame([bar("AAPL", day, "1", change="0")], BAR), zero_as_null=False)
    assert warehouse.read("daily_aggregates").first().daily_change == Decimal(0)


def test_later_duplicate_wins_and_first_id_stays(spark, warehouse):
    day = dt.date(2024, 1, 1)
    rows = spark.createDataFrame([bar("A", day, "1", 1), bar("A", day, "3", 3), bar("A", day, "2", 2), bar("B", day, "9", 4)], BAR)
    rows = rows.withColumn("daily_aggregate_id", F.concat(F.lit("id"), "seq"))
    assert warehouse.upsert_bars(rows, sequence="seq") == 4
    got = {r.symbol: (r.close_price, r.daily_aggregate_id) for r in warehouse.read("daily_aggregates").collect()}
    assert got == {"A": (Decimal("3"), "id1"), "B": (Decimal("9"), "id4")}


def test_empty_input_counts_zero(spark, warehouse):
    assert warehouse.upsert_bars(spark.createDataFrame([], BAR)) == 0
    assert warehouse.append_prices(spark.createDataFrame([], QUOTE)) == 0
    assert warehouse.load(spark.createDataFrame([], schemas.STOCKS), "stocks") == 0


def test_random_upserts_match_a_dict(spark, warehouse):
    rng = random.Random(5)
    model = {}
    for step in range(4):
        rows = []
        for seq in range(25):
            key = (rng.choice("ABC"), dt.date(2024, rng.randint(1, 3), rng.randint(1, 4)))
            close = rng.choice([None, str(rng.randint(1, 99))])
            rows.append(bar(*key, close, seq))
            model[key] = None if close is None else Decimal(close)
        warehouse.upsert_bars(spark.createDataFrame(rows, BAR).repartition(3), sequence="seq")
        got = {(r.symbol, r.date): r.close_price for r in warehouse.read("daily_aggregates").collect()}
        assert got == model, step


def test_missing_key_is_refused(spark, warehouse):
    with pytest.raises(KeyViolation):
        warehouse.upsert_bars(spark.createDataFrame([bar(None, dt.date(2024, 1, 1), "1")], BAR))
    assert warehouse.read("daily_aggregates").isEmpty()


def test_only_touched_months_are_rewritten(spark, warehouse):
    jan, feb = dt.date(2024, 1, 5), dt.date(2024, 2, 5)
    warehouse.upsert_bars(spark.createDataFrame([bar("A", jan, "1"), bar("A", feb, "1")], BAR))
    before = warehouse.versions(DAILY_AGGREGATES).current()
    warehouse.upsert_bars(spark.createDataFrame([bar("A", feb, "2"), bar("B", feb, "2")], BAR))
    after = warehouse.versions(DAILY_AGGREGATES).current()
    assert after.parts["2024-01"] == before.parts["2024-01"] and after.rows("2024-02") == 2
    assert not {s.write for s in after.parts["2024-02"]} & {s.write for s in before.parts["2024-02"]}


def test_readers_see_a_table_before_a_write_or_after_it(spark, warehouse, monkeypatch):
    """The table is read around every file operation and every save of an upsert and an append."""
    jan = dt.date(2024, 1, 5)
    warehouse.upsert_bars(spark.createDataFrame([bar("A", jan, "1"), bar("B", jan, "1")], BAR))
    warehouse.append_prices(spark.createDataFrame([quote("a")], QUOTE))
    seen = []

    def look():
        bars = {r.symbol: int(r.close_price) for r in warehouse.read("daily_aggregates").collect()}
        seen.append((tuple(sorted(bars.items())), warehouse.read("stock_prices").count()))

    def watched(owner, name):
        real = getattr(owner, name)

        def wrapped(*args, **named):
            look()
            found = real(*args, **named)
            look()
            return found

        monkeypatch.setattr(owner, name, wrapped)

    for name in ("create", "delete"):
        watched(type(warehouse.files), name)
    for name in ("_save", "_save_keys", "_save_zones", "_published"):
        watched(type(warehouse), name)
    warehouse.upsert_bars(spark.createDataFrame([bar("A", jan, "2"), bar("C", jan, "2")], BAR))
    warehouse.append_prices(spark.createDataFrame([quote("b"), quote("c")], QUOTE))
    monkeypatch.undo()
    old, new = (("A", 1), ("B", 1)), (("A", 2), ("B", 1), ("C", 2))
    steps = [step for at, step in enumerate(seen) if not at or step != seen[at - 1]]
    assert steps == [(old, 1), (new, 1), (new, 3)] and len(seen) > 15


def test_a_write_lost_before_it_is_published_leaves_no_trace(spark, warehouse, monkeypatch):
    jan = dt.date(2024, 1, 5)
    warehouse.upsert_bars(spark.createDataFrame([bar("A", jan, "1"), bar("B", jan, "1")], BAR))
    with monkeypatch.context() as patch:
        patch.setattr(type(warehouse), "_published", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            warehouse.upsert_bars(spark.createDataFrame([bar("A", jan, "7")], BAR))
    assert {r.close_price for r in warehouse.read("daily_aggregates").collect()} == {Decimal(1)}
    warehouse.upsert_bars(spark.createDataFrame([bar("A", jan, "2")], BAR))
    got = {r.symbol: r.close_price for r in warehouse.read("daily_aggregates").collect()}
    assert got == {"A": Decimal("2"), "B": Decimal("1")}


def test_of_two_writers_one_is_refused(spark, warehouse, monkeypatch):
    first = warehouse.versions(STOCK_PRICES).current()
    warehouse.append_prices(spark.createDataFrame([quote("a")], QUOTE))
    with monkeypatch.context() as patch:  # a writer that began before
        patch.setattr(Versions, "current", lambda self: first)
        with pytest.raises(ConcurrentWrite):
            warehouse.append_prices(spark.createDataFrame([quote("b")], QUOTE))
    assert [r.stock_price_id for r in warehouse.read("stock_prices").collect()] == ["a"]
    assert len(warehouse.files.names(f"{warehouse.path(STOCK_PRICES)}/data")) == 1
    assert warehouse.append_prices(spark.createDataFrame([quote("b")], QUOTE)) == 1


def test_old_versions_and_their_folders_go(spark, warehouse, monkeypatch):
    monkeypatch.setattr(snapshots, "KEPT", 2)
    jan, feb = dt.date(2024, 1, 5), dt.date(2024, 2, 5)
    warehouse.upsert_bars(spark.createDataFrame([bar("A", feb, "9")], BAR))
    for close in range(1, 6):
        warehouse.upsert_bars(spark.createDataFrame([bar("A", jan, str(close))], BAR))
    path = warehouse.path(DAILY_AGGREGATES)
    assert len(warehouse.files.names(f"{path}/_versions")) <= 4
    months = [m for w in warehouse.files.names(f"{path}/data") for m in warehouse.files.names(f"{path}/data/{w}")]
    assert months.count("month=2024-02") == 1 and months.count("month=2024-01") == 2
    assert sorted(r.close_price for r in warehouse.read("daily_aggregates").collect()) == [5, 9]


def batch_of(spark, number, size=6, day=0):
    rows = [quote(f"b{number}-{n}", f"S{n % 4}", "1", NOW + dt.timedelta(days=day, seconds=number)) for n in range(size)]
    return spark.createDataFrame(rows, QUOTE)


def test_small_batches_keep_the_table_small(spark, warehouse):
    """After many micro-batches the folders of a day and of the indexes stay few, and an
    append looks ids up without opening a price file."""
    days = [
        (f"d{n}", f"S{n % 50}", Decimal(1), 1, None, None, NOW - dt.timedelta(days=n), "test") for n in range(1000)
    ]
    warehouse.append_prices(spark.createDataFrame(days, QUOTE).repartition(2))
    opened = []
    real = type(warehouse)._segments

    def counted(self, table, parts):
        opened.append(sum(map(len, parts.values())))
        return real(self, table, parts)

    for number in range(20):
        version = warehouse.versions(STOCK_PRICES).current()
        new = batch_of(spark, number)
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(type(warehouse), "_segments", counted)
            patch.setattr(type(warehouse), "_tidy", lambda *_: None)
            assert warehouse.append_prices(new, "skip", batch=("stream", number)) == 6
        warehouse._tidy(STOCK_PRICES)
        assert opened == [0] * (number + 1)
        assert len(version.keys) <= 2 * 8 and len(version.zones) <= 2 * 8
    version = warehouse.versions(STOCK_PRICES).current()
    assert max(map(len, version.parts.values())) <= 2 * 8 and version.rows("2024-01-01") == 121
    assert warehouse.append_prices(batch_of(spark, 3), "skip") == 0
    assert opened[-1] == 0 and warehouse.read("stock_prices").count() == 1120
    with pytest.raises(KeyViolation):
        warehouse.append_prices(batch_of(spark, 3))
    assert warehouse.compact("stock_prices", keep_newest=False) == 1
    assert len(warehouse.versions(STOCK_PRICES).current().parts["2024-01-01"]) == 1
    assert warehouse.read("stock_prices").count() == 1120
    assert warehouse.latest_price("S3").first().stock_price_id.startswith("b19-")


@pytest.mark.parametrize("few", [0, 10])
def test_ids_are_found_in_buckets_and_merged_segments(spark, warehouse, monkeypatch, few):
    monkeypatch.setattr(warehouse_module, "BUCKET_KEYS", 40)
    monkeypatch.setattr(warehouse_module, "FAN", 3)
    monkeypatch.setattr(warehouse_module, "FEW", few)
    for number in range(7):
        assert warehouse.append_prices(batch_of(spark, number, 150 if number == 2 else 30, day=number)) == (150 if number == 2 else 30)
    version = warehouse.versions(STOCK_PRICES).current()
    assert max(s.buckets for s in version.keys) >= 8 and max(s.level for s in version.keys) >= 1
    for number in (0, 2, 6):
        again = batch_of(spark, number, 3).unionByName(batch_of(spark, number + 100, 2))
        assert warehouse.append_prices(again, "skip") == 2
    assert warehouse.append_prices(batch_of(spark, 2, 150), "skip") == 0
    assert warehouse.read("stock_prices").count() == 6 * 30 + 150 + 6


def test_a_recorded_batch_reads_nothing(spark, warehouse, monkeypatch):
    assert warehouse.append_prices(batch_of(spark, 1), "skip", batch=("s", 4)) == 6
    version = warehouse.versions(STOCK_PRICES).current()
    assert version.ledger == {"s": 4}
    with monkeypatch.context() as patch:
        patch.setattr(type(warehouse), "_segments", None)
        patch.setattr(type(warehouse), "_index", None)
        assert warehouse.append_prices(batch_of(spark, 1), "skip", batch=("s", 4)) == 0
        assert warehouse.append_prices(batch_of(spark, 1), "skip", batch=("s", 3)) == 0
    assert warehouse.append_prices(batch_of(spark, 2), "skip", batch=("other", 0)) == 6
    assert warehouse.versions(STOCK_PRICES).current().ledger == {"s": 4, "other": 0}


def test_prices_append_and_refuse_known_ids(spark, warehouse):
    first = spark.createDataFrame([quote("a", bid=Decimal(0)), quote("b", "0700")], QUOTE)
    assert warehouse.append_prices(first) == 2
    with pytest.raises(KeyViolation):
        warehouse.append_prices(spark.createDataFrame([quote("c"), quote("a")], QUOTE))
    with pytest.raises(KeyViolation):
        warehouse.append_prices(spark.createDataFrame([quote("d"), quote("d")], QUOTE))
    rows = {r.stock_price_id: r for r in warehouse.read("stock_prices").collect()}
    assert set(rows) == {"a", "b"}
    assert rows["a"].bid is None and rows["b"].symbol == "0700"


def test_prices_skip_known_ids(spark, warehouse):
    warehouse.append_prices(spark.createDataFrame([quote("a")], QUOTE))
    again = spark.createDataFrame([quote("a"), quote("c", price="2"), quote("c", price="2"), quote("d")], QUOTE)
    for _ in range(2):
        warehouse.append_prices(again, on_duplicate="skip")
    assert sorted(r.stock_price_id for r in warehouse.read("stock_prices").collect()) == ["a", "c", "d"]


def test_seed_leaves_existing_stocks_alone(spark, warehouse):
    warehouse.upsert_stocks(spark.createDataFrame([("AAPL", "mine", "x")], "symbol string, company_name string, sector string"))
    assert warehouse.seed_stocks() == 4
    assert warehouse.seed_stocks() == 0
    got = {r.symbol: r.company_name for r in warehouse.read("stocks").collect()}
    assert set(got) == set(schemas.DEFAULT_SYMBOLS) and got["AAPL"] == "mine"


def test_load_by_position(spark, warehouse):
    row = ("a", "AAPL", "150.25", 1, None, None, NOW, "x", NOW)
    frame = spark.createDataFrame([row], "a string, b string, c string, d long, e string, f string, g timestamp, h string, i timestamp")
    assert warehouse.load(frame, "stock_prices") == 1
    assert warehouse.read("stock_prices").first().price == Decimal("150.25")
    with pytest.raises(KeyViolation):
        warehouse.load(frame, "stock_prices")
    with pytest.raises(ValueError):
        warehouse.load(frame.drop("i"), "stock_prices")


def test_sql_with_parameters(spark, warehouse):
    warehouse.append_prices(spark.createDataFrame([quote("a"), quote("b", "MSFT", "400")], QUOTE))
    rows = warehouse.sql("SELECT symbol FROM stock_prices WHERE price > ?", [200]).collect()
    assert [r.symbol for r in rows] == ["MSFT"]
    assert warehouse.sql("SELECT COUNT(*) AS n FROM stocks").first().n == 0


def test_range_reads_prune_partitions(spark, warehouse):
    warehouse.append_prices(spark.createDataFrame([quote("a"), quote("b", at=NOW + dt.timedelta(days=2))], QUOTE))
    since = warehouse.prices_since("AAPL", NOW + dt.timedelta(days=1))
    assert [r.stock_price_id for r in since.collect()] == ["b"]
    plan = since._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "PushedFilters: [IsNotNull(symbol)" in plan
    warehouse.upsert_bars(spark.createDataFrame([bar("A", dt.date(2024, 1, 5), "1")], BAR))
    plan = warehouse.bars_between("A", dt.date(2024, 1, 1), dt.date(2024, 2, 1))._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "month" in filters and "2024-01" in filters, plan


def test_a_hot_month_is_written_by_several_tasks(spark, warehouse, tmp_path, monkeypatch):
    """One month holds most rows: more than one task writes it."""
    monkeypatch.setattr(warehouse_module, "FILE_ROWS", 10_000)
    days = spark.range(40_000).select(
        F.concat(F.lit("S"), (F.col("id") % 2000).cast("string")).alias("symbol"),
        F.when(F.col("id") < 36_000, F.date_add(F.lit("2024-01-01"), (F.col("id") / 2000).cast("int")))
        .otherwise(F.date_add(F.lit("2024-03-01"), (F.col("id") / 2000).cast("int"))).alias("date"),
        *[F.rand(3).cast("decimal(12,4)").alias(c) for c in schemas.BAR_PRICES],
        F.col("id").alias("volume"),
        F.lit(1).cast("decimal(12,4)").alias("daily_change"),
        F.lit(1).cast("decimal(8,4)").alias("daily_change_percent"),
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "300KB")
    try:
        assert warehouse.upsert_bars(days) == 40_000
    finally:
        spark.conf.unset(size)
    table = tmp_path / "warehouse" / "daily_aggregates"
    files = {m.name: len(list(m.glob("*.parquet"))) for m in table.glob("data/*/month=*")}
    assert files["month=2024-01"] > 1 and sum(files.values()) < 8, files
    assert warehouse.read("daily_aggregates").count() == 40_000


def test_many_copies_of_one_key_meet_pre_aggregated(spark, warehouse):
    from barlake.operators.merge import one_row_per_key

    copies = spark.range(50_000).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("S"), "id")).alias("symbol"), "id"
    )
    reduced = one_row_per_key(copies, ["symbol"], ["id"], [], "id")
    hot = reduced.filter("symbol = 'HOT'").first()
    assert (hot.id, hot._copies) == (49_998, 16_667)
    plan = reduced._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_max") and plan.index("partial_max") > plan.index("Exchange")


def test_latest_reads_look_at_the_newest_partitions_first(spark, warehouse):
    rows = [quote(f"q{n:02d}", "OLD" if n == 0 else "AAPL", str(n + 1), NOW + dt.timedelta(days=n)) for n in range(9)]
    warehouse.append_prices(spark.createDataFrame(rows, QUOTE))
    assert [r.price for r in warehouse.latest_prices(3).collect()] == [Decimal(9), Decimal(8), Decimal(7)]
    assert warehouse.latest_price("OLD").first().stock_price_id == "q00"
    assert warehouse.latest_price("AAPL").first().stock_price_id == "q08"
    assert warehouse.latest_price("INVALID").isEmpty()
    assert warehouse.latest_prices(50).count() == 9
    newest = warehouse._newest(STOCK_PRICES, 1)
    assert len(newest.inputFiles()) == 1 and "day=2024-01-09" in newest.inputFiles()[0]
    assert not warehouse.stored(STOCK_PRICES, lambda day: False).inputFiles()
    bars = [bar("A", dt.date(2024, m, 1), str(m)) for m in range(1, 6)] + [bar("B", dt.date(2024, 5, 1), "9")]
    warehouse.upsert_bars(spark.createDataFrame(bars, BAR))
    assert [(r.symbol, r.date.month) for r in warehouse.latest_bars(3).collect()] == [("A", 5), ("B", 5), ("A", 4)]
    assert warehouse.bars(dt.date(2024, 2, 1), dt.date(2024, 3, 1)).count() == 2


def test_latest_reads_of_empty_tables(warehouse):
    assert warehouse.latest_bars().isEmpty() and warehouse.latest_price("A").isEmpty()


def test_files_of_a_month_hold_disjoint_symbols(spark, warehouse, monkeypatch):
    monkeypatch.setattr(warehouse_module, "FILE_ROWS", 100)
    days = [dt.date(2024, 1, d) for d in range(1, 21)]
    rows = [bar(f"S{n:03d}", day, "1") for n in range(60) for day in days]
    coalesce = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        warehouse.upsert_bars(spark.createDataFrame(rows, BAR))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    stored = warehouse.stored(DAILY_AGGREGATES).withColumn("file", F.input_file_name())
    ranges = sorted((r.low, r.high) for r in stored.groupBy("file").agg(F.min("symbol").alias("low"), F.max("symbol").alias("high")).collect())
    assert len(ranges) > 1 and all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def test_sql_on_a_stored_view_prunes_folders(spark, warehouse):
    for month in (1, 2, 3):
        warehouse.upsert_bars(spark.createDataFrame([bar("A", dt.date(2024, month, 5), "1")], BAR))
    rows = warehouse.sql("SELECT symbol, date FROM daily_aggregates_stored WHERE month = ? AND date >= ?", ["2024-02", dt.date(2024, 2, 1)])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and rows.count() == 1


def test_plain_sql_prunes_by_date_and_timestamp(spark, warehouse):
    months = [bar("A", dt.date(2024, m, 5), str(m)) for m in range(1, 10)]
    warehouse.upsert_bars(spark.createDataFrame(months, BAR))
    warehouse.append_prices(spark.createDataFrame([quote(f"q{n}", at=NOW + dt.timedelta(days=n)) for n in range(9)], QUOTE))

    def folders(frame):
        return sorted({f.split("=")[-1].split("/")[0] for f in frame.inputFiles()})

    cases = [
        ("SELECT * FROM daily_aggregates WHERE date BETWEEN ? AND ?", [dt.date(2024, 3, 1), dt.date(2024, 4, 30)], ["2024-03", "2024-04"], 2),
        ("SELECT * FROM daily_aggregates WHERE date = :d", {"d": dt.date(2024, 3, 5)}, ["2024-03"], 1),
        ("SELECT * FROM daily_aggregates WHERE date > DATE'2024-08-01' AND close_price > 8", None, ["2024-08", "2024-09"], 1),
        ("WITH b AS (SELECT * FROM daily_aggregates) SELECT * FROM b WHERE date < DATE'2024-02-01'", None, ["2024-01"], 1),
        ("SELECT * FROM stock_prices WHERE timestamp >= TIMESTAMP'2024-01-08 00:00:00'", None, ["2024-01-08", "2024-01-09"], 2),
        # Each scan needs another month, or one of two conditions need not hold: no pruning, or that of both.
        ("SELECT a.date FROM daily_aggregates a JOIN daily_aggregates b ON a.symbol = b.symbol WHERE a.date < '2024-02-01' AND b.date < '2024-03-01'", None, ["2024-01", "2024-02"], 2),
        ("SELECT * FROM daily_aggregates WHERE date = DATE'2024-03-05' OR symbol = 'A'", None, [f"2024-0{m}" for m in range(1, 10)], 9),
        ("SELECT a.date FROM daily_aggregates a, daily_aggregates b WHERE a.date = '2024-02-05' AND a.symbol = b.symbol", None, [f"2024-0{m}" for m in range(1, 10)], 9),
    ]
    for text, args, want, count in cases:
        rows = warehouse.sql(text, args)
        assert folders(rows) == want and rows.count() == count, text
    rows = warehouse.sql("SELECT * FROM daily_aggregates WHERE date >= ?", [dt.date(2024, 8, 1)])
    assert "PartitionFilters: [isnotnull(month" in rows._jdf.queryExecution().executedPlan().toString()
    assert warehouse.sql("SELECT COUNT(*) AS n FROM daily_aggregates").first().n == 9


def test_strict_groups_read_their_source_once(spark, tmp_path):
    from barlake.operators.quarantine import accepted_groups

    rows = spark.createDataFrame([("A", ""), ("A", "bad"), ("B", "")], "symbol string, reasons string")
    rows.write.parquet(str(tmp_path / "rows"))
    good = accepted_groups(spark.read.parquet(str(tmp_path / "rows")), "symbol")
    assert [r.symbol for r in good.collect()] == ["B"]
    assert str(tmp_path / "rows") not in "".join(good.inputFiles())


def test_large_batches_are_compared_without_a_broadcast(spark, warehouse, monkeypatch, capsys):
    from barlake.operators.merge import unseen
    from barlake.sources import warehouse as module

    rows = spark.range(20).select(F.col("id").cast("string").alias("stock_price_id"))
    seen = spark.range(10, 30).select(F.col("id").cast("string").alias("stock_price_id"))
    left = unseen(rows, seen, ["stock_price_id"], shuffled=True)
    left.explain()
    assert "Broadcast" not in capsys.readouterr().out
    assert sorted(int(r[0]) for r in left.collect()) == list(range(10))
    monkeypatch.setattr(module, "SENT_ROWS", 0)
    quotes = spark.range(30).select(
        F.col("id").cast("string").alias("stock_price_id"), F.lit("A").alias("symbol"), F.lit(1).alias("price"),
        F.lit(1).alias("volume"), F.lit(0).alias("bid"), F.lit(2).alias("ask"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id")).alias("timestamp"), F.lit("x").alias("source"),
    )
    assert warehouse.append_prices(quotes.filter("stock_price_id < 20"), "skip") == 20
    assert warehouse.append_prices(quotes.unionByName(quotes), "skip") == 10
    with pytest.raises(module.KeyViolation):
        warehouse.append_prices(quotes.limit(15))
    assert warehouse.read("stock_prices").count() == 30
