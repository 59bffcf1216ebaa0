import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from barlake.operators.sliding import flat_windows, sliding_stats
from barlake.schemas import RAW_QUOTES, TOPIC_RECORDS
from barlake.sources import landing, topics
from barlake.streaming import jobs, sinks

QUOTE = "stock_price_id string, symbol string, price decimal(12,4), volume long, bid decimal(12,4), ask decimal(12,4), timestamp timestamp, source string"
T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def uid(n):
    return f"00000000-0000-0000-0000-{n:012d}"


def quotes(spark, *rows):
    full = [(uid(n), symbol, Decimal(price), 1, None, None, T0 + dt.timedelta(seconds=s), "t") for n, symbol, price, s in rows]
    return spark.createDataFrame(full, QUOTE)


def topic(spark, path, **options):
    return topics.read_topic(spark, {k: str(v) for k, v in options.items()}, "parquet", str(path))


def test_kafka_options():
    options = topics.source_options("broker:9092", max_per_trigger=5)
    assert options == {"kafka.bootstrap.servers": "broker:9092", "subscribe": "stock_prices", "startingOffsets": "earliest",
                       "failOnDataLoss": "false", "maxOffsetsPerTrigger": "5"}
    assert topics.consumer_options("b")["kafka.group.id"] == "stock-price-consumer"
    assert topics.sink_options("b")["kafka.acks"] == "all"


def test_publish_counts_messages(spark, tmp_path):
    frame = quotes(spark, (1, "AAPL", "1", 0), (2, "MSFT", "2", 0)).repartition(3)
    assert topics.publish(frame, fmt="parquet", path=str(tmp_path / "t")) == 2
    rows = spark.read.schema(TOPIC_RECORDS).parquet(str(tmp_path / "t")).collect()
    assert {bytes(r.key) for r in rows} == {b"AAPL", b"MSFT"}


def test_windows_slide(spark):
    rows = flat_windows(sliding_stats(quotes(spark, (1, "A", "1", 0), (2, "A", "3", 60)))).orderBy("window_start").collect()
    assert [(r.window_start.minute, r.trade_count, r.avg_price) for r in rows] == [
        (56, 1, Decimal("1")), (57, 2, Decimal("2")), (58, 2, Decimal("2")), (59, 2, Decimal("2")), (0, 2, Decimal("2")), (1, 1, Decimal("3")),
    ]


def test_stream_equals_batch_on_closed_windows(spark, tmp_path):
    frame = quotes(spark, *[(n, "AB"[n % 2], str(n % 7 + 1), n * 17) for n in range(120)])
    topics.publish(frame, fmt="parquet", path=str(tmp_path / "t"))
    jobs.run_aggregation_job(topic(spark, tmp_path / "t"), "parquet", str(tmp_path / "out"), str(tmp_path / "cp"), drain=True)
    batch = flat_windows(sliding_stats(frame))
    got = spark.read.schema(batch.schema).parquet(str(tmp_path / "out"))
    last = frame.agg(F.max("timestamp")).first()[0] - dt.timedelta(minutes=1)
    assert sorted(got.collect()) == sorted(batch.filter(F.col("window_end") <= F.lit(last)).collect())


def test_update_mode_keeps_the_newest_state(spark, tmp_path):
    for n in range(3):
        topics.publish(quotes(spark, (n, "A", str(n + 1), 10 * n)), fmt="parquet", path=str(tmp_path / "t"))
    stream = topic(spark, tmp_path / "t", maxFilesPerTrigger=1)
    jobs.keep_latest_windows(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    batch = flat_windows(sliding_stats(quotes(spark, *[(n, "A", str(n + 1), 10 * n) for n in range(3)])))
    assert sorted(jobs.latest_windows(spark, str(tmp_path / "out")).collect()) == sorted(batch.collect())


def test_states_of_windows_are_folded(spark, tmp_path, monkeypatch):
    from barlake.streaming import states

    monkeypatch.setattr(states, "FAN", 3)
    kept = states.WindowStates(spark, str(tmp_path / "states"))
    assert kept.read().isEmpty()
    want = {}
    for number in range(14):
        prices = quotes(spark, (number, "AB"[number % 2], str(number + 1), 0))
        windows = flat_windows(sliding_stats(prices))
        for _ in range(2):  # the second one is sent again
            kept.add(windows, "run", number)
        want["AB"[number % 2]] = number + 1
    assert {(r.symbol, float(r.max_price)) for r in kept.read().collect()} == {(s, float(p)) for s, p in want.items()}
    assert kept.read().count() == 10 and kept.read().columns == windows.columns
    segments = kept.versions.current().parts[""]
    assert len(segments) <= 6 and max(s.level for s in segments) == 2
    # A fold of n micro-batches has the states of the windows, not of the micro-batches.
    assert kept.states().count() <= 10 + 5 * len(segments)
    kept.add(flat_windows(sliding_stats(quotes(spark, (1, "A", "99", 0)))), "another run", 0)
    assert {float(r.max_price) for r in kept.read().filter("symbol = 'A'").collect()} == {99.0}


def test_late_rows_leave_the_windows(spark, tmp_path):
    def push(n, seconds):
        topics.publish(quotes(spark, (n, "A", "1", seconds)), fmt="parquet", path=str(tmp_path / "t"))

    name = "late_rows"
    for n, seconds in enumerate([0, 3600, 3601, 0]):
        push(n, seconds)
        jobs.run_aggregation_job(
            topic(spark, tmp_path / "t"), "parquet", str(tmp_path / "out"), str(tmp_path / "cp"), name, drain=True
        )
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert rows.agg(F.sum("trade_count")).first()[0] == 5  # the first row, in its five windows


def test_console_and_memory_sinks(spark, tmp_path):
    topics.publish(quotes(spark, (1, "0700", "1", 0)), fmt="parquet", path=str(tmp_path / "t"))
    jobs.run_streaming_job(topic(spark, tmp_path / "t"), "memory", name="seen_prices", drain=True)
    assert spark.table("seen_prices").first().symbol == "0700"
    jobs.run_streaming_job(topic(spark, tmp_path / "t"), "console", drain=True)
    jobs.run_aggregation_job(topic(spark, tmp_path / "t"), "memory", name="seen_windows", drain=True)
    assert spark.table("seen_windows").count() == 5


def test_parquet_sink_keeps_symbols_as_text(spark, tmp_path):
    topics.publish(quotes(spark, (1, "0700", "1", 0)), fmt="parquet", path=str(tmp_path / "t"))
    stream = topic(spark, tmp_path / "t")
    jobs.run_streaming_job(stream, "parquet", str(tmp_path / "out"), str(tmp_path / "cp"), drain=True)
    assert (tmp_path / "out" / "symbol=0700").exists()
    from barlake.operators.messages import decode_permissive

    assert spark.read.schema(decode_permissive(stream).schema).parquet(str(tmp_path / "out")).first().symbol == "0700"


def test_unknown_sink_is_refused_before_anything_starts(spark, tmp_path):
    with pytest.raises(ValueError):
        jobs.run_streaming_job(None, "postgres")
    with pytest.raises(ValueError):
        jobs.run_aggregation_job(None, "parquet")


def test_pipeline_to_warehouse(spark, warehouse, tmp_path):
    good = quotes(spark, (1, "A", "1", 0), (2, "A", "2", 86_400), (1, "A", "1", 0))
    topics.publish(good, fmt="parquet", path=str(tmp_path / "t"))
    bad = spark.createDataFrame([(b"k", bytearray(json.dumps({"symbol": "A"}).encode()), T0), (b"k", bytearray(b"junk"), T0)], TOPIC_RECORDS)
    bad.write.mode("append").parquet(str(tmp_path / "t"))
    seen = []

    def consume(checkpoint):
        return jobs.run_consumer_pipeline(
            topic(spark, tmp_path / "t"), warehouse, str(checkpoint), None, lambda b, i: seen.append(i), str(tmp_path / "bad")
        )

    assert consume(tmp_path / "cp") == 2
    assert len(seen) == 1
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 2
    # Nothing new: nothing written. A late quote is still stored.
    assert consume(tmp_path / "cp") == 0
    topics.publish(quotes(spark, (3, "A", "3", -86_400)), fmt="parquet", path=str(tmp_path / "t"))
    assert consume(tmp_path / "cp") == 1
    # A lost checkpoint replays the topic: ids already stored are not stored again.
    assert consume(tmp_path / "other") == 0
    assert warehouse.read("stock_prices").count() == 3


def test_publish_rounds(spark, tmp_path):
    raw = [("AAPL", 1.0, 1, None, None, T0), ("MSFT", None, 1, None, None, T0)]
    for _ in range(3):
        spark.createDataFrame(raw, RAW_QUOTES).coalesce(1).write.mode("append").json(str(tmp_path / "landed"))
    stream = landing.read_landed(spark, str(tmp_path / "landed"), RAW_QUOTES, "json", streaming=True)
    assert stream.isStreaming
    live = landing.normalize_quotes(stream)
    sent = jobs.publish_continuously(
        live, str(tmp_path / "cp"), fmt="parquet", path=str(tmp_path / "out"), drain=True
    )
    assert sum(sent) == 3


def test_publish_stops_after_the_last_round(spark, tmp_path):
    def land(n):
        spark.createDataFrame([("AAPL", float(n), 1, None, None, T0)], RAW_QUOTES).coalesce(1).write.mode("append").json(str(tmp_path / "landed"))

    for n in range(3):
        land(n)
    reader = spark.readStream.schema(RAW_QUOTES).option("maxFilesPerTrigger", 1).json(str(tmp_path / "landed"))
    rounds = []

    def publish(max_rounds):
        return jobs.publish_continuously(
            landing.normalize_quotes(reader), str(tmp_path / "cp"), fmt="parquet", path=str(tmp_path / "out"),
            max_rounds=max_rounds, on_round=lambda b, i: rounds.append(i), drain=True,
        )

    assert publish(2) == [1, 1]
    assert publish(None) == [1]
    assert rounds == [0, 1, 2]


def test_resent_quotes_are_dropped_within_the_horizon(spark, tmp_path):
    topics.publish(quotes(spark, (1, "A", "1", 0), (1, "A", "1", 0), (2, "A", "1", 1)), fmt="parquet", path=str(tmp_path / "t"))
    from barlake.operators.messages import decode_permissive

    rows = jobs.without_resent(decode_permissive(topic(spark, tmp_path / "t")), "1 minute")
    sinks.write_memory(rows, "once", drain=True).awaitTermination()
    assert spark.table("once").count() == 2


def test_pipeline_stops_at_max_messages_and_resumes(spark, warehouse, tmp_path):
    for n in range(4):
        topics.publish(quotes(spark, (n, "A", "1", n)), fmt="parquet", path=str(tmp_path / "t"))

    def consume(limit):
        stream = topic(spark, tmp_path / "t", maxFilesPerTrigger=1)
        return jobs.run_consumer_pipeline(stream, warehouse, str(tmp_path / "cp"), limit)

    assert consume(2) == 2
    assert consume(0) == 2
    assert warehouse.read("stock_prices").count() == 4


def test_append_sink(spark, warehouse, tmp_path):
    from barlake.operators.messages import decode_strict

    topics.publish(quotes(spark, (1, "A", "1", 0), (2, "A", "2", 1)), fmt="parquet", path=str(tmp_path / "t"))
    counts = []
    for checkpoint in ("a", "b"):
        rows = decode_strict(topic(spark, tmp_path / "t"))
        sinks.append_to_warehouse(
            rows, warehouse, str(tmp_path / checkpoint), on_written=counts.append, drain=True
        ).awaitTermination()
    assert counts == [2, 0]


def test_a_first_batch_beyond_the_limit_is_an_error(spark, warehouse, tmp_path):
    topics.publish(quotes(spark, *[(n, "A", "1", n) for n in range(5)]), fmt="parquet", path=str(tmp_path / "t"))
    with pytest.raises(StreamingQueryException, match="limit the source per trigger"):
        jobs.run_consumer_pipeline(topic(spark, tmp_path / "t"), warehouse, str(tmp_path / "cp"), 2)
    assert warehouse.read("stock_prices").isEmpty()


def test_errors_of_a_batch_are_raised_with_a_limit_too(spark, warehouse, tmp_path):
    topics.publish(quotes(spark, (1, "A", "1", 0)), fmt="parquet", path=str(tmp_path / "t"))

    def fail(batch, batch_id):
        raise RuntimeError("broken callback")

    with pytest.raises(StreamingQueryException, match="broken callback"):
        jobs.run_consumer_pipeline(topic(spark, tmp_path / "t"), warehouse, str(tmp_path / "cp"), 1, on_process=fail)


def test_quarantines_of_two_checkpoints_stay_apart(spark, warehouse, tmp_path):
    raw = "key binary, value binary, timestamp timestamp"
    for n in range(2):
        path = str(tmp_path / f"t{n}")
        rows = spark.createDataFrame([(b"A", b"junk %d" % n, dt.datetime(2024, 1, 1))], raw)
        rows.write.parquet(path)
        jobs.run_consumer_pipeline(topic(spark, path), warehouse, str(tmp_path / f"cp{n}"), quarantine=str(tmp_path / "bad"))
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 2


def test_windows_of_a_new_checkpoint_replace_the_old_ones(spark, tmp_path):
    path = str(tmp_path / "w")
    for n in range(2):
        topics.publish(quotes(spark, (n, "A", str(5 + n), 0)), fmt="parquet", path=str(tmp_path / "t"))
        jobs.keep_latest_windows(topic(spark, tmp_path / "t", maxFilesPerTrigger=1), path, str(tmp_path / f"cp{n}")).awaitTermination()
    got = {(r.trade_count, float(r.max_price)) for r in jobs.latest_windows(spark, path).collect()}
    assert got == {(2, 6.0)}


def test_a_large_topic_file_has_several_row_groups(spark, tmp_path, monkeypatch):
    import pyarrow.parquet as pq

    from barlake.sources import topics

    monkeypatch.setattr(topics, "ROW_GROUP", 1 << 18)
    path = str(tmp_path / "topic")
    quotes = spark.range(20_000).select(
        F.uuid().alias("stock_price_id"), F.lit("A").alias("symbol"), F.lit(1).alias("price"),
        F.lit(1).alias("volume"), F.lit(0).alias("bid"), F.lit(2).alias("ask"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id")).alias("timestamp"), F.lit("x").alias("source"),
    )
    assert topics.publish(quotes.coalesce(1), fmt="parquet", path=path) == 20_000
    files = list((tmp_path / "topic").glob("*.parquet"))
    assert len(files) == 1 and pq.ParquetFile(files[0]).num_row_groups > 3


def test_the_limited_pipeline_reads_the_events_few_times(spark, tmp_path, monkeypatch):
    """One publishing job writes the ten files of the topic."""
    from barlake.plans import registry
    from barlake.sources import topics

    rows = spark.range(200).select(
        F.when(F.col("id") != 7, F.col("id")).alias("event_id"), F.lit("view").alias("event_type"),
        F.lit(2.5).alias("value"), F.lit('{"k": 1}').alias("props"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id")).alias("ts"),
    )
    rows.write.parquet(str(tmp_path / "events.parquet"))
    sent, publish = [], topics.publish
    monkeypatch.setattr(registry.topics, "publish", lambda *a, **k: sent.append((publish(*a, **k), k["path"])))
    result = registry.REGISTRY["pipeline_stops_at_n"](spark, str(tmp_path)).first()
    assert [n for n, _ in sent] == [199] and tuple(result) == (199, True, 199)
    assert len(spark.read.parquet(sent[0][1]).inputFiles()) == 10
