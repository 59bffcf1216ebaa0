"""Three Parquet tables with keys: stocks, stock_prices, daily_aggregates.

Layout: prices by day, bars by month; the files of one write are sorted by symbol, large
ones hold disjoint ranges of symbols, so that their statistics stand in for an index. A write
stages its input in a written table (so it is computed once and counted exactly, whatever
tasks are run again), writes the partitions it has rows for once, into a folder of its own,
and publishes them as the table's next version (``snapshots``).

The price table has two indexes, published with it: hashes of all ids with their days, and
the newest day of every symbol. Small segments of a day and of an index are merged by eights.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from barlake import schemas
from barlake.functions.keys import instant, key_uuid
from barlake.operators import ranking
from barlake.operators.merge import merge, one_row_per_key, unseen
from barlake.operators.normalize import (
    with_bar_defaults,
    with_quote_defaults,
    with_stock_defaults,
    zero_bars_as_null,
    zero_quotes_as_null,
)
from barlake.operators.validate import duplicate_keys
from barlake.session import shared_dir
from barlake.sources.snapshots import ConcurrentWrite, Files, Segment, Version, Versions

# Rows of a partition that one task writes; more are dealt to tasks by ranges of symbols.
FILE_ROWS = 1 << 20
# So many segments of one level are merged into one of the next.
FAN = 8
# Keys of a bucket of the id index, and buckets that are looked up one by one.
BUCKET_KEYS = 1 << 21
MOST_BUCKETS = 1 << 12
# Batches up to this are looked up by value: Parquet then consults its Bloom filters.
FEW = 10
# Batches beyond this are shuffled to the ids they are compared with. Files hold like ids in a
# few bytes each, so the planner would take a large batch for a small one and send it whole
# through the driver.
SENT_ROWS = 100_000


class KeyViolation(ValueError):
    """A required column is missing or a key occurs twice."""


@dataclass(frozen=True)
class Table:
    name: str
    schema: StructType
    key: tuple[str, ...]
    partition: StructField | None = None
    order: tuple[str, ...] = ()

    @property
    def stored(self) -> StructType:
        return StructType([*self.schema.fields, *([self.partition] if self.partition else [])])

    def with_partition(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(self.partition.name, self.partition_of()) if self.partition else rows

    def partition_of(self) -> Column:
        if self.partition.name == "day":
            return F.to_date("timestamp")
        return F.date_format("date", "yyyy-MM")

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


STOCKS = Table("stocks", schemas.STOCKS, ("symbol",), order=("symbol",))
STOCK_PRICES = Table(
    "stock_prices",
    schemas.STOCK_PRICES,
    ("stock_price_id",),
    StructField("day", DateType()),
    ("symbol", "timestamp"),
)
DAILY_AGGREGATES = Table(
    "daily_aggregates",
    schemas.DAILY_AGGREGATES,
    ("symbol", "date"),
    StructField("month", StringType()),
    ("symbol", "date"),
)
JOB_RUNS = Table("job_runs", schemas.JOB_RUNS, ())
TABLES = {t.name: t for t in (STOCKS, STOCK_PRICES, DAILY_AGGREGATES, JOB_RUNS)}

_KEYS, _ZONES = "key long, day date, bucket int", "symbol string, day date"


class Warehouse:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.files = Files(spark)

    # ---- tables -------------------------------------------------------------

    def path(self, table: Table) -> str:
        return f"{self.root}/{table.name}"

    def versions(self, table: Table) -> Versions:
        return Versions(self.files, self.path(table), table.partition.name if table.partition else None)

    def create_missing(self) -> Warehouse:
        """Create every table that does not exist; existing ones are left alone."""
        for table in TABLES.values():
            versions = self.versions(table)
            if versions.current().number < 0:
                try:
                    versions.publish(Version())
                except ConcurrentWrite:
                    pass  # created by somebody else
        return self

    def stored(
        self, table: Table, wanted: Callable[[str], bool] | None = None, version: Version | None = None
    ) -> DataFrame:
        """The table, in its newest version unless given, with its partition column;
        ``wanted`` picks partitions by their value before anything is listed or read."""
        version = version or self.versions(table).current()
        return self._segments(
            table, {v: s for v, s in version.parts.items() if wanted is None or wanted(v)}
        )

    def _segments(self, table: Table, parts: dict[str, list[Segment]]) -> DataFrame:
        name = table.partition.name if table.partition else None
        folders = sorted({Version.folder(name, value, s) for value, segments in parts.items() for s in segments})
        if not folders:
            return self.spark.createDataFrame([], table.stored)
        reader = self.spark.read.schema(table.stored).option("basePath", f"{self.path(table)}/data")
        return reader.parquet(*[f"{self.path(table)}/{folder}" for folder in folders]).select(*table.stored.names)

    def read(self, name: str) -> DataFrame:
        table = TABLES[name]
        return self.stored(table).select(*table.schema.names)

    def register_views(self, spans: dict[str, tuple[str, str]] | None = None) -> None:
        """A view of each table, and of partitioned ones ``<name>_stored`` with the partition
        column (``month`` as text, ``day``). ``spans`` limits a table to the partitions
        between two values."""
        for name, table in TABLES.items():
            version = self.versions(table).current()
            low, high = (spans or {}).get(name, ("", "~"))
            rows = self.stored(table, lambda value, a=low, b=high: a <= value <= b, version)
            if name in (spans or {}):
                kind = table.partition.dataType
                for value, beyond in ((low, "__ge__"), (high, "__le__")):
                    if value not in ("", "~"):
                        rows = rows.filter(getattr(F.col(table.partition.name), beyond)(F.lit(value).cast(kind)))
            rows.select(*table.schema.names).createOrReplaceTempView(name)
            if table.partition:
                rows.createOrReplaceTempView(f"{name}_stored")

    def sql(self, text: str, args: list | dict | None = None) -> DataFrame:
        """A query over the tables with bound parameters (``?`` or ``:name``).

        Ranges of ``date`` and ``timestamp`` prune months and days: the filters that
        Spark's optimizer pushes to every scan of a table say which ones can matter.
        """
        query = {"args": args} if args else {}
        if text.lstrip().upper().startswith(("SELECT", "WITH")):
            # One partition of each table is enough to see what is pushed.
            self.register_views({t.name: (v, v) for t in TABLES.values() if t.partition for v in self._any(t)})
            plan = self.spark.sql(f"EXPLAIN FORMATTED {text}", **query).first()[0]
            self.register_views({t.name: span for t in TABLES.values() if t.partition and (span := pushed_span(plan, t))})
        else:
            self.register_views()
        return self.spark.sql(text, **query)

    def _any(self, table: Table) -> list[str]:
        return sorted(self.versions(table).current().parts)[:1]

    # ---- reads that profit from the layout ---------------------------------------

    def bars(self, start: dt.date, end: dt.date) -> DataFrame:
        """All bars of a span, both ends included, from the months concerned only."""
        first, last = f"{start:%Y-%m}", f"{end:%Y-%m}"
        month = F.col("month").between(first, last)
        date = F.col("date").between(F.lit(start), F.lit(end))
        rows = self.stored(DAILY_AGGREGATES, lambda value: first <= value <= last)
        return rows.filter(month & date).select(*DAILY_AGGREGATES.schema.names)

    def bars_between(self, symbol: str, start: dt.date, end: dt.date) -> DataFrame:
        """Bars of a symbol, both ends included."""
        return self.bars(start, end).filter(F.col("symbol") == symbol).orderBy("date")

    def bar_at(self, symbol: str, date: dt.date) -> DataFrame:
        return self.bars_between(symbol, date, date)

    def prices_since(self, symbol: str, since: dt.datetime) -> DataFrame:
        """Prices of a symbol from an instant on, from the days concerned only."""
        first_day = F.to_date(instant(since))
        wanted = (F.col("symbol") == symbol) & (F.col("timestamp") >= instant(since))
        rows = self.stored(STOCK_PRICES).filter((F.col("day") >= first_day) & wanted)
        return rows.select(*STOCK_PRICES.schema.names).orderBy("timestamp", "stock_price_id")

    def latest_price(self, symbol: str) -> DataFrame:
        """At most one row, from the newest day that the symbol has; an unknown symbol reads
        no prices."""
        version = self.versions(STOCK_PRICES).current()
        found = self._zones(version).filter(F.col("symbol") == symbol).agg(F.max("day")).first()
        day = found[0].isoformat() if found[0] else None
        rows = self.stored(STOCK_PRICES, lambda value: value == day, version)
        return ranking.latest_price(rows.select(*STOCK_PRICES.schema.names), symbol)

    def latest_prices(self, limit: int = 20) -> DataFrame:
        return ranking.latest_prices(self._newest(STOCK_PRICES, limit), limit)

    def latest_bars(self, limit: int = 100) -> DataFrame:
        return ranking.latest_bars(self._newest(DAILY_AGGREGATES, limit), limit)

    def _newest(self, table: Table, rows: int) -> DataFrame:
        """Rows of the newest partitions, enough of them to hold the ``rows`` newest ones.

        Days and months are in the order of the rows in them, so the newest rows lie in the
        newest partitions; a version says how many rows each has.
        """
        version = self.versions(table).current()
        newest: set[str] = set()
        for value in sorted(version.parts, reverse=True):
            if sum(map(version.rows, newest)) >= rows:
                break
            newest.add(value)
        return self.stored(table, newest.__contains__, version).select(*table.schema.names)

    # ---- writes ----------------------------------------------------------------

    def discard(self, path: str) -> None:
        self.files.delete(path)

    def _save(self, rows: DataFrame, table: Table, write: str, most: int) -> None:
        """Write rows, sorted by (partition value, order), into the folder of a write.

        ``most`` bounds the rows of a partition. Small partitions are a file each; a large
        one is dealt to tasks by ranges, and no symbol lies in more files than its rows need.
        """
        rows = rows.select(*table.stored.names)
        value = [table.partition.name] if table.partition else []
        order = [*value, *(table.order or table.stored.names[:1])]
        if most > FILE_ROWS:
            dealt = rows.repartitionByRange(*order)
        else:
            dealt = rows.repartition(*value) if value else rows.repartition(1)
        writer = dealt.sortWithinPartitions(*order).write
        (writer.partitionBy(*value) if value else writer).parquet(f"{self.path(table)}/data/write={write}")

    def _counts(self, rows: DataFrame, table: Table, extra: list[Column] | None = None) -> dict[str, tuple]:
        """Rows of each partition value (a calendar month or day each), and aggregates."""
        value = F.col(table.partition.name).cast("string") if table.partition else F.lit("")
        counted = rows.groupBy(value.alias("value")).agg(F.count(F.lit(1)), *(extra or [])).collect()
        return {row[0]: tuple(row)[1:] for row in counted}

    def _missing(self, columns: list[str]) -> list[Column]:
        return [F.count_if(F.col(c).isNull()) for c in columns]

    def _require(self, columns: list[str], counts: list[tuple]) -> None:
        bad = {c: sum(n) for c, n in zip(columns, zip(*counts)) if sum(n)}
        if bad:
            raise KeyViolation(f"rows without a required value: {bad}")

    def _published(self, table: Table, write: str, version: Version) -> None:
        try:
            self.versions(table).publish(version)
        except ConcurrentWrite:
            for folder in ("data", "keys", "zones"):
                self.discard(f"{self.path(table)}/{folder}/write={write}")
            raise

    # ---- upserts ----------------------------------------------------------------

    def upsert_stocks(self, stocks: DataFrame, sequence: str | None = None) -> int:
        """Insert or update by symbol; returns the number of input rows.

        Updates name, sector and updated_at. Id, active flag and created_at of a known
        symbol stay.
        """
        return self._upsert(
            STOCKS,
            with_stock_defaults(stocks),
            last=["company_name", "sector"],
            first=["stock_id", "is_active"],
            stamps=["created_at", "updated_at"],
            updated=["company_name", "sector", "updated_at"],
            sequence=sequence,
        )

    def upsert_bars(
        self, bars: DataFrame, sequence: str | None = None, zero_as_null: bool = True
    ) -> int:
        """Insert or replace by symbol and date; returns the number of input rows.

        A known bar gets all eight values of the new one, missing ones included, and
        keeps its id and created_at. A later row of the batch wins over an earlier one.
        """
        rows = zero_bars_as_null(bars) if zero_as_null else bars
        return self._upsert(
            DAILY_AGGREGATES,
            with_bar_defaults(rows),
            last=schemas.BAR_VALUES,
            first=["daily_aggregate_id"],
            stamps=["created_at"],
            updated=schemas.BAR_VALUES,
            sequence=sequence,
        )

    def _upsert(
        self,
        table: Table,
        rows: DataFrame,
        last: list[str],
        first: list[str],
        stamps: list[str],
        updated: list[str],
        sequence: str | None,
    ) -> int:
        version = self.versions(table).current()
        key = list(table.key)
        types = {f.name: f.dataType for f in table.schema.fields}
        typed = rows.withColumns({c: F.col(c).cast(types[c]) for c in (*key, *last, *first)})
        batch = one_row_per_key(typed, key, last, first, sequence)
        batch = batch.withColumns({c: F.current_timestamp() for c in stamps})
        batch = table.with_partition(batch)

        staged = shared_dir(self.spark, f"{table.name}-batch")
        batch.write.parquet(staged)
        try:
            new = self.spark.read.schema(batch.schema).parquet(staged)
            counts = self._counts(new, table, [F.sum("_copies"), F.max("_copies"), *self._missing(key)])
            self._require(key, [c[3:] for c in counts.values()])
            if any(c[2] > 1 for c in counts.values()) and sequence is None:
                raise KeyViolation(f"{table.name}: rows share a key; name the column that orders them")
            if counts:
                self._merge_in(table, version, new, updated, {v: c[0] for v, c in counts.items()})
        finally:
            self.discard(staged)
        return sum(c[1] for c in counts.values())

    def _merge_in(self, table: Table, version: Version, new: DataFrame, updated: list[str], distinct: dict[str, int]) -> None:
        """The touched partitions, old and new rows merged, written once and published."""
        write = uuid.uuid4().hex
        before = {value: version.rows(value) for value in distinct}
        rows = new
        if any(before.values()):
            rows = merge(self.stored(table, distinct.__contains__, version), new, list(table.key), updated)
        self._save(rows, table, write, max(before[v] + distinct[v] for v in distinct))
        after = {v: c[0] for v, c in self._counts(self._segments(table, {v: [Segment(write, 0)] for v in distinct}), table).items()}
        if any(not max(before[v], distinct[v]) <= after.get(v, 0) <= before[v] + distinct[v] for v in distinct):
            self.discard(f"{self.path(table)}/data/write={write}")
            raise RuntimeError(f"{table.name}: {after} rows from {before} old and {distinct} new ones")
        self._published(table, write, version.with_parts({v: [Segment(write, n)] for v, n in after.items()}))

    # ---- appends ------------------------------------------------------------------

    def append_prices(
        self,
        quotes: DataFrame,
        on_duplicate: str = "error",
        source: str = schemas.QUOTE_SOURCE,
        batch: tuple[str, int] | None = None,
    ) -> int:
        """Append quotes; returns the number of rows added.

        ``on_duplicate='error'`` adds nothing if an id occurs twice in the input or is
        already stored, on whatever day; ``'skip'`` adds each new id once. The check looks
        the ids up in the id index and reads the days of its hits only. ``batch``, a
        stream's id and the number of its micro-batch, is recorded with the rows: one that
        is recorded adds nothing and reads nothing.
        """
        if on_duplicate not in ("error", "skip"):
            raise ValueError("on_duplicate is 'error' or 'skip'")
        table, ids = STOCK_PRICES, ["stock_price_id"]
        version = self.versions(table).current()
        if batch and version.ledger.get(batch[0], -1) >= batch[1]:
            return 0
        types = {f.name: f.dataType for f in table.schema.fields if f.name != "created_at"}
        rows = zero_quotes_as_null(with_quote_defaults(quotes, source))
        rows = rows.select(*[F.col(c).cast(t).alias(c) for c, t in types.items()])
        rows = table.with_partition(rows.withColumn("created_at", F.current_timestamp()))

        staged = shared_dir(self.spark, f"{table.name}-batch")
        picked = shared_dir(self.spark, f"{table.name}-picked")
        rows.write.parquet(staged)
        try:
            fresh = self.spark.read.schema(rows.schema).parquet(staged)
            needed = ["stock_price_id", "symbol", "price", "timestamp"]
            counts = self._counts(fresh, table, self._missing(needed))
            self._require(needed, [c[1:] for c in counts.values()])
            total = sum(c[0] for c in counts.values())
            twice = total > 1 and fresh.agg(F.count_distinct(*ids)).first()[0] < total
            hits = self._days_of(version, fresh, total)
            known = self.stored(table, hits.__contains__, version)
            if on_duplicate == "error":
                if twice or (hits and not known.join(_compared(fresh.select(*ids), total), ids, "left_semi").isEmpty()):
                    raise KeyViolation("stock_price_id occurs twice")
            elif twice or hits:
                rest = [c for c in table.stored.names if c not in ids]
                first = F.min(F.struct("timestamp", *[c for c in rest if c != "timestamp"])).alias("_row")
                single = fresh.groupBy(*ids).agg(first).select(*ids, "_row.*")
                unseen(single, known, ids, shuffled=total > SENT_ROWS).write.parquet(picked)
                fresh = self.spark.read.schema(table.stored).parquet(picked)
                counts = self._counts(fresh, table)
            added = {value: c[0] for value, c in counts.items()}
            if added:
                self._add(table, version, fresh, added, batch)
        finally:
            self.discard(staged)
            self.discard(picked)
        return sum(added.values())

    def _add(self, table: Table, version: Version, rows: DataFrame, added: dict[str, int], batch: tuple[str, int] | None = None) -> None:
        """Write rows of a written table as a new segment, with those of the indexes, and
        publish them; then merge segments that have become many."""
        write, total = uuid.uuid4().hex, sum(added.values())
        parts = {v: [*version.parts.get(v, []), Segment(write, n)] for v, n in added.items()}
        after = version.with_parts(parts)
        jobs = [lambda: self._save(rows, table, write, max(added.values()))]
        if table is STOCK_PRICES:
            keys = rows.select(F.xxhash64("stock_price_id").alias("key"), "day")
            buckets = _buckets(total)
            jobs.append(lambda: self._save_keys(keys, write, buckets))
            jobs.append(lambda: self._save_zones(rows, write))
            after = replace(
                after, keys=[*after.keys, Segment(write, total, 0, buckets)], zones=[*after.zones, Segment(write, total)]
            )
        if batch:
            after = replace(after, ledger={**after.ledger, batch[0]: batch[1]})
        # Independent jobs over the same written rows.
        with ThreadPoolExecutor(len(jobs)) as pool:
            for done in [pool.submit(job) for job in jobs]:
                done.result()
        self._published(table, write, after)
        self._tidy(table)

    # ---- the price table's indexes -----------------------------------------------------

    def _save_keys(self, keys: DataFrame, write: str, buckets: int) -> None:
        """(key, day) by the key's lowest bits, sorted, with Bloom filters."""
        dealt = keys.withColumn("bucket", F.expr(f"cast(key & {buckets - 1} as int)"))
        dealt = dealt.coalesce(1) if buckets == 1 else dealt.repartition(buckets, "bucket")
        writer = dealt.sortWithinPartitions("bucket", "key").write.option("parquet.bloom.filter.enabled#key", "true")
        writer.partitionBy("bucket").parquet(f"{self.path(STOCK_PRICES)}/keys/write={write}")

    def _save_zones(self, rows: DataFrame, write: str) -> None:
        """The newest day of every symbol."""
        newest = rows.groupBy("symbol").agg(F.max("day").alias("day"))
        newest.repartitionByRange(_buckets(1), "symbol").sortWithinPartitions("symbol").write.parquet(
            f"{self.path(STOCK_PRICES)}/zones/write={write}"
        )

    def _index(self, kind: str, segments: list[Segment], schema: str) -> DataFrame:
        if not segments:
            return self.spark.createDataFrame([], schema)
        root = f"{self.path(STOCK_PRICES)}/{kind}"
        reader = self.spark.read.schema(schema).option("basePath", root)
        return reader.parquet(*[f"{root}/write={s.write}" for s in segments])

    def _zones(self, version: Version) -> DataFrame:
        return self._index("zones", version.zones, _ZONES).select("symbol", "day")

    def _days_of(self, version: Version, rows: DataFrame, count: int) -> set[str]:
        """The days that may hold one of these ids: a bounded list, nearly always empty for new
        ids. Hashes may coincide, so the days' own ids decide."""
        if not version.keys or not count:
            return set()
        keys = rows.select(F.xxhash64("stock_price_id").alias("key"))
        index = self._index("keys", version.keys, _KEYS)
        most = max(segment.buckets for segment in version.keys)
        if count <= FEW:
            few = [row[0] for row in keys.collect()]
            index = index.filter(F.col("key").isin(few))
        if 1 < most <= MOST_BUCKETS:
            touched = {row[0] for row in keys.select(F.expr(f"cast(key & {most - 1} as int)")).distinct().collect()}
            if len(touched) < most:
                index = self._touched(version.keys, touched)
        hits = index.join(_compared(keys, count), "key", "left_semi").select(F.col("day").cast("string")).distinct()
        return {row[0] for row in hits.collect()}

    def _touched(self, segments: list[Segment], touched: set[int]) -> DataFrame:
        """The index with only those buckets of every segment that hold such keys."""
        parts = [
            self._index("keys", [s for s in segments if s.buckets == n], _KEYS).filter(
                F.col("bucket").isin(sorted({bucket & (n - 1) for bucket in touched}))
            )
            for n in sorted({s.buckets for s in segments})
        ]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part)
        return whole

    # ---- merging of segments ---------------------------------------------------------

    def _tidy(self, table: Table) -> None:
        """Merge ``FAN`` segments of one level, of a partition or an index, into one of the
        next: a table of n small writes keeps some log(n) segments, and a row is rewritten
        as often."""
        version = self.versions(table).current()
        due = {v: _due(segments) for v, segments in version.parts.items()}
        due = {v: chosen for v, chosen in due.items() if chosen}
        keys, zones = _due(version.keys), _due(version.zones)
        if due or keys or zones:
            self._merge_segments(table, version, due, keys, zones)

    def compact(self, name: str, keep_newest: bool = True) -> int:
        """Merge every partition of several segments, but the newest, into one segment whose
        files hold disjoint ranges of symbols. Returns the number of merged partitions."""
        table = TABLES[name]
        version = self.versions(table).current()
        newest = max(version.parts, default=None) if keep_newest and table.partition else None
        due = {v: segments for v, segments in version.parts.items() if len(segments) > 1 and v != newest}
        if due:
            self._merge_segments(table, version, due, [], [])
        return len(due)

    def _merge_segments(
        self, table: Table, version: Version, due: dict[str, list[Segment]], keys: list[Segment], zones: list[Segment]
    ) -> None:
        write = uuid.uuid4().hex

        def joined(all_: list[Segment], chosen: list[Segment], buckets: int = 1) -> list[Segment]:
            if not chosen:
                return all_
            level = max(s.level for s in chosen) + 1
            return [*[s for s in all_ if s not in chosen], Segment(write, sum(s.rows for s in chosen), level, buckets)]

        jobs: list[Callable[[], None]] = []
        if due:
            most = max(sum(s.rows for s in segments) for segments in due.values())
            jobs.append(lambda: self._save(self._segments(table, due), table, write, most))
        buckets = _buckets(sum(s.rows for s in keys))
        if keys:
            jobs.append(lambda: self._save_keys(self._index("keys", keys, _KEYS).select("key", "day"), write, buckets))
        if zones:
            jobs.append(lambda: self._save_zones(self._index("zones", zones, _ZONES), write))
        with ThreadPoolExecutor(len(jobs)) as pool:
            for done in [pool.submit(job) for job in jobs]:
                done.result()
        parts = {value: joined(version.parts[value], segments) for value, segments in due.items()}
        after = version.with_parts(
            parts, keys=joined(version.keys, keys, buckets), zones=joined(version.zones, zones)
        )
        self._published(table, write, after)

    # ---- other inserts ------------------------------------------------------------------

    def seed_stocks(self, seeds: DataFrame | None = None) -> int:
        """Add the default stocks whose symbol is not there yet; existing rows stay."""
        if seeds is None:
            columns = "symbol string, company_name string, sector string"
            seeds = self.spark.createDataFrame(schemas.SEED_STOCKS, columns)
        one = F.min(F.struct("company_name", "sector")).alias("one")
        single = seeds.groupBy("symbol").agg(one).select("symbol", "one.*")
        rows = unseen(single, self.read("stocks"), ["symbol"])
        rows = rows.select(
            key_uuid(F.col("symbol")).alias("stock_id"),
            "symbol",
            "company_name",
            "sector",
            F.lit(True).alias("is_active"),
            F.current_timestamp().alias("created_at"),
            F.current_timestamp().alias("updated_at"),
        )
        return self._append_staged(STOCKS, rows)

    def load(self, rows: DataFrame, name: str) -> int:
        """Insert a frame's columns by position; returns the number of rows.

        Keys and required columns are checked as for any insert.
        """
        table = TABLES[name]
        if len(rows.columns) != len(table.schema.fields):
            raise ValueError(f"{name} has {len(table.schema.fields)} columns, got {len(rows.columns)}")
        typed = rows.toDF(*table.schema.names).select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema.fields]
        )
        return self._append_staged(table, typed)

    def _append_staged(self, table: Table, rows: DataFrame) -> int:
        version = self.versions(table).current()
        staged = shared_dir(self.spark, f"{table.name}-batch")
        table.with_partition(rows).write.parquet(staged)
        try:
            new = self.spark.read.schema(table.stored).parquet(staged)
            counts = self._counts(new, table, self._missing(table.required))
            self._require(table.required, [c[1:] for c in counts.values()])
            added = {value: c[0] for value, c in counts.items()}
            for key in {table.key, (table.schema.names[0],)} if table.key and added else ():
                if not (duplicate_keys(new, list(key)).isEmpty() and self._absent(table, version, new, key, added)):
                    raise KeyViolation(f"{table.name}: {key} occurs twice")
            if added:
                self._add(table, version, new, added)
        finally:
            self.discard(staged)
        return sum(added.values())

    def _absent(self, table: Table, version: Version, new: DataFrame, key: tuple[str, ...], added: dict[str, int]) -> bool:
        """Whether no row of ``new`` has a key that is stored. Prices are looked up in the id
        index, bars in their months; other ids are compared with those of the whole table."""
        wanted = None
        if table is STOCK_PRICES:
            wanted = self._days_of(version, new, sum(added.values())).__contains__
        elif key == DAILY_AGGREGATES.key:
            wanted = added.__contains__
        known = self.stored(table, wanted, version).select(*key)
        return known.join(new.select(*key), list(key), "left_semi").isEmpty()

    def log_run(self, job: str, execution_date: dt.date | None, status: str, loaded: int) -> DataFrame:
        """Append one report row and return it."""
        row = self.spark.createDataFrame(
            [(job, execution_date, status, loaded)],
            "job string, execution_date date, status string, records_loaded long",
        ).withColumn("completed_at", F.lit(dt.datetime.now(dt.timezone.utc)))
        self._add(JOB_RUNS, self.versions(JOB_RUNS).current(), row, {"": 1})
        return row


def pushed_span(plan: str, table: Table) -> tuple[str, str] | None:
    """The partition values that the scans of a table in a formatted plan can need, by the
    comparisons of its date or timestamp that are pushed to all of them. None: any value."""
    column, width = ("timestamp", 10) if table.partition.name == "day" else ("date", 7)
    spans = []
    for node in re.split(r"\n\n+", plan):
        if "Scan parquet" in node and f"/{table.name}/data" in node:
            pushed = re.search(r"^PushedFilters: \[(.*)\]$", node, re.M)
            found = {"<": "~", ">": ""}
            for part in _top_level(pushed.group(1) if pushed else ""):
                match = re.match(rf"(EqualTo|(?:Greater|Less)Than(?:OrEqual)?)\({column},(\d{{4}}-\d\d-\d\d)", part)
                if match:
                    day = dt.date.fromisoformat(match.group(2))
                    if column == "date" and match.group(1) in ("GreaterThan", "LessThan"):
                        day += dt.timedelta(days=1 if match.group(1) == "GreaterThan" else -1)
                    value = day.isoformat()[:width]
                    if not match.group(1).startswith("Less"):
                        found[">"] = max(found[">"], value)
                    if not match.group(1).startswith("Greater"):
                        found["<"] = min(found["<"], value)
            spans.append((found[">"], found["<"]))
    span = min((s[0] for s in spans), default=""), max((s[1] for s in spans), default="~")
    return None if span == ("", "~") else span


def _top_level(listed: str) -> list[str]:
    """The members of a list, brackets kept whole."""
    members, depth = [""], 0
    for sign in listed:
        depth += (sign in "([") - (sign in ")]")
        if sign == "," and not depth:
            members.append("")
        else:
            members[-1] += sign
    return [member.strip() for member in members]


def _compared(rows: DataFrame, count: int) -> DataFrame:
    """The smaller side of a join, which may be sent to every task only if it is small."""
    return rows.hint("merge") if count > SENT_ROWS else rows


def _buckets(keys: int) -> int:
    """A power of two."""
    return 1 << max(0, -(-keys // BUCKET_KEYS) - 1).bit_length()


def _due(segments: list[Segment]) -> list[Segment]:
    """The segments of the lowest level that has become full."""
    for level in sorted({s.level for s in segments}):
        same = [s for s in segments if s.level == level]
        if len(same) >= FAN:
            return same
    return []
