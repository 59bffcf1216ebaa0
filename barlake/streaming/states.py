"""Sliding-window states that are updated as quotes arrive, read as one row for each window."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType, TimestampType

from barlake import schemas
from barlake.operators.sliding import flat_windows, sliding_stats
from barlake.sources.snapshots import Files, Segment, Version, Versions

# So many segments of a level are folded into one of the next.
FAN = 8
_KEY = ["symbol", "window_start", "window_end"]
_ORDER = ["written_at", "batch_id"]


class WindowStates:
    """Changed windows of each micro-batch as a segment. Eight segments of a level are folded
    into one that has the newest state of their windows, so what a read opens grows with the
    windows and the logarithm of the micro-batches, not with the micro-batches. A version
    names the segments and the last micro-batch of each run: a reader sees a fold or none of
    it, and a micro-batch sent again changes nothing."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.versions = Versions(Files(spark), self.path, None)

    def schema(self) -> StructType:
        windows = flat_windows(sliding_stats(self.spark.createDataFrame([], schemas.STOCK_PRICES))).schema
        return StructType(windows.fields).add("written_at", TimestampType()).add("batch_id", LongType())

    def add(self, windows: DataFrame, run: str, batch_id: int) -> None:
        version = self.versions.current()
        if version.ledger.get(run, -1) >= batch_id:
            return
        stamped = windows.withColumn("written_at", F.lit(dt.datetime.now(dt.timezone.utc)))
        segment = self._write(stamped.withColumn("batch_id", F.lit(batch_id).cast("long")), 0)
        segments = [*version.parts.get("", []), segment]
        version = self.versions.publish(
            replace(version, parts={"": segments}, ledger={**version.ledger, run: batch_id})
        )
        self._fold(version)

    def _fold(self, version: Version) -> None:
        segments = version.parts[""]
        for level in sorted({s.level for s in segments}):
            same = [s for s in segments if s.level == level]
            if len(same) >= FAN:
                folded = self._write(newest_states(self._states(same)), level + 1)
                left = [s for s in segments if s not in same]
                self.versions.publish(replace(version, parts={"": [*left, folded]}))
                return

    def _write(self, states: DataFrame, level: int) -> Segment:
        segment = Segment(uuid.uuid4().hex, 0, level)
        states.write.parquet(f"{self.path}/{Version.folder(None, '', segment)}")
        return segment

    def _states(self, segments: list[Segment]) -> DataFrame:
        schema = self.schema()
        if not segments:
            return self.spark.createDataFrame([], schema)
        folders = [f"{self.path}/{Version.folder(None, '', s)}" for s in segments]
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*folders).select(*schema.names)

    def states(self) -> DataFrame:
        """All states that are kept, with when and in which micro-batch they were written."""
        return self._states(self.versions.current().parts.get("", []))

    def read(self) -> DataFrame:
        """The newest state of each window."""
        return newest_states(self.states()).drop(*_ORDER)


def newest_states(states: DataFrame) -> DataFrame:
    """One row for each window, by the time its micro-batch was written."""
    rest = [c for c in states.columns if c not in (*_KEY, *_ORDER)]
    newest = F.max(F.struct(*_ORDER, *rest)).alias("newest")
    return states.groupBy(*_KEY).agg(newest).select(*_KEY, *[f"newest.{c}" for c in (*rest, *_ORDER)])
