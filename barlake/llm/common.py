"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.session import shared_dir

# Words are runs of anything but ASCII white space; the same class in Java and RE2 syntax.
WORDS = r"[^\x20\x09-\x0D]+"

# Rows of an Arrow batch. Texts of a hundred thousand characters then stay within some
# hundred megabytes in a Python worker.
BATCH_ROWS = 1000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def staged(frame: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: its lineage ends there, and a
    lost executor costs a read, not the work before."""
    path = shared_dir(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def map_batches(
    frame: DataFrame, columns: list[str], schema: str, begin: Callable[[], Callable[..., Iterable[tuple]]]
) -> DataFrame:
    """Rows of ``schema`` from batches of rows. ``begin`` runs once in a task and returns the
    function that turns lists of the values of ``columns`` into output rows."""
    frame.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    fields = T.StructType.fromDDL(schema).fields
    target = pa.schema([pa.field(field.name, _ARROW[field.dataType.simpleString()]) for field in fields])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = begin()
        for batch in batches:
            yield from to_batches(some(*(column.to_pylist() for column in batch.columns)), target)

    return frame.select(*columns).mapInArrow(work, schema)


def map_rows(
    frame: DataFrame, columns: list[str], schema: str, begin: Callable[[], Callable[..., tuple]]
) -> DataFrame:
    """One row of ``schema`` for each row, as ``map_batches``."""

    def begin_batch() -> Callable[..., Iterable[tuple]]:
        one = begin()
        return lambda *lists: (one(*values) for values in zip(*lists))

    return map_batches(frame, columns, schema, begin_batch)


def to_batches(rows: Iterable[tuple], target: pa.Schema) -> Iterator[pa.RecordBatch]:
    rows = list(rows)
    if rows:
        columns = zip(*rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, field.type) for column, field in zip(columns, target)], schema=target
        )


_ARROW = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "float": pa.float32(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<int>": pa.list_(pa.int32()),
    "array<bigint>": pa.list_(pa.int64()),
    "array<float>": pa.list_(pa.float32()),
    "array<double>": pa.list_(pa.float64()),
}


def word_count(text: Column) -> Column:
    """Number of words of a whole text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")
