"""Centroid clustering with heap-ordered bounds, exact on integer vectors.

A vector's gap is how much farther its second nearest centroid lies than its own. When
centroids move, the gap of a vector of cluster j shrinks by no more than the way of centroid
j and the longest way of another one. Each cluster adds these up as its drift and keeps its
vectors in a heap by gap plus the drift at the time of measuring: those whose entry the drift
has reached are popped and measured anew against all centroids, all others stay where they
are without a look.

Vectors are packed into blocks, written once as a bucketed table. A round joins it with the
blocks' heaps, bucketed alike, so neither is shuffled, and writes new heaps together with
what the blocks' sums and counts change by. Centroids are whole numbers on the driver.
"""

from __future__ import annotations

import hashlib
import heapq
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import staged
from barlake.session import shared_dir

SIZE = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
# Vectors of a block; blocks share buckets beyond so many.
BLOCK = 4096
MOST_BUCKETS = 10_000
# Components beyond this would not leave room for an exact squared distance in 64 bits.
LIMIT = 1 << 27
# Float error of distances and drifts, far above what it can be and far below a whole unit.
MARGIN = 1e-3

Heaps = list[list[tuple[float, int]]]


def integers(vectors: DataFrame, columns: tuple[str, str] = ("vec_id", "embedding")) -> DataFrame:
    """(vec_id, v) with v = floor(SCALE * x) of every component. Vectors that are null, have
    another number of components than SIZE, or hold null, non-finite or too large
    components (beyond LIMIT as integers) take no part."""
    rows = vectors.select(F.col(columns[0]).cast("long").alias("vec_id"), F.col(columns[1]).alias("e"))
    odd = F.exists("e", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) > LIMIT / SCALE))
    part = rows.filter((F.size("e") == SIZE) & ~F.coalesce(odd, F.lit(True)))
    return part.select("vec_id", F.transform("e", lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double"))).alias("v"))


def seeds(points: DataFrame, clusters: int = CLUSTERS, salt: str = "3:") -> list[list[int]]:
    """The vectors with the smallest SHA-256 of salt and id; ties by components."""
    draw = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    first = points.orderBy(draw.asc_nulls_last(), "v").limit(clusters)
    return [list(row.v) for row in first.collect()]


# --- one block ---------------------------------------------------------------------------


def distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared, exact."""
    found = np.empty((len(points), len(centroids)), np.int64)
    for number, centroid in enumerate(centroids):
        away = points - centroid
        found[:, number] = np.einsum("ij,ij->i", away, away)
    return found


def measured(points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each point, the smaller number of equal ones, and the gap."""
    away = distances(points, centroids)
    own = away.argmin(axis=1)
    if len(centroids) == 1:
        return own, np.full(len(points), np.inf)
    near = np.sqrt(np.partition(away, 1, axis=1)[:, :2].astype(np.float64))
    return own, near[:, 1] - near[:, 0]


def settle(points: np.ndarray, centroids: np.ndarray, drift: np.ndarray, heaps: Heaps | None) -> tuple[Heaps, np.ndarray, np.ndarray, int]:
    """The heaps after a move of the centroids, by how much the clusters' sums and counts
    change, and how many points were measured. Without heaps all points are new."""
    clusters = len(centroids)
    if heaps is None:
        heaps = [[] for _ in range(clusters)]
        popped, before = np.arange(len(points)), np.full(len(points), -1)
    else:
        out: list[int] = []
        was: list[int] = []
        for cluster, heap in enumerate(heaps):
            while heap and heap[0][0] <= drift[cluster] + MARGIN:
                out.append(heapq.heappop(heap)[1])
                was.append(cluster)
        popped, before = np.array(out, np.int64), np.array(was, np.int64)
    sums, counts = np.zeros((clusters, points.shape[1]), np.int64), np.zeros(clusters, np.int64)
    if len(popped):
        own, gap = measured(points[popped], centroids)
        for entry, member, cluster in zip((drift[own] + gap).tolist(), popped.tolist(), own.tolist()):
            heapq.heappush(heaps[cluster], (entry, member))
        moved = own != before
        np.add.at(sums, own[moved], points[popped[moved]])
        np.add.at(counts, own[moved], 1)
        left = moved & (before >= 0)
        np.subtract.at(sums, before[left], points[popped[left]])
        np.subtract.at(counts, before[left], 1)
    return heaps, sums, counts, len(popped)


# --- on tables ---------------------------------------------------------------------------

_STATE = (
    # Changes: of the clusters' sums, then of their counts, then how many vectors were measured.
    "block long, entries array<double>, members array<int>, sizes array<int>, changes array<long>"
)
_STATE_ARROW = pa.schema([
    ("block", pa.int64()), ("entries", pa.list_(pa.float64())), ("members", pa.list_(pa.int32())),
    ("sizes", pa.list_(pa.int32())), ("changes", pa.list_(pa.int64())),
])
_ANSWER_ARROW = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])


class _Bucketed:
    """Tables bucketed by block, in the shared folder; their names leave the catalog at the end."""

    def __init__(self, spark, buckets: int):
        self.spark, self.buckets, self.names = spark, buckets, []

    def write(self, frame: DataFrame) -> DataFrame:
        name = f"centroids_{uuid.uuid4().hex}"
        self.names.append(name)
        writer = frame.write.bucketBy(self.buckets, "block").sortBy("block")
        writer.option("path", shared_dir(self.spark, "centroids")).saveAsTable(name)
        return self.spark.table(name)

    def forget(self) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


@dataclass
class Clustering:
    """``rows`` (vec_id, cluster, distance) is a written table. ``looked`` says how many
    vectors each assignment but the last measured against all centroids."""

    rows: DataFrame
    centroids: list[list[int]]
    looked: list[int]

    def inertia(self) -> list[int]:
        """The distances summed for each cluster: one number each, exact."""
        summed = self.rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own")).collect()
        found = {row.cluster: int(row.own) for row in summed}
        return [found.get(number, 0) for number in range(len(self.centroids))]

    def digest(self, cluster: Column) -> Column:
        """SHA-256 of a cluster's centroid, components as decimals joined by commas."""
        hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in self.centroids]
        return F.element_at(F.array(*map(F.lit, hashes)), cluster + 1) if hashes else F.lit(None).cast("string")


def _unpacked(row: dict, size: int) -> tuple[np.ndarray, np.ndarray | None, Heaps | None]:
    packed = row["packed"].values
    points = packed.field("v").flatten().to_numpy(zero_copy_only=False).reshape(len(packed), size)
    if "sizes" not in row:
        return points, packed, None
    entries, members = row["entries"].values.to_pylist(), row["members"].values.to_pylist()
    ends = np.cumsum([0, *row["sizes"].values.to_pylist()]).tolist()
    return points, packed, [list(zip(entries[a:b], members[a:b])) for a, b in zip(ends, ends[1:])]


def _round(centroids: list[list[int]], drift: list[float], last: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One assignment of the blocks: new heaps, or, in the last one, the answer."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, moved = np.array(centroids, np.int64), np.array(drift)
        for batch in batches:
            for at in range(len(batch)):
                row = {name: batch.column(name)[at] for name in batch.schema.names}
                points, packed, heaps = _unpacked(row, here.shape[1])
                heaps, sums, counts, looked = settle(points, here, moved, heaps)
                if last:
                    own = np.empty(len(points), np.int64)
                    for cluster, heap in enumerate(heaps):
                        own[[member for _, member in heap]] = cluster
                    away = points - here[own]
                    columns = [packed.field("vec_id"), pa.array(own, pa.int32()), pa.array(np.einsum("ij,ij->i", away, away))]
                    yield pa.RecordBatch.from_arrays(columns, schema=_ANSWER_ARROW)
                    continue
                every = [entry for heap in heaps for entry in heap]
                values = [
                    row["block"].as_py(), [e for e, _ in every], [m for _, m in every], [len(heap) for heap in heaps],
                    [*sums.ravel().tolist(), *counts.tolist(), looked],
                ]
                columns = [pa.array([value], field.type) for value, field in zip(values, _STATE_ARROW)]
                yield pa.RecordBatch.from_arrays(columns, schema=_STATE_ARROW)

    return work


def _changes(state: DataFrame) -> list[int]:
    """Sums over all blocks, as whole numbers of any size: one row for each place."""
    each = state.select(F.posexplode("changes").alias("place", "change"))
    summed = each.groupBy("place").agg(F.sum(F.col("change").cast("decimal(38,0)")).alias("change")).collect()
    return [int(row.change) for row in sorted(summed, key=lambda row: row.place)]


def cluster(points: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, block: int = BLOCK) -> Clustering:
    """Lloyd's algorithm on (vec_id, v), v whole numbers of one length, up to LIMIT.

    Centroids start as ``seeds``; fewer vectors give fewer clusters, none an empty answer.
    A round assigns every vector to the nearest centroid (ties to the smaller number) and
    replaces each non-empty one by the componentwise floor of its vectors' mean. After the
    rounds vectors are assigned once more. Repeated rows are vectors of their own; null ids
    are clustered but come last as seeds.
    """
    spark = points.sparkSession
    numbered = staged(points.select(F.monotonically_increasing_id().alias("row_no"), "vec_id", "v"), "centroid-points")
    start = seeds(numbered, clusters)
    if not start:
        return Clustering(spark.createDataFrame([], "vec_id long, cluster int, distance long"), [], [])
    blocks = -(-numbered.count() // block)
    tables = _Bucketed(spark, min(blocks, MOST_BUCKETS))
    try:
        # Row numbers are unique, so no block outgrows the others, however often a row repeats.
        place = F.pmod(F.xxhash64("row_no"), F.lit(blocks)).alias("block")
        packed = tables.write(
            numbered.groupBy(place).agg(F.collect_list(F.struct("vec_id", "v")).alias("packed"))
        )
        here, size = start, len(start[0])
        sums, counts = np.zeros((len(here), size), object), np.zeros(len(here), object)
        drift, state, looked = np.zeros(len(here)), None, []
        for _ in range(rounds):
            joined = packed if state is None else packed.join(state.drop("changes"), "block")
            state = tables.write(joined.mapInArrow(_round(here, drift.tolist(), False), _STATE))
            *changes, measured_now = _changes(state)
            looked.append(measured_now)
            sums = sums + np.array(changes[: sums.size], object).reshape(sums.shape)
            counts = counts + np.array(changes[sums.size :], object)
            there = [
                [int(total) // int(count) for total in row] if count else old
                for row, count, old in zip(sums, counts, here)
            ]
            ways = np.array([sum((a - b) ** 2 for a, b in zip(x, y)) ** 0.5 for x, y in zip(here, there)])
            others = [np.delete(ways, number).max(initial=0.0) for number in range(len(ways))]
            here, drift = there, drift + ways + others
        joined = packed if state is None else packed.join(state.drop("changes"), "block")
        answer = joined.mapInArrow(_round(here, drift.tolist(), True), "vec_id long, cluster int, distance long")
        return Clustering(staged(answer, "centroid-rows"), here, looked)
    finally:
        tables.forget()


def oracle(clusters: int = CLUSTERS, rounds: int = ROUNDS, salt: str = "3:") -> str:
    """DuckDB SQL for the digest query: every round written out over all vectors."""
    away = "list_sum(list_transform(list_zip({0}, {1}), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint"
    parts = [
        f"""points AS MATERIALIZED (SELECT row_number() OVER () AS n, vec_id,
            list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) AS v FROM embeddings
            WHERE len(embedding) = {SIZE} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{salt}' || vec_id), v) - 1 AS k, v AS c
            FROM points ORDER BY k LIMIT {clusters})""",
    ]
    for number in range(rounds + 1):
        parts.append(
            f"""a{number} AS MATERIALIZED (SELECT n, any_value(vec_id) AS vec_id, any_value(v) AS v,
            min((d, k)) AS best FROM (SELECT n, vec_id, v, k, {away.format("v", "c")} AS d FROM points, c{number}) GROUP BY n)"""
        )
        if number < rounds:
            parts.append(
                f"""m{number} AS (SELECT k, list(floored ORDER BY i) AS c FROM (SELECT k, i,
            ((s - ((s % n + n) % n)) / n)::bigint AS floored FROM (SELECT best[2] AS k, i, sum(v[i])::hugeint AS s, count(*) AS n
            FROM a{number}, range(1, {SIZE + 1}) AS r(i) GROUP BY 1, 2)) GROUP BY k)"""
            )
            parts.append(
                f"""c{number + 1} AS MATERIALIZED (SELECT o.k, coalesce(m.c, o.c) AS c FROM c{number} o LEFT JOIN m{number} m USING (k))"""
            )
    return f"""WITH {", ".join(parts)}
    SELECT vec_id, best[2]::int AS cluster, best[1]::bigint AS distance,
        (sum(best[1]) OVER (PARTITION BY best[2]))::bigint AS cluster_inertia, (sum(best[1]) OVER ())::bigint AS inertia,
        sha256(array_to_string(c, ',')) AS centroid_sha256
    FROM a{rounds} JOIN c{rounds} ON k = best[2]"""
