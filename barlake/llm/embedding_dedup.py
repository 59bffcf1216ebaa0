"""Embedding near-duplicates by Euclidean p-stable hashing.

A table hashes a normalised vector by several random projections, each quantised to cells of
one width; vectors that share all cells of a table meet in a bucket, and every pair that
meets is checked by its exact cosine. Two vectors of cosine 0.98 lie 0.2 apart: with cells of
width 1.6 they share a cell with probability 0.90, all 16 with 0.185, and meet in one of 36
tables with 0.9994; closer ones more surely. Unrelated vectors (distance 1.4) share all 16
cells with less than one in a million.

Large buckets are cut into blocks and every pair of blocks is compared in a task of its own;
what leaves a task is a row for each vector, never a pair. Hashes and ids travel first: a
bucket that holds just the vectors of another one is left out, and only vectors that still
meet others are sent, with what they need to be compared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.sql import types as T

from barlake.llm.common import BATCH_ROWS, staged
from barlake.llm.components import connected_components

COSINE = 0.98
TABLES = 36
PROJECTIONS = 16
WIDTH = 1.6
SEED = 29
# Vectors of a bucket that are compared at once, in pairs of blocks.
BLOCK = 512
PAIRS_AT_ONCE = 1 << 16


def valid(vector: Column, kind: str) -> Column:
    """Neither null nor zero, all components finite and none null; ``kind`` is their type."""
    infinite = F.lit(float("inf")).cast(kind)
    least, most = F.array_min(vector), F.array_max(vector)
    # NaN is greater than all numbers; a search that meets nulls and finds nothing is null.
    finite = ~F.array_contains(vector, infinite) & (most < infinite) & (least > -infinite)
    return F.coalesce(finite & ((most != 0) | (least != 0)), F.lit(False))


def vector_hash(vector: Column) -> Column:
    return F.xxhash64("label", vector)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes with the numbers of their buckets, one for each table."""
    drawn: dict[int, tuple] = {}

    def tables(size: int) -> tuple:
        if size not in drawn:
            draw = np.random.default_rng((SEED, size))
            drawn[size] = (
                draw.normal(size=(size, TABLES * PROJECTIONS)),
                draw.uniform(0, WIDTH, TABLES * PROJECTIONS),
                draw.integers(0, 1 << 63, PROJECTIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
                draw.integers(0, 1 << 63, TABLES, dtype=np.uint64),
            )
        return drawn[size]

    for batch in batches:
        vectors, sizes = batch.column("vector"), batch.column("size").to_numpy()
        groups = batch.column("group").to_numpy().view(np.uint64)
        buckets = np.empty((len(batch), TABLES), np.uint64)
        for size in np.unique(sizes).tolist():
            chosen = np.flatnonzero(sizes == size)
            directions, shifts, factors, starts = tables(size)
            unit = _normalised(_matrix(vectors.take(pa.array(chosen)), size))
            cells = np.floor((unit @ directions + shifts) / WIDTH).astype(np.int64).view(np.uint64)
            keys = (cells.reshape(len(chosen), TABLES, PROJECTIONS) * factors).sum(axis=2, dtype=np.uint64)
            buckets[chosen] = _mixed(_mixed(keys + starts) + groups[chosen, None])
        flat = pa.array(buckets.view(np.int64).ravel())
        listed = pa.ListArray.from_arrays(np.arange(len(batch) + 1, dtype=np.int32) * TABLES, flat)
        columns = [listed if name == "buckets" else batch.column(name) for name in [*batch.schema.names, "buckets"]]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "buckets"])


def _mixed(numbers: np.ndarray) -> np.ndarray:
    numbers = (numbers ^ numbers >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15)
    return (numbers ^ numbers >> np.uint64(29)) * np.uint64(0xD6E8FEB86659FD93)


def _matrix(vectors: pa.Array, size: int) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(vectors), size)


def _normalised(vectors: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _new_links(unit: np.ndarray, keys: np.ndarray, blocks: np.ndarray, table: int, cosine: float) -> Iterator[tuple]:
    """Pairs of one bucket (or of two blocks of it) above the threshold that meet in no
    earlier table, some at a time."""
    near = np.triu(unit @ unit.T >= cosine, 1)
    if blocks.min() != blocks.max():
        near &= blocks[:, None] != blocks[None, :]
    a, b = np.nonzero(near)
    for start in range(0, len(a), PAIRS_AT_ONCE):
        i, j = a[start : start + PAIRS_AT_ONCE], b[start : start + PAIRS_AT_ONCE]
        new = ~(keys[i, :table] == keys[j, :table]).any(axis=1)
        yield i[new], j[new]


def _compare(
    cids: np.ndarray, weights: np.ndarray, unit: np.ndarray, keys: np.ndarray, blocks: np.ndarray, table: int, cosine: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the vectors with new links: their ids, one linked vector of their part of the
    graph (the parts' smallest), and how many rows they link with."""
    found = list(_new_links(unit, keys, blocks, table, cosine))
    i = np.concatenate([x for x, _ in found]) if found else np.empty(0, np.int64)
    j = np.concatenate([x for _, x in found]) if found else np.empty(0, np.int64)
    links = np.bincount(i, weights[j], len(cids)) + np.bincount(j, weights[i], len(cids))
    label = cids.copy()
    while True:
        before = label.copy()
        least = np.minimum(label[i], label[j])
        np.minimum.at(label, i, least)
        np.minimum.at(label, j, least)
        if np.array_equal(before, label):
            break
    some = links > 0
    return cids[some], label[some], links[some].astype(np.int64)


def _compare_twos(
    cids: np.ndarray, weights: np.ndarray, unit: np.ndarray, keys: np.ndarray, tables: np.ndarray, cosine: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``_compare``, for many groups of two rows each, in rows that follow each other."""
    near = np.einsum("ij,ij->i", unit[::2], unit[1::2]) >= cosine
    near &= (keys[::2] == keys[1::2]).argmax(axis=1) == tables
    a, b = cids[::2][near], cids[1::2][near]
    links = np.concatenate((weights[1::2][near], weights[::2][near]))
    return np.concatenate((a, b)), np.tile(np.minimum(a, b), 2), links.astype(np.int64)


_GROUP = ["label", "size", "bucket", "p", "q"]


def _streamed(cosine: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Compares the groups of a sorted partition one after the other."""
    target = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])

    def values(rows: pa.Table) -> tuple:
        """Of rows of vectors of one length."""
        return (
            rows["cid"].to_numpy(),
            rows["n"].to_numpy().astype(np.float64),
            _normalised(_matrix(rows["vector"].combine_chunks(), rows["size"][0].as_py())),
            rows["buckets"].combine_chunks().flatten().to_numpy().reshape(len(rows), -1),
        )

    def compared(rows: pa.Table, cuts: np.ndarray) -> Iterator[tuple]:
        sizes = np.diff(cuts)
        for begin, end in zip(cuts[:-1][sizes > 2], cuts[1:][sizes > 2]):
            group = rows.slice(begin, end - begin)
            found = values(group)
            table = int((found[3][0] == group["bucket"][0].as_py()).argmax())
            yield _compare(*found, group["block"].to_numpy(), table, cosine)
        twos = cuts[:-1][sizes == 2]
        # Two rows of one block are a pair; of a pair of blocks, only if they are not in one.
        block = rows["block"].to_numpy()
        p, q = rows["p"].to_numpy(), rows["q"].to_numpy()
        twos = twos[(p[twos] == q[twos]) | (block[twos] != block[twos + 1])]
        lengths = rows["size"].to_numpy()[twos]
        for length in np.unique(lengths):
            first = twos[lengths == length]
            some = rows.take(pa.array(np.column_stack((first, first + 1)).ravel()))
            found = values(some)
            buckets = some["bucket"].to_numpy()[::2]
            yield _compare_twos(*found, (found[3][::2] == buckets[:, None]).argmax(axis=1), cosine)

    def batch_of(rows: pa.Table, cuts: np.ndarray) -> pa.RecordBatch:
        found = list(compared(rows, cuts)) if len(cuts) > 1 else []
        columns = [np.concatenate(part) for part in zip(*found)] if found else [np.empty(0, np.int64)] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=target)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: pa.Table | None = None
        for batch in batches:
            if not len(batch):
                continue
            rows = pa.Table.from_batches([batch])
            rows = rows if waiting is None else pa.concat_tables([waiting, rows])
            cuts = _borders(rows)
            # The last group may go on in the next batch.
            yield batch_of(rows, cuts[:-1])
            waiting = rows.slice(cuts[-2])
        if waiting is not None:
            yield batch_of(waiting, np.array([0, len(waiting)]))

    return work


def _borders(rows: pa.Table) -> np.ndarray:
    change = np.zeros(len(rows) - 1, bool)
    for name in _GROUP:
        values = rows[name].to_numpy()
        change |= values[1:] != values[:-1]
    return np.concatenate(([0], np.flatnonzero(change) + 1, [len(rows)]))


def classes(rows: DataFrame) -> DataFrame:
    """Equal vectors of a label as one row, from (vec_id, label, vector) of ``valid`` vectors:
    (cid, label, vector, size, n, least_id, hash, group, buckets). ``group`` hashes what
    vectors must share to be compared, ``hash`` label and vector."""
    same = rows.groupBy("label", "vector").agg(F.count("*").alias("n"), F.min("vec_id").alias("least_id"))
    found = same.select(
        F.monotonically_increasing_id().alias("cid"), "label", "vector", F.size("vector").alias("size"), "n", "least_id",
        vector_hash(F.col("vector")).alias("hash"), F.xxhash64("label", F.size("vector")).alias("group"),
    )
    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    schema = T.StructType([*found.schema.fields, T.StructField("buckets", T.ArrayType(T.LongType()))])
    return staged(found.mapInArrow(_hashed, schema), "vector-classes")


def links(found: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(a, b, links) from classes: rows of a that say how many vectors it links with in one
    group of a bucket, and a vector of its component there."""
    place = found.select("cid", F.posexplode("buckets").alias("t", "bucket"))
    # Written, so that the joins know their size.
    shared = staged(place.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1"), "vector-buckets")
    met = staged(place.join(shared, "bucket"), "vector-places")
    # Of buckets of the same members, told by two hashes, that of the first table says it all.
    sets = met.groupBy("bucket", "members", "t").agg(
        F.bit_xor(F.xxhash64("cid")).alias("x"), F.bit_xor(F.xxhash64("cid", F.lit(1))).alias("y")
    )
    firsts = staged(sets.groupBy("members", "x", "y").agg(F.min_by("bucket", "t").alias("bucket")).select("bucket"), "vector-sets")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("cid", "t"), blocks).cast("int")
    place = met.join(firsts, "bucket").select("cid", F.struct("bucket", blocks.alias("blocks"), own.alias("block")).alias("place"))
    # A vector has at most one place in each table.
    places = staged(place.groupBy("cid").agg(F.collect_list("place").alias("places")), "vector-meetings")
    full = found.select("cid", "label", "size", "vector", "n", "buckets").join(places, "cid")
    full = full.withColumn("place", F.explode("places")).select("*", "place.*").drop("places", "place")
    # Every block meets itself and every other one.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    paired = full.select("*", other).select(
        "label", "size", "bucket", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"),
        "cid", "n", "vector", "buckets", "block",
    )
    dealt = paired.repartition(*_GROUP).sortWithinPartitions(*_GROUP)
    return dealt.mapInArrow(_streamed(cosine), "a long, b long, links long")


def near_duplicates(
    vectors: DataFrame, cosine: float = COSINE, columns: tuple[str, str, str] = ("vec_id", "label", "embedding")
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row; ``columns`` name id, label and
    vector.

    Rows of the same label link if their cosine reaches the threshold: equal vectors always,
    others if they meet in a table. Null labels and null, zero or non-finite vectors link
    with nothing, nor do vectors of different length. The component is the smallest vec_id
    reachable, itself included; nulls do not count. Repeated rows are vectors of their own.
    """
    kind = vectors.schema[columns[2]].dataType.elementType.simpleString()
    kind = kind if kind == "float" else "double"
    rows = vectors.select(
        F.col(columns[0]).cast("long").alias("vec_id"), F.col(columns[1]).alias("label"),
        F.col(columns[2]).cast(f"array<{kind}>").alias("vector"),
    )
    part = F.col("label").isNotNull() & valid(F.col("vector"), kind)
    found = classes(rows.filter(part))
    linked = staged(links(found, cosine), "vector-links")
    counts = linked.groupBy(F.col("a").alias("cid")).agg(F.sum("links").alias("links"))
    members = connected_components(linked.select("a", "b"), "vector-components")
    ids = found.select("cid", "least_id").join(members, found["cid"] == members["node"]).select("cid", "component", "least_id")
    heads = ids.groupBy("component").agg(F.min("least_id").alias("head"))
    headed = ids.join(heads, "component").select("cid", "head").withColumn("joined", F.lit(True))
    known = (
        found.join(counts, "cid", "left")
        .join(headed, "cid", "left")
        .select(
            "hash", "label", "vector",
            (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.when(F.col("joined"), F.col("head")).otherwise(F.col("least_id")).alias("component_id"),
            F.lit(True).alias("valid"),
        )
    )
    # Rows find their class by hash; if classes share one, by label and vector too.
    clash = not found.groupBy("hash").count().filter("count > 1").isEmpty()
    on = ["hash", "label", "vector"] if clash else ["hash"]
    hashed = rows.withColumn("hash", F.when(part, vector_hash(F.col("vector"))))
    answer = hashed.select("vec_id", *on).join(known.select(*on, "n_links", "component_id", "valid"), on, "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("valid"), F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"),
    )
    kept = F.col("vec_id").eqNullSafe(F.col("component_id"))
    return answer.withColumn("kept", kept)


def oracle(cosine: float = COSINE) -> str:
    """DuckDB SQL for the query: all pairs of a label, and what they reach."""
    return f"""
    WITH RECURSIVE numbered AS MATERIALIZED (SELECT row_number() OVER () AS n, vec_id, label, embedding::double[] AS v FROM embeddings),
    part AS MATERIALIZED (SELECT * FROM numbered WHERE label IS NOT NULL AND len(v) > 0
        AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
    linked AS MATERIALIZED (SELECT a.n AS a, b.n AS b FROM part a JOIN part b ON a.label = b.label AND a.n <> b.n
        WHERE len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= {cosine}),
    reached(n, head) AS (SELECT n, vec_id FROM numbered UNION SELECT b, head FROM reached JOIN linked ON a = n),
    heads AS (SELECT n, min(head) AS component_id FROM reached GROUP BY n),
    counts AS (SELECT a AS n, count(*) AS n_links FROM linked GROUP BY a)
    SELECT vec_id, coalesce(n_links, 0)::bigint AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
    FROM numbered JOIN heads USING (n) LEFT JOIN counts USING (n)"""
