"""SimHash near-duplicates by covering locality-sensitive hashing.

Every text gets a 64-bit fingerprint. A table of the index keeps a structured subset of the
bits: bit i carries a non-zero vector m(i) of radius+1 binary digits, and table v (any
non-zero vector) keeps the bits whose m(i) has an odd product with v. The vectors of any
``radius`` bits span at most ``radius`` of the radius+1 dimensions, so some v is orthogonal
to all of them: two fingerprints that differ in those bits only meet in that table. No pair
within the radius is missed.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm.common import map_rows, staged
from barlake.llm.components import connected_components

SHINGLE_WORDS = 3
RADIUS = 2
SEED = 42
BITS = 64
# Buckets up to this many fingerprints compare their members with each other; larger ones
# go through bit flips, which need no pairs.
PAIRED = 64


def fingerprint(text: bytes | None, words: int = SHINGLE_WORDS) -> int:
    """The signed 64-bit SimHash of the word shingles of a whole UTF-8 text."""
    # bytes.lower() and bytes.split() know ASCII letters and ASCII white space only.
    found = text.lower().split() if text else []
    if not found:
        return 0
    shingles = zip(*(found[i:] for i in range(words))) if len(found) >= words else [found]
    digest, join = xxhash.xxh64_intdigest, b" ".join
    hashes = np.fromiter((digest(join(s), SEED) for s in shingles), np.uint64)
    counts = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 1 << 15):
        part = hashes[start : start + (1 << 15)].astype("<u8").view(np.uint8)
        bits = np.unpackbits(part, bitorder="little").reshape(-1, BITS)
        counts += np.add.reduce(bits, axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def _fingerprinter(words: int) -> Callable[[], Callable[..., tuple]]:
    def begin() -> Callable[..., tuple]:
        def one(doc_id: int | None, text: bytes | None, check: int | None) -> tuple:
            return doc_id, check, fingerprint(text, words)

        return one

    return begin


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text_hash, fp) for every row of ``docs``; other columns do not matter."""
    chosen = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("binary").alias("text"),
        F.xxhash64("text").alias("text_hash"),
    )
    return map_rows(
        chosen, ["doc_id", "text", "text_hash"], "doc_id long, text_hash long, fp long", _fingerprinter(words)
    )


def covering_masks(radius: int = RADIUS) -> list[int]:
    """The bit subsets, as signed longs."""
    vectors = (1 << (radius + 1)) - 1
    masks = []
    for v in range(1, vectors + 1):
        bits = sum(1 << i for i in range(BITS) if ((i % vectors + 1) & v).bit_count() % 2)
        masks.append(_signed(bits))
    return masks


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def fingerprint_links(fps: DataFrame, radius: int = RADIUS, paired: int = PAIRED) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints ``fp`` within ``radius`` bits.

    Small buckets give their linked pairs. The members of large buckets, however large,
    are expanded into all points within radius/2 flipped bits: two fingerprints are within
    the radius exactly if they share such a point, and the fingerprints around one point
    are linked to the least of them. That connects the same fingerprints with a fixed
    number of rows for each, so a group of near copies costs no square.
    """
    if radius % 2:
        raise ValueError("the radius must be even")
    tables = F.array(
        *[
            F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(mask)).alias("key"))
            for t, mask in enumerate(covering_masks(radius))
        ]
    )
    keyed = fps.select("fp", F.explode(tables).alias("at")).select("fp", "at.t", "at.key")
    shared = keyed.groupBy("t", "key").agg(F.count("*").alias("n")).filter("n > 1")
    members = staged(keyed.join(shared, ["t", "key"]), "simhash-buckets")

    small = members.filter(F.col("n") <= paired)
    left = small.select("t", "key", F.col("fp").alias("a"))
    right = small.select("t", "key", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    pairs = left.join(right, ["t", "key"]).filter((F.col("a") < F.col("b")) & near).select("a", "b")

    flips = [
        _signed(sum(1 << bit for bit in chosen))
        for count in range(radius // 2 + 1)
        for chosen in combinations(range(BITS), count)
    ]
    points = (
        members.filter(F.col("n") > paired)
        .select("fp")
        .distinct()
        .select("fp", F.explode(F.array(*[F.lit(x) for x in flips])).alias("flip"))
        .select(F.col("fp").alias("a"), F.col("fp").bitwiseXOR(F.col("flip")).alias("point"))
    )
    # At most as many fingerprints as there are flips lie around one point.
    least = F.min("a").over(Window.partitionBy("point"))
    stars = points.withColumn("b", least).filter(F.col("a") != F.col("b")).select("a", "b")
    return pairs.unionByName(stars).distinct()


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """(doc_id, text_hash, fp, group, component_id) for every row of ``docs``.

    ``group`` names the component of linked fingerprints; ``component_id`` is the smallest
    doc_id in it (null if all are null). Null and empty texts have fingerprint 0 and link
    like any other; repeated rows stay repeated. An empty table gives no rows.
    """
    every = staged(fingerprints(docs, words), "simhash")
    # Copies fall together here, before anything is compared.
    fps = staged(every.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-distinct")
    found = connected_components(fingerprint_links(fps, radius), "simhash-components")
    linked = found.join(fps, found["node"] == fps["fp"]).select("fp", "component", "least_id")
    heads = linked.groupBy("component").agg(F.min("least_id").alias("head"))
    linked = linked.join(heads, "component").select("fp", "component", "head")
    classes = fps.join(linked, "fp", "left").select(
        "fp",
        F.coalesce("component", "fp").alias("group"),
        F.when(F.col("component").isNull(), F.col("least_id")).otherwise(F.col("head")).alias("component_id"),
    )
    # Read from a table, the join's sides are plain shuffles: Spark can split a hot fingerprint.
    classes = staged(classes, "simhash-classes")
    return every.join(classes, "fp").select("doc_id", "text_hash", "fp", "group", "component_id")


def hex16(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), BITS // 4, "0"))


def keep_one(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each group the row with the smallest
    doc_id stays (nulls last), of repeated rows one. All columns are kept."""
    found = near_duplicates(docs, words, radius)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash"))
    keepers = staged(
        found.groupBy("group").agg(first.alias("kept")).select("kept.doc_id", "kept.text_hash"), "simhash-kept"
    )
    columns = docs.columns
    rows = docs.select(F.struct(*[docs[c] for c in columns]).alias("row"))
    rows = rows.withColumn("id", F.col("row.doc_id").cast("long")).withColumn("hash", F.xxhash64("row.text"))
    same = rows["id"].eqNullSafe(keepers["doc_id"]) & (rows["hash"] == keepers["text_hash"])
    rank = F.row_number().over(Window.partitionBy("id", "hash").orderBy(F.xxhash64("row")))
    return (
        rows.join(keepers, same, "left_semi").withColumn("rank", rank).filter("rank = 1").select("row.*")
    )
