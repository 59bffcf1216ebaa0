"""Exact duplicates by skew-safe combining, in DataFrame functions only.

Rows are grouped by digest and whole content in three stages: each task combines its own
rows, the salted parts of a group are merged, and the winners of the salts are combined. A
text with a third of all rows leaves a task as one row for each salt and reaches the last
stage as at most ``SALTS`` rows. Every stage compares whole contents, so texts that share a
digest by chance stay apart. Only ids and digests travel back to the rows, again by salt.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import staged

SALTS = 16


def sha256(content: Column) -> Column:
    return F.unhex(F.sha2(content, 256))


def whole_text(text: Column) -> Column:
    """The content that is compared: the text as it is, null as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def _keyed(docs: DataFrame, normalise: Callable, digest: Callable, salts: int) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalise(F.col("text")).alias("content"))
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int")
    return rows.select("doc_id", "content", digest(F.col("content")).alias("digest"), salt.alias("salt"))


def _combined(rows: DataFrame) -> DataFrame:
    """(digest, content, keep_id, group_size): local and salted, then global."""
    parts = rows.groupBy("salt", "digest", "content").agg(F.max("doc_id").alias("last"), F.count("*").alias("n"))
    return parts.groupBy("digest", "content").agg(F.max("last").alias("keep_id"), F.sum("n").alias("group_size"))


def exact_duplicates(
    docs: DataFrame,
    normalise: Callable[[Column], Column] = whole_text,
    digest: Callable[[Column], Column] = sha256,
    salts: int = SALTS,
) -> DataFrame:
    """(doc_id, digest, keep_id, group_size, kept) for every row of ``docs`` (doc_id, text).

    Rows are duplicates if their whole contents are equal; ``keep_id`` is the largest doc_id
    among them. Exactly one row of a group is ``kept``: of repeated rows with that id any
    one. A null text counts as empty. A null id is smaller than every other; a group of
    nulls only has a null ``keep_id`` and keeps one row. No rows give no rows.
    """
    keyed = _keyed(docs, normalise, digest, salts)
    # Ids without texts. Numbered in a written table, so that the numbers stay.
    rows = staged(
        keyed.select(F.monotonically_increasing_id().alias("row_no"), "doc_id", "salt", "digest"), "exact-rows"
    )
    groups = _combined(keyed)
    found = staged(
        groups.groupBy("digest")
        .agg(F.count("*").alias("contents"), F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"))
        .withColumn("group", F.monotonically_increasing_id()),
        "exact-groups",
    )
    # Every salt of a digest gets its own copy of the group's row.
    salted = rows.select("salt", "digest").distinct().join(found, "digest")
    known = rows.join(salted, ["salt", "digest"])
    told = known.filter("contents = 1").drop("contents", "salt")
    shared = found.filter("contents > 1").select("digest")
    if not shared.isEmpty():
        told = told.unionByName(_apart(docs, normalise, digest, salts, shared))
    told = staged(told, "exact-told")
    # One row of each group claims to be the one that stays.
    claim = told.filter(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    stays = claim.groupBy("group").agg(F.min("row_no").alias("row_no")).select("row_no", F.lit(True).alias("stays"))
    return told.join(stays, "row_no", "left").select(
        "doc_id", "digest", "keep_id", "group_size", F.coalesce("stays", F.lit(False)).alias("kept")
    )


def _apart(docs: DataFrame, normalise: Callable, digest: Callable, salts: int, shared: DataFrame) -> DataFrame:
    """Rows of digests that several contents share, told apart by content."""
    some = staged(
        _keyed(docs, normalise, digest, salts)
        .join(shared, "digest", "left_semi")
        .withColumn("row_no", -1 - F.monotonically_increasing_id()),
        "exact-shared",
    )
    groups = staged(_combined(some).withColumn("group", -1 - F.monotonically_increasing_id()), "exact-apart")
    salted = some.select("salt", "digest", "content").distinct().join(groups, ["digest", "content"])
    return some.join(salted, ["salt", "digest", "content"]).select(
        "row_no", "doc_id", "digest", "keep_id", "group_size", "group"
    )


def deduplicate(
    docs: DataFrame,
    normalise: Callable[[Column], Column] = whole_text,
    digest: Callable[[Column], Column] = sha256,
    salts: int = SALTS,
) -> DataFrame:
    """``docs`` with one row of each group of equal contents, that with the largest doc_id (a
    null id is smaller than every other), with all its columns. The rows themselves are
    combined in the same three stages."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    content = normalise(F.col("row.text"))
    order = F.struct(F.col("row.doc_id").isNotNull().alias("there"), F.col("row.doc_id").cast("long").alias("doc_id"))
    salt = F.pmod(F.xxhash64(F.col("row.doc_id").cast("long")), F.lit(salts)).cast("int")
    keyed = rows.select("row", order.alias("order"), content.alias("content"), digest(content).alias("digest"), salt.alias("salt"))
    parts = keyed.groupBy("salt", "digest", "content").agg(
        F.max_by("row", "order").alias("row"), F.max("order").alias("order")
    )
    return parts.groupBy("digest", "content").agg(F.max_by("row", "order").alias("row")).select("row.*")
