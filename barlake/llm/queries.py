"""Registered queries of this subpackage: each applies one operator, with the parameters of
production, to its whole table. SQL stands beside those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from zlib import crc32

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm import (
    bpe, centroids, dual_tree, embedding_dedup, exact_dedup, mixing, periodic, reputation, rollups, secret_scan, simhash,
    surrogates, toxicity,
)
from barlake.llm.common import staged, table
from barlake.session import shared_dir

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    REGISTRY[function.__name__] = function
    return function


@query
def op1_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"), "source", "times"
    )


@query
def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(table(spark, folder, "documents"), RANKS)


@query
def op3_token_rollups(spark: SparkSession, folder: str) -> DataFrame:
    """Three batches over all documents: all are inserted, exact copies deleted, and counts
    revised where cleaning changes them. The second batch is committed twice."""
    rows = staged(rollups.counted(table(spark, folder, "documents")), "token-counts")
    rollup = rollups.Rollup(spark, shared_dir(spark, "rollup"))
    firsts = rollups.first_copies(rows)
    rollup.commit("crawl", rollups.inserts(rows))
    for _ in range(2):
        rollup.commit("copies", rollups.deletes_of_copies(rows, firsts))
    rollup.commit("cleaning", rollups.revisions(rows, firsts))
    return rollup.totals()


ORACLE["op3_token_rollups"] = rollups.oracle()


@query
def op4_dual_tree(spark: SparkSession, folder: str) -> DataFrame:
    return dual_tree.top_k(dual_tree.integers(table(spark, folder, "embeddings")))


ORACLE["op4_dual_tree"] = """
    WITH points AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) AS v
        FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (SELECT q.vec_id AS query_id, p.vec_id,
        list_sum(list_transform(list_zip(q.v, p.v), lambda z: z[1] * z[2]))::bigint AS score
        FROM (SELECT DISTINCT * FROM points) q JOIN points p ON p.vec_id <> q.vec_id AND len(p.v) = len(q.v) WHERE q.vec_id % 50 = 0),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::int AS rank FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""


@query
def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", simhash.hex16(found["fp"]).alias("fingerprint"), "component_id")


@query
def op7_url_reputation(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    outcomes = reputation.document_outcomes(pages, table(spark, folder, "labels"))
    return reputation.judge(pages, outcomes).select("page_id", "host", "path", "rule", "verdict")


ORACLE["op7_url_reputation"] = reputation.oracle()


@query
def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, folder, "documents").select("doc_id", "text"))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, rule.kind))).cast("long").alias(f"n_{rule.kind}")
        for rule in secret_scan.BASE
    ]
    base = F.filter("spans", lambda s: s["rank"] < len(secret_scan.BASE))
    return found.select(
        "doc_id", *counts, F.sha2(secret_scan.listed(base), 256).alias("base_sha256"), secret_scan.listed(F.col("spans")).alias("spans")
    )


ORACLE["op8_secret_scan"] = secret_scan.oracle()


@query
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.train(docs, table(spark, folder, "labels"))
    scored = docs.select("doc_id", "lang", toxicity.score(docs, model, F.col("text")).alias("score"))
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        (F.col("score") >= toxicity.threshold(model, F.col("lang"))).alias("rejected"),
    )


@query
def op9_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    replaced = surrogates.replace_personal_data(table(spark, folder, "documents").select("doc_id", "text"))
    kinds = F.transform("mentions", lambda m: m["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}")
        for kind in surrogates.KINDS
    ]
    return replaced.select("doc_id", "text", *counts)


@query
def op10_pstable_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, folder, "embeddings"))


ORACLE["op10_pstable_dedup"] = embedding_dedup.oracle()


def repeated_tail(doc_id: int | None, count: int) -> np.ndarray | None:
    """The places that the words of a document are taken from: a tenth of all documents, by
    the checksum of their ids, repeat a stretch up to their end."""
    h = crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not count:
        return None
    g = h // 10
    start = g % count
    period = 1 + (count - start) // (3 + g % 8)
    return np.concatenate((np.arange(start), start + np.arange(count - start) % period))


@query
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = periodic.find_runs(docs, repeated_tail)
    best = found.withColumn("best", periodic.strongest(F.col("runs")))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(periodic.listed(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_dedup.exact_duplicates(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE["op12_exact_dedup"] = """
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
        row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
    FROM texts WINDOW same AS (PARTITION BY t)"""


@query
def op13_centroids(spark: SparkSession, folder: str) -> DataFrame:
    found = centroids.cluster(centroids.integers(table(spark, folder, "embeddings")))
    own = found.inertia()
    return found.rows.select(
        "vec_id", "cluster", "distance",
        F.element_at(F.array(*[F.lit(n).cast("long") for n in [*own, 0]]), F.col("cluster") + 1).alias("cluster_inertia"),
        F.lit(sum(own)).cast("long").alias("inertia"),
        found.digest(F.col("cluster")).alias("centroid_sha256"),
    )


ORACLE["op13_centroids"] = centroids.oracle()
