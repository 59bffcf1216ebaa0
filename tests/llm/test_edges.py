"""Every operator on empty tables, nulls, repeated rows, long texts and clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from barlake.llm import (
    bpe, dual_tree, embedding_dedup, mixing, reputation, rollups, secret_scan, simhash, surrogates, toxicity,
)
from barlake.llm.queries import RANKS

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside; here they are other people's columns.
CLASH = [
    "fp", "row", "kind", "block", "size", "h1", "spans", "mentions", "score", "pos", "id", "hash", "rank", "times",
    "text_hash", "group", "kinds", "place", "draw", "ids", "n_tokens", "kept", "found", "puts", "low", "held",
]
LONG = "lorem token = abcdef0123456789 a@b.co " * 4000


def documents(spark, rows):
    docs = spark.createDataFrame(rows, DOCS)
    for name in CLASH:
        docs = docs.withColumn(name, F.lit(name))
    return docs


ODD = [
    (1, "one two three", "en", "a", 13),
    (1, "one two three", "en", "a", 13),
    (1, "another text of this id", None, None, None),
    (2, None, "en", "a", None),
    (3, "", "xx", None, 0),
    (None, "one two three", None, "b", 13),
    (None, None, None, None, None),
    (4, LONG, "en", "a", len(LONG)),
    (5, " \n\t ", "de", "b", 4),
]

MODEL = toxicity.fit([[b"bad"], [b"good"]] * 40, [1, 0] * 40)


def rolled(docs):
    rollup = rollups.Rollup(docs.sparkSession, rollups_path(docs.sparkSession))
    rows = rollups.counted(docs)
    rollup.commit("a", rollups.inserts(rows))
    rollup.commit("b", rollups.deletes_of_copies(rows))
    return rollup.totals()


def rollups_path(spark):
    from barlake.session import shared_dir

    return shared_dir(spark, "rollup-test")


# Operator, and how many rows it gives for ODD (None: not one for each row).
ON_DOCS = {
    "mix": (mixing.mix, 9),
    "encode": (lambda d: bpe.encode(d, RANKS), 9),
    "digests": (lambda d: bpe.digests(d, RANKS), 9),
    "rollups": (rolled, None),
    "near_duplicates": (simhash.near_duplicates, 9),
    "toxicity": (lambda d: d.select("doc_id", toxicity.score(d, MODEL, F.col("text")).alias("s")), 9),
    "reject_toxic": (lambda d: toxicity.reject_toxic(d, MODEL), None),
    "secrets": (secret_scan.find_secrets, 9),
    "redact": (secret_scan.redact_secrets, 9),
    "surrogates": (surrogates.replace_personal_data, 9),
}


@pytest.mark.parametrize("name", sorted(ON_DOCS))
def test_odd_and_empty_documents(spark, name):
    operator, rows = ON_DOCS[name]
    assert operator(documents(spark, [])).count() == 0
    got = operator(documents(spark, ODD)).count()
    assert rows is None or got == rows


def test_odd_and_empty_pages(spark):
    schema = "page_id long, url string, host string, lower double"
    none = spark.createDataFrame([], "url string, bad int")
    assert reputation.judge(spark.createDataFrame([], schema), none).count() == 0
    odd = [(1, None, "x", 1.0), (1, None, "x", 1.0), (None, "no scheme", None, None), (3, "http://", None, None), (4, "a://H.example.NET/en/x?y#z", None, None)]
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in reputation.judge(spark.createDataFrame(odd, schema), none).collect()}
    assert got == {
        (1, "", "", None, "allow"), (None, "", "", None, "allow"), (3, "", "", None, "allow"),
        (4, "h.example.net", "/en/x", "example.net/en/", "allow"),
    }


VECTORS = "vec_id long, embedding array<float>, label int, cid string, v string"


def test_odd_and_empty_vectors(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert embedding_dedup.near_duplicates(empty).count() == 0
    assert dual_tree.top_k(dual_tree.integers(empty)).count() == 0
    nan, inf = float("nan"), float("inf")
    odd = [
        (50, [1.0, 0.0], 1, "x", "y"), (50, [1.0, 0.0], 1, "x", "y"), (1, [2.0, 0.0], 1, None, None),
        (2, [1.0, 0.0], None, None, None), (3, None, 1, None, None), (4, [0.0, 0.0], 1, None, None),
        (5, [nan, 1.0], 1, None, None), (6, [inf, 1.0], 1, None, None), (7, [None, 1.0], 1, None, None),
        (8, [1.0, 0.0, 0.0], 1, None, None), (None, [1.0, 0.0], 1, None, None), (9, [], 1, None, None),
    ]
    rows = spark.createDataFrame(odd, VECTORS)
    got = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(rows).collect()}
    assert got == {
        (50, 3, 1, False), (1, 3, 1, True), (None, 3, 1, False),
        *((n, 0, n, True) for n in (2, 3, 4, 5, 6, 7, 8, 9)),
    }
    found = dual_tree.top_k(dual_tree.integers(rows)).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in sorted(found, key=lambda r: r["rank"])] == [
        (50, 1, 1, 512 * 256), (50, 2, 2, 256 * 256), (50, 3, 4, 0),  # the other row of id 50 is its own
    ]


def test_stages_keep_the_columns_of_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for rows in ([], ODD):
        docs = spark.createDataFrame(rows, DOCS)
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            kept = stage(spark, docs, str(tmp_path))
            if number < len(corpus_pipeline.STAGES) - 1:
                assert kept.columns == docs.columns
            kept.count()
            docs = kept
