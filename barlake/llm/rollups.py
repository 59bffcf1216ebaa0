"""Token counts as rollups that deltas maintain.

Changes of documents carry their count before and after: an insert has no before, a delete
no after, a revision both. A batch of changes becomes signed sums by source, language and
tokenizer version and is committed as one partition of the rollup's table, named by its
batch: committing a batch again, after a failure or by mistake, replaces that partition and
adds nothing. Totals are the sums over all committed batches; nothing is ever recounted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm.common import staged

KEY = ("source", "lang", "tokenizer")
SCHEMA = "source string, lang string, tokenizer string, n_docs long, n_tokens decimal(38,0), marker boolean, batch_id string"

# A tokenizer version is a pattern whose matches are the tokens, in Java and RE2 syntax.
TOKENIZERS = {
    "words-1": r"[^\x20\x09-\x0D]+",
    "signs-1": r"\p{L}+|\p{N}+|[^\x20\x09-\x0D\p{L}\p{N}]",
}


def count_tokens(text: Column, tokenizer: str) -> Column:
    """Tokens of a whole text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(TOKENIZERS[tokenizer])), F.lit(0)).cast("long")


def deltas(changes: DataFrame) -> DataFrame:
    """Signed sums (source, lang, tokenizer, n_docs, n_tokens) of changes.

    ``changes`` has ``tokenizer`` and the structs ``before`` and ``after`` (source, lang,
    n_tokens), of which one may be null. A document that moves between sources or languages
    leaves the one and enters the other; a change without either counts for nothing. Every
    row is a change of its own. Sums are partial in each task, so a hot key is one row there.
    """
    sides = F.array(
        F.when(F.col("after").isNotNull(), F.struct(F.lit(1).alias("sign"), F.col("after").alias("of"))),
        F.when(F.col("before").isNotNull(), F.struct(F.lit(-1).alias("sign"), F.col("before").alias("of"))),
    )
    signed = changes.select("tokenizer", F.explode(F.array_compact(sides)).alias("side")).select(
        F.col("side.of.source").alias("source"), F.col("side.of.lang").alias("lang"), "tokenizer",
        F.col("side.sign").cast("long").alias("docs"),
        (F.col("side.sign") * F.coalesce("side.of.n_tokens", F.lit(0))).cast("decimal(38,0)").alias("tokens"),
    )
    sums = signed.groupBy(*KEY).agg(F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens"))
    return sums.filter((F.col("n_docs") != 0) | (F.col("n_tokens") != 0))


class Rollup:
    """A rollup's table: one small partition for each committed batch."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def commit(self, batch_id: str, changes: DataFrame) -> None:
        """Commit a batch. The partition appears or is replaced when all its files are
        written; a marker row makes an empty batch a batch too."""
        marker = self.spark.range(1).select(
            *[F.lit(None).cast("string").alias(c) for c in KEY],
            F.lit(0).cast("long").alias("n_docs"), F.lit(0).cast("decimal(38,0)").alias("n_tokens"),
            F.lit(True).alias("marker"),
        )
        rows = deltas(changes).withColumn("marker", F.lit(False)).unionByName(marker)
        # A handful of keys: one file, whatever the size of the batch.
        rows.withColumn("batch_id", F.lit(batch_id)).coalesce(1).write.partitionBy("batch_id").option(
            "partitionOverwriteMode", "dynamic"
        ).mode("overwrite").parquet(self.path)

    def batches(self) -> DataFrame:
        """(batch_id) of the committed batches."""
        return self._read().filter("marker").select("batch_id")

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, n_docs, n_tokens) after all batches; a key whose
        documents are all gone has no row."""
        sums = self._read().filter("NOT marker").groupBy(*KEY).agg(
            F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")
        )
        kept = sums.filter((F.col("n_docs") != 0) | (F.col("n_tokens") != 0))
        return kept.withColumn("n_tokens", F.col("n_tokens").cast("long"))

    def _read(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(self.path)


def counted(docs: DataFrame, noise: str = r"[#$%&*]+") -> DataFrame:
    """(doc_id, tokenizer, source, lang, raw, clean, text_hash): the tokens of every whole text
    as crawled and with runs of noise signs taken for blanks."""
    cleaned = F.regexp_replace("text", noise, " ")
    both = F.array(
        *[
            F.struct(
                F.lit(name).alias("tokenizer"),
                count_tokens(F.col("text"), name).alias("raw"),
                count_tokens(cleaned, name).alias("clean"),
            )
            for name in TOKENIZERS
        ]
    )
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        F.sha2("text", 256).alias("text_hash"),
        F.explode(both).alias("of"),
    )
    return rows.select("doc_id", "source", "lang", "text_hash", "of.*")


def _side(tokens: str, present: Column | None = None) -> Column:
    side = F.struct("source", "lang", F.col(tokens).alias("n_tokens"))
    return side if present is None else F.when(present, side)


def inserts(rows: DataFrame) -> DataFrame:
    return rows.select("tokenizer", F.lit(None).cast(_SIDE).alias("before"), _side("raw").alias("after"))


def first_copies(rows: DataFrame) -> DataFrame:
    """(text_hash, first): the smallest doc_id of every text, as a written table, so that a
    join with it can split a text with very many copies. Null texts are not in it."""
    known = rows.filter(F.col("text_hash").isNotNull())
    return staged(known.groupBy("text_hash").agg(F.min("doc_id").alias("first")), "first-copies")


def deletes_of_copies(rows: DataFrame, firsts: DataFrame | None = None) -> DataFrame:
    """Deletes of the rows whose whole text another row with a smaller doc_id has (null ids
    last); of rows that share text and doc_id none is a copy of the other."""
    same = rows.join(first_copies(rows) if firsts is None else firsts, "text_hash")
    gone = same.filter(F.col("doc_id").isNull() & F.col("first").isNotNull() | (F.col("doc_id") > F.col("first")))
    return gone.select("tokenizer", _side("raw").alias("before"), F.lit(None).cast(_SIDE).alias("after"))


def revisions(rows: DataFrame, firsts: DataFrame | None = None) -> DataFrame:
    """Revised counts of the first copies whose count the cleaning changes."""
    changed = rows.filter(F.col("raw") != F.col("clean"))
    same = changed.join(first_copies(rows) if firsts is None else firsts, "text_hash")
    kept = same.filter(F.col("doc_id").eqNullSafe(F.col("first")))
    return kept.select("tokenizer", _side("raw").alias("before"), _side("clean").alias("after"))


_SIDE = "struct<source:string,lang:string,n_tokens:bigint>"


def oracle() -> str:
    """DuckDB SQL for the query: the state after the three batches, counted at once."""
    each = " UNION ALL ".join(
        f"""SELECT doc_id, source, lang, text, '{name}' AS tokenizer,
        len(regexp_extract_all(regexp_replace(text, '[#$%&*]+', ' ', 'g'), '{pattern}')) AS clean FROM documents"""
        for name, pattern in TOKENIZERS.items()
    )
    return f"""
    WITH counted AS ({each}),
    firsts AS (SELECT text, min(doc_id) AS first FROM documents WHERE text IS NOT NULL GROUP BY text),
    kept AS (SELECT c.* FROM counted c LEFT JOIN firsts f USING (text)
        WHERE c.text IS NULL OR c.doc_id IS NOT DISTINCT FROM f.first)
    SELECT source, lang, tokenizer, count(*)::bigint AS n_docs, sum(coalesce(clean, 0))::bigint AS n_tokens
    FROM kept GROUP BY ALL"""
