"""The training corpus: documents through five stages, each on all that the one before kept.

Toxic documents go, one of each group of near duplicates stays, secrets are replaced in the
texts, sources are brought to their weights by repeating or leaving out documents, and the
result is encoded. The stages are the operators with the parameters of production.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from barlake.llm import bpe, mixing, secret_scan, simhash, toxicity  # noqa: E402
from barlake.llm.common import staged, table  # noqa: E402
from barlake.llm.queries import RANKS  # noqa: E402


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose score reaches their language's threshold. The model is
    fitted on labelled documents of ``docs``."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.reject_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: that with the smallest doc_id."""
    return simhash.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in their texts."""
    return secret_scan.redact_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.repeat_to_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of every document, as often as the mix holds it."""
    return bpe.encode(docs, RANKS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mix", mix_sources),
    ("encode", encode),
]

# The classifier and the knapsack have no SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = staged(docs, f"pipeline-{name}")
    return docs
