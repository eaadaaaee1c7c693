"""Training documents from raw ones: five stages, each over all that the one before kept.

Toxic documents go; of near duplicates one stays; documents with benchmark passages go;
personal data is replaced by marks; the texts that are left become tokens. Every stage but
the last takes and returns the columns of ``documents``, written as Parquet in between.

Defined cases are those of the operators: null and empty texts pass all filters, get no
marks and have no tokens; rows without an id are documents like others, and of rows repeated as
a whole, or alike under one id or none, the near-duplicate stage keeps one. Columns besides doc_id and text may be missing or of any kind.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagequarry.llm import bpe
from pagequarry.llm.decontaminate import drop_contaminated
from pagequarry.llm.minmax import near_duplicates
from pagequarry.llm.queries import VOCABULARY, table, toxicity_model
from pagequarry.llm.sanitise import sanitise
from pagequarry.llm.toxicity import drop_toxic
from pagequarry.scratch import materialise

# SQL cannot express the trained and the token stages; tests compare with brute force.
ORACLE_SQL = None


def clean_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the toxicity machine rejects. It learns from labelled documents
    among ``docs`` whose id is not held out."""
    return drop_toxic(docs, toxicity_model(docs, table(spark, sf_dir, "labels")))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near duplicates: that of the smallest id, rows without an
    id last. Rows are told apart by a key of their own, so repeated rows are a group too."""
    key = "row"
    while key in docs.columns:
        key += "_"
    keyed = materialise(docs.withColumn(key, F.monotonically_increasing_id()), "keyed")
    found = near_duplicates(keyed.select(F.col(key).alias("doc_id"), "text"))
    groups = found.select(F.col("doc_id").alias(key), "component_id").join(
        keyed.select(key, F.col("doc_id").alias("id")), key
    )
    first = F.min_by(key, F.struct(F.col("id").isNull(), "id", key)).alias(key)
    kept = groups.groupBy("component_id").agg(first).select(key)
    return keyed.join(kept, key, "left_semi").select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in which a window of a benchmark item occurs."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data, and words that give it away, by marks."""
    return sanitise(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, with digests of the ids and of the text decoded from them."""
    ranks = bpe.ship_ranks(spark, public_tokenizers.path(VOCABULARY))
    pattern = public_tokenizers.PATTERN
    return bpe.round_trip(docs, ranks, pattern).select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", clean_language),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmark),
    ("personal_data", without_personal_data),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``; each result is written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
