"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagequarry.llm import (
    bpe,
    hmm,
    imatch,
    languages,
    middle,
    sanitise,
    toxicity,
    warc,
    whitening,
    wrappers,
)
from pagequarry.llm.decontaminate import contamination
from pagequarry.llm.minmax import near_duplicates
from pagequarry.llm.repeats import remove_repeats
from pagequarry.scratch import scratch_path
from pagequarry.session import ship_package

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def token_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Token counts and digests of the ids and of the text decoded from them."""
    ranks = bpe.ship_ranks(docs.sparkSession, path)
    return bpe.round_trip(docs, ranks, pattern).select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_digests(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    ).drop("items")


def op3_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = F.coalesce(held_out(1), F.lit(False))
    docs = table(spark, sf_dir, "documents").withColumn("train", ~out)
    model, read = hmm.train(docs.select("doc_id", "train", "text"))
    scored = hmm.score(read, model).withColumn("held_out", ~F.col("train"))
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op4_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op5_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = imatch.fingerprints(table(spark, sf_dir, "documents"))

    def near(other: str, same_text: str) -> Column:
        same = F.expr(f"cast({same_text} AS double)")
        return F.coalesce(F.expr(imatch.likeness("print", other)), same)

    return found.select(
        "doc_id",
        F.length("body").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.expr(imatch.as_text("print")).alias("fingerprint"),
        F.expr(imatch.as_text("edited_print")).alias("edited_fingerprint"),
        near("edited_print", "body = edited").alias("near_edited"),
        near("next_print", "md5(body) = next_body_md5").alias("near_next"),
        F.col("next_id").alias("next_doc_id"),
    )


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.resolve_revisits(warc.read_archives(spark, path))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    base, spans = sanitise.span_strings()
    return (
        sanitise.find(docs)
        .withColumns({"base": base, "spans": spans})
        .select(
            "row.doc_id",
            *[sanitise.count_of(k).alias(f"n_{k}") for k in sanitise.KINDS],
            F.sha2("base", 256).alias("base_sha256"),
            "spans",
        )
    )


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"), with_kept=False)
    return found.drop("kept", "spans")


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_text(table(spark, sf_dir, "pages"))


def held_out(remainder: int, folds: int = 5) -> Column:
    """Whether a document is kept out of training."""
    return F.crc32(F.col("doc_id").cast("string")) % folds == remainder


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    return toxicity.train(docs, labels.where(~held_out(0)).select("doc_id", "toxic"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        F.coalesce(held_out(0), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = F.coalesce(held_out(1, 3), F.lit(False))
    model = languages.train(docs.where(~out))
    return languages.identify(docs, model).select(
        "doc_id", out.alias("held_out"), "lang_pred", "score", F.to_json("languages").alias("languages")
    )


def op12_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = middle.fill_in_middle(table(spark, sf_dir, "documents"))
    made = made.withColumn("cut", middle.parts(F.col("output"), F.col("form")))
    return made.select(
        "doc_id",
        "n",
        "form",
        F.length("cut.prefix").cast("long").alias("prefix_chars"),
        F.length("cut.middle").cast("long").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(middle.restore(F.col("output"), F.col("cut")), 256).alias("restored_sha256"),
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = whitening.on_lattice(table(spark, sf_dir, "embeddings"))
    return whitening.whiten(vectors, whitening.fit(vectors, components=4))


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_decontaminate": op2_decontaminate,
    "op3_hmm": op3_hmm,
    "op4_minmax": op4_minmax,
    "op5_imatch": op5_imatch,
    "op6_warc": op6_warc,
    "op7_pii": op7_pii,
    "op8_repeats": op8_repeats,
    "op9_html": op9_html,
    "op10_toxicity": op10_toxicity,
    "op11_language": op11_language,
    "op12_middle": op12_middle,
    "op13_whitening": op13_whitening,
}
