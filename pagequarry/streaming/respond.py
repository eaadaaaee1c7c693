"""Answering questions as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.operators.answer import Generator, answer_questions
from pagequarry.operators.embed import Embedder
from pagequarry.sources.tables import LOG_COLUMNS, create_batch_table, inference_log
from pagequarry.streaming.ingest import append_batches


def answer_stream(
    questions: DataFrame,
    chunk_table: str,
    log_table: str,
    checkpoint: str,
    embedder: Embedder,
    generator: Generator,
    k: int = 4,
    path: str | None = None,
) -> None:
    """Answer a stream of (qid, question) rows from the chunk table as it is at the time,
    and append question, answer and sources to the log, once per question."""
    create_batch_table(questions.sparkSession, log_table, LOG_COLUMNS, path)

    def respond(batch: DataFrame, writer: str, batch_id: int) -> DataFrame:
        session = batch.sparkSession
        session.catalog.refreshTable(chunk_table)
        chunks = session.read.table(chunk_table)
        log = inference_log(answer_questions(batch, chunks, embedder, generator, k))
        return log.withColumn("ts", F.current_timestamp())

    append_batches(questions, log_table, checkpoint, respond)
