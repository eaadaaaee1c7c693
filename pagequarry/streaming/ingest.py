"""Streaming jobs: files to a raw table, raw table to chunks with vectors.

Each job takes what is there, appends, and ends. Its checkpoint remembers what was
done, so the next run adds only what is new. Every stage needs its own checkpoint
folder on storage all executors share.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pagequarry.operators.chunk import explode_chunks, sentence_chunks
from pagequarry.operators.embed import Embedder, embed
from pagequarry.operators.ids import hash_id, with_dense_ids
from pagequarry.operators.parse import html_text
from pagequarry.session import small_arrow_batches
from pagequarry.sources.files import PIECE_OPTIONS, PIECE_SCHEMA, file_pieces, stream_documents
from pagequarry.sources.tables import (
    add_to_collection,
    create_batch_table,
    create_collection,
    last_batches,
    write_batch,
)


def start_append(stream: DataFrame, table: str, checkpoint: str, path: str | None = None) -> StreamingQuery:
    """Append all that is available to ``table``, in bounded micro-batches, and end."""
    writer = (
        stream.writeStream.outputMode("append")
        .trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
    )
    if path:
        writer = writer.option("path", path)
    return writer.toTable(table)


def ingest_files(
    spark: SparkSession,
    folder: str,
    table: str,
    checkpoint: str,
    glob: str | None = None,
    path: str | None = None,
    files_per_batch: int = 1000,
    piece_bytes: int | None = None,
) -> None:
    """Append the bytes of each new file of ``folder`` to ``table``, once per file.

    A file is one row, as parsers want it, and must fit in an executor's memory a few times.
    With ``piece_bytes`` a longer one is several rows, told by ``piece``, and may have
    any length; ``table`` is then a batch table (``create_batch_table``).
    """
    stream = stream_documents(spark, folder, glob, files_per_batch)
    if piece_bytes is not None:
        create_batch_table(spark, table, PIECE_SCHEMA, path, PIECE_OPTIONS)
        # Without their content, so that no file is read before it is cut.
        names = stream.drop("content")
        append_batches(names, table, checkpoint, lambda batch, *_: file_pieces(batch, piece_bytes))
        return
    start_append(stream, table, checkpoint, path).awaitTermination()


def chunk_rows(
    raw: DataFrame,
    embedder: Embedder,
    chunks: Column | None = None,
    make_id: Callable[[Column, Column], Column] = hash_id,
) -> DataFrame:
    """(id, url, content, embedding) rows of raw documents, batch or stream alike.

    ``chunks`` cuts a document; by default its text is taken from HTML and cut along
    sentences. Ids are hashes of document and position, so a replay gives the same;
    pass ``wide_id`` for tables of more than some 10**8 chunks.
    """
    if chunks is None:
        chunks = sentence_chunks(html_text(F.col("content")))
    pieces = explode_chunks(raw.withColumnRenamed("path", "url"), chunks, "url")
    return pieces.select(
        make_id(F.col("url"), F.col("chunk_ix")).alias("id"),
        "url",
        "content",
        embed(F.col("content"), embedder).alias("embedding"),
    )


def index_documents(
    raw: DataFrame,
    collection: str,
    embedder: Embedder,
    chunks: Column | None = None,
    metric: str = "l2",
    path: str | None = None,
    make_id: Callable[[Column, Column], Column] = hash_id,
) -> None:
    """Raw documents to a filled collection in one call: parse, chunk, embed, add."""
    create_collection(raw.sparkSession, collection, embedder.dim, embedder.name, metric, path)
    add_to_collection(chunk_rows(raw, embedder, chunks, make_id), collection, embedder)


def ingest_chunks(
    spark: SparkSession,
    source: str,
    table: str,
    checkpoint: str,
    embedder: Embedder,
    chunks: Column | None = None,
    path: str | None = None,
    documents_per_arrow_batch: int | None = 10,
    files_per_batch: int = 1000,
) -> None:
    """Stream the raw table ``source``: parse, chunk, embed and append to ``table``.

    Python workers get few rows at a time, as ``chunks`` may hand them whole documents;
    pass None where it does not.
    """
    raw = spark.readStream.option("maxFilesPerTrigger", files_per_batch).table(source)
    rows = chunk_rows(raw, embedder, chunks)
    # The query takes its settings when it starts; the session has its own back after.
    with small_arrow_batches(spark, documents_per_arrow_batch):
        query = start_append(rows, table, checkpoint, path)
    query.awaitTermination()
    spark.catalog.refreshTable(table)


def ingest_numbered(
    stream: DataFrame, table: str, checkpoint: str, keys: list[str]
) -> None:
    """Append a stream with dense ids that go on from the largest in ``table``.

    ``table`` is a batch table (``create_batch_table``) with an ``id``. Only the last
    partition of each query is read for the largest id. One writer at a time.
    """

    def number(batch: DataFrame, writer: str, batch_id: int) -> DataFrame:
        have = last_batches(batch.sparkSession, table, writer, batch_id)
        last = have.agg(F.coalesce(F.max("id"), F.lit(0)).alias("id")).first().id
        return with_dense_ids(batch, keys).withColumn("id", F.col("id") + F.lit(last))

    append_batches(stream, table, checkpoint, number)


def append_batches(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    rows: Callable[[DataFrame, str, int], DataFrame],
) -> None:
    """Write what ``rows`` makes of each micro-batch to its own partition of ``table``.

    ``rows`` gets the batch, the id that Spark keeps for the query in its checkpoint, and
    the number of the batch. A batch that comes again replaces its partition, so
    nothing is lost or doubled; the table is not searched.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        writer = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        write_batch(rows(batch, writer, batch_id), table, writer, batch_id)

    query = (
        stream.writeStream.foreachBatch(write)
        .trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .start()
    )
    query.awaitTermination()
    stream.sparkSession.catalog.refreshTable(table)
