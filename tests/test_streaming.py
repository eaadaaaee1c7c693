import hashlib
from collections.abc import Iterator

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pagequarry.operators.answer import extractive
from pagequarry.operators.chunk import CHUNKS, sentence_chunks
from pagequarry.operators.embed import hashed_words
from pagequarry.operators.ids import wide_id
from pagequarry.operators.parse import elements_text, parse_with
from pagequarry.sources import tables
from pagequarry.sources.files import piece_digests, scan_documents
from pagequarry.streaming import ingest
from pagequarry.streaming.respond import answer_stream

EMBEDDER = hashed_words(8)


def put(folder, name, text):
    (folder / name).write_text(f"<html><body><p>{text}</p></body></html>")


@pytest.fixture
def folder(tmp_path):
    folder = tmp_path / "docs"
    folder.mkdir()
    for i in range(3):
        put(folder, f"d{i}.html", f"Document {i} says a .\nIt says more.")
    put(folder, "skip.txt", "no")
    return folder


def rows_of(spark, table):
    spark.catalog.refreshTable(table)
    return spark.table(table)


def test_each_file_is_read_once(spark, folder, tmp_path, name):
    def run():
        ingest.ingest_files(spark, str(folder), name, str(tmp_path / "c"), glob="*.html", files_per_batch=2)
        return rows_of(spark, name).count()

    assert run() == 3
    assert run() == 3
    put(folder, "d3.html", "new")
    assert run() == 4


def test_long_files_are_stored_in_pieces_once(spark, folder, tmp_path, name):
    long = {"long.html": b"<p>\x00\xff</p>\n" * 500, "d3.html": b"one more"}
    (folder / "long.html").write_bytes(long["long.html"])

    def run():
        ingest.ingest_files(
            spark, str(folder), name, str(tmp_path / "c"), glob="*.html", files_per_batch=3, piece_bytes=1000
        )
        rows = rows_of(spark, name)
        assert rows.agg(F.max(F.length("content"))).first()[0] == 1000
        found = piece_digests(rows, "writer", "batch_id").collect()
        return sorted((r.path.split("/")[-1], r.length, r.digest) for r in found)

    def want():
        contents = {f.name: f.read_bytes() for f in folder.glob("*.html")}
        return sorted((n, len(c), hashlib.md5(c).hexdigest()) for n, c in contents.items())

    assert run() == want()
    assert run() == want() and len(want()) == 4
    (folder / "d3.html").write_bytes(long["d3.html"])
    assert run() == want() and len(want()) == 5
    forget_last_commit(tmp_path / "c")
    assert run() == want()


def test_two_stages_equal_the_batch_result(spark, folder, tmp_path, name):
    raw, chunks = f"{name}_raw", f"{name}_chunks"

    def run():
        ingest.ingest_files(spark, str(folder), raw, str(tmp_path / "c1"), glob="*.html")
        ingest.ingest_chunks(spark, raw, chunks, str(tmp_path / "c2"), EMBEDDER)
        return {tuple(map(str, r)) for r in rows_of(spark, chunks).collect()}

    def batch():
        return {tuple(map(str, r)) for r in ingest.chunk_rows(rows_of(spark, raw), EMBEDDER).collect()}

    first = run()
    assert first == batch() and len(first) == 3
    assert any("Document 0 says a.It says more." in r for r in map(str, first))
    assert run() == first
    put(folder, "d3.html", "new")
    second = run()
    assert second == batch() and len(second) == 4 and first < second
    assert rows_of(spark, chunks).columns == ["id", "url", "content", "embedding"]
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000"


def test_stream_with_a_parser_and_a_tokenizer_of_the_caller(spark, tmp_path, name):
    docs = tmp_path / "pdfs"
    docs.mkdir()
    for i in range(25):
        (docs / f"{i}.pdf").write_bytes(b"\x00".join(b"part %d of %d ." % (j, i) for j in range(3)))

    def parser(document, strategy):
        assert strategy == "fast"
        return [{"text": t.decode()} for t in document.split(b"\x00")]

    def tokenizer():
        return lambda text: len(text.split())

    def columns():
        elements = parse_with(parser, F.col("content"), strategy="fast")
        return sentence_chunks(elements_text(elements), 5, 1, tokenizer)

    raw, chunks = f"{name}_raw", f"{name}_chunks"
    ingest.ingest_files(spark, str(docs), raw, str(tmp_path / "c1"), glob="*.pdf")
    ingest.ingest_chunks(spark, raw, chunks, str(tmp_path / "c2"), EMBEDDER, columns())
    rows = rows_of(spark, chunks).collect()
    batch = ingest.chunk_rows(rows_of(spark, raw), EMBEDDER, columns(), make_id=wide_id)
    assert len(rows) == batch.count() == 75
    assert {r.content for r in rows} == {f"part {j} of {i}." for i in range(25) for j in range(3)}
    assert {len(r.id) for r in batch.collect()} == {32}


def test_workers_of_a_stream_get_few_documents_at_a_time(spark, tmp_path, name):
    raw = f"{name}_raw"
    tables.create_table(spark, raw, "path STRING, content BINARY")
    spark.range(0, 40, 1, 1).selectExpr(
        "cast(id as string) as path", "cast('x' as binary) as content"
    ).write.insertInto(raw)

    def batch_sizes():
        def sizes(batches):
            for batch in batches:
                yield pd.Series([[{"chunk": str(len(batch)), "n_units": 1}]] * len(batch))

        sizes.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
        return F.pandas_udf(sizes, CHUNKS)(F.col("content"))

    def run(target, rows):
        ingest.ingest_chunks(
            spark, raw, target, str(tmp_path / target), EMBEDDER, batch_sizes(),
            documents_per_arrow_batch=rows,
        )
        return {int(r.content) for r in rows_of(spark, target).collect()}

    assert run(f"{name}_few", 10) == {10}
    assert run(f"{name}_all", None) == {40}


def forget_last_commit(checkpoint):
    """Undo the note that the last batch is done, as a crash right before it would."""
    last = max((int(f.name) for f in (checkpoint / "commits").iterdir() if f.name.isdigit()))
    for file in (checkpoint / "commits").iterdir():
        if file.name.strip(".").split(".")[0] == str(last):
            file.unlink()


def test_numbered_stream_survives_a_replay(spark, tmp_path, name):
    source, target = f"{name}_s", f"{name}_t"
    spark.range(50).select(F.col("id").alias("k")).write.saveAsTable(source)
    tables.create_batch_table(spark, target, "id BIGINT, k BIGINT")

    def run(checkpoint):
        ingest.ingest_numbered(
            spark.readStream.table(source), target, str(tmp_path / checkpoint), ["k"]
        )
        return sorted((r.id, r.k) for r in rows_of(spark, target).collect())

    first = [(k + 1, k) for k in range(50)]
    assert run("c") == first
    forget_last_commit(tmp_path / "c")
    assert run("c") == first
    spark.range(50, 80).select(F.col("id").alias("k")).write.insertInto(source)
    more = first + [(k + 1, k) for k in range(50, 80)]
    assert run("c") == more
    # A part of the last batch alone was written before the crash.
    part = rows_of(spark, target).where("batch_id = 1").limit(3).collect()
    writer = part[0].writer
    rows = spark.createDataFrame([(r.id, r.k) for r in part], "id long, k long")
    tables.write_batch(rows, target, writer, 1)
    forget_last_commit(tmp_path / "c")
    assert run("c") == more
    # Another checkpoint is another query: it reads all, and its rows are kept beside.
    assert [k for _, k in run("d")] == [*range(80), *range(80)]
    assert len({i for i, _ in run("d")}) == 160


def test_two_queries_share_a_log(spark, folder, tmp_path, name):
    raw, chunks = f"{name}_raw", f"{name}_chunks"
    ingest.ingest_files(spark, str(folder), raw, str(tmp_path / "c1"), glob="*.html")
    ingest.ingest_chunks(spark, raw, chunks, str(tmp_path / "c2"), EMBEDDER)
    for i in range(2):
        asked = f"{name}_asked{i}"
        spark.createDataFrame([(i, f"Document {i}?")], "qid long, question string").write.saveAsTable(asked)
        answer_stream(
            spark.readStream.table(asked), chunks, name, str(tmp_path / f"q{i}"), EMBEDDER, extractive()
        )
    assert {r.request_id for r in rows_of(spark, name).collect()} == {"0", "1"}


def test_an_old_file_is_read_too(spark, folder, tmp_path, name):
    import os

    def run():
        ingest.ingest_files(spark, str(folder), name, str(tmp_path / "c"), glob="*.html")
        return rows_of(spark, name).count()

    assert run() == 3
    put(folder, "old.html", "from long ago")
    os.utime(folder / "old.html", (1e9, 1e9))
    assert run() == 4


def test_questions_are_answered_once(spark, folder, tmp_path, name):
    raw, chunks, asked = f"{name}_raw", f"{name}_chunks", f"{name}_asked"
    ingest.ingest_files(spark, str(folder), raw, str(tmp_path / "c1"), glob="*.html")
    ingest.ingest_chunks(spark, raw, chunks, str(tmp_path / "c2"), EMBEDDER)
    tables.create_table(spark, asked, "qid BIGINT, question STRING")

    def run(*questions):
        rows = spark.createDataFrame(list(questions), "qid long, question string")
        rows.write.insertInto(asked)
        answer_stream(
            spark.readStream.table(asked), chunks, name, str(tmp_path / "c3"), EMBEDDER, extractive()
        )
        return {r.request_id: (r.answer, r.sources) for r in rows_of(spark, name).collect()}

    first = run((0, "Document 1 says a.It"), (1, " "))
    assert first["0"][0].startswith("Document ") and first["0"][1]
    assert first["1"] == ("ERROR the question should not be empty", [])
    second = run((2, "more?"))
    assert set(second) == {"0", "1", "2"} and rows_of(spark, name).count() == 3


def test_index_in_one_call(spark, folder, name):
    raw = scan_documents(spark, str(folder), "*.html")
    ingest.index_documents(raw, name, EMBEDDER)
    rows = spark.table(name).collect()
    assert len(rows) == 3 and all(len(r.embedding) == 8 and r.uri.endswith(".html") for r in rows)
    assert tables.collection_info(spark, name)["embedder"] == EMBEDDER.name
