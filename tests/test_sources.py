import gzip
import hashlib

import pytest
from conftest import plan
from pyspark.sql import functions as F

from pagequarry.operators.embed import hashed_words
from pagequarry.sources import files, tables


@pytest.fixture
def folder(tmp_path):
    for n in ("a.pdf", "b.pdf", "NOTICE.txt"):
        (tmp_path / n).write_bytes(n.encode())
    return str(tmp_path)


def test_listing_and_glob(spark, folder):
    assert files.list_documents(spark, folder).count() == 3
    rows = files.scan_documents(spark, folder, "*.pdf").collect()
    assert {(r.path.split("/")[-1], bytes(r.content), r.length) for r in rows} == {
        ("a.pdf", b"a.pdf", 5),
        ("b.pdf", b"b.pdf", 5),
    }


def test_listing_reads_no_content(spark, folder):
    listed = plan(files.list_documents(spark, folder).select("name", "length"))
    assert "ReadSchema: struct<path:string,length:bigint>" in listed


def test_exclude_by_name(spark, folder):
    kept = files.exclude_by_name(files.list_documents(spark, folder), F.col("name"), "NOTICE")
    assert {r.name for r in kept.collect()} == {"a.pdf", "b.pdf"}


def test_folder_is_empty(spark, folder, tmp_path):
    (tmp_path / "empty").mkdir()
    assert not files.folder_is_empty(spark, folder)
    assert files.folder_is_empty(spark, str(tmp_path / "empty"))
    assert files.folder_is_empty(spark, str(tmp_path / "missing"))
    with pytest.raises(Exception):
        files.folder_is_empty(spark, "nosuchscheme://x/y")


def test_page_images(spark):
    df = spark.createDataFrame([("/v/pdf_page_18.png",), ("/v/other.png",)], "path string")
    assert [tuple(r) for r in files.page_images(df, F.col("path")).collect()] == [
        (18, "/v/pdf_page_18.png")
    ]


def test_chunk_table_is_made_once_and_filled_by_name(spark, name):
    tables.create_chunk_table(spark, name, note="o'hara")
    tables.create_chunk_table(spark, name)
    df = spark.createDataFrame([("c", "u")], "content string, url string")
    tables.append_by_name(df, name)
    assert [tuple(r) for r in tables.read_table(spark, name).collect()] == [(None, "u", "c", None)]
    assert tables.select_all(spark, name).count() == 1
    properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    assert properties["note"] == "o'hara"


def test_table_complete(spark, name):
    assert not tables.table_complete(spark, name, 0)
    spark.range(3).createOrReplaceTempView(name)
    assert tables.table_complete(spark, name, 3)
    assert not tables.table_complete(spark, name, 4)


def test_collection_refuses_another_embedder(spark, name):
    embedder = hashed_words(2)
    tables.create_collection(spark, name, embedder.dim, embedder.name, "cosine")
    assert tables.collection_info(spark, name) == {
        "dim": "2",
        "embedder": "hashed-words-2",
        "metric": "cosine",
    }
    chunks = spark.createDataFrame(
        [(7, "u", "c", [0.5, 0.5])], "id long, url string, content string, embedding array<float>"
    )
    tables.add_to_collection(chunks, name, embedder)
    row = spark.table(name).first()
    assert (row.id, row.uri, row.document, row.embedding) == ("7", "u", "c", [0.5, 0.5])
    with pytest.raises(ValueError):
        tables.add_to_collection(chunks, name, hashed_words(3))


def test_inference_log(spark, name):
    answers = spark.createDataFrame(
        [(1, "q\n?", "a", ["u"])], "qid long, question string, result string, sources array<string>"
    )
    tables.append_to_log(answers, name)
    tables.append_to_log(answers, name)
    rows = spark.table(name).collect()
    assert len(rows) == 2 and rows[0].request_id == "1" and rows[0].ts is not None
    as_json = tables.log_as_json(spark.table(name)).first()
    assert as_json.request == '{"messages":[{"role":"user","content":"q\\n?"}]}'
    assert as_json.response == '{"result":"a","sources":["u"]}'


def test_adding_again_replaces_and_sync_follows(spark, name):
    embedder = hashed_words(4)
    tables.create_collection(spark, name, embedder.dim, embedder.name)

    def chunks(*rows):
        return spark.createDataFrame(
            [(i, "u", text, [0.0] * 4, change) for i, text, change in rows],
            "id string, url string, content string, embedding array<float>, change string",
        )

    def held():
        return {r.id: r.document for r in spark.table(name).collect()}

    for _ in range(2):
        tables.add_to_collection(chunks(("1", "a", ""), ("2", "b", "")), name, embedder)
        assert spark.table(name).count() == 2
    tables.add_to_collection(chunks(("2", "B", ""), ("3", "c", ""), ("3", "c", "")), name, embedder)
    assert held() == {"1": "a", "2": "B", "3": "c"}
    changes = chunks(("1", None, "delete"), ("3", "C", "update"), ("4", "d", "insert"))
    tables.sync_collection(changes, name, embedder)
    assert held() == {"2": "B", "3": "C", "4": "d"}


def test_a_change_rewrites_only_the_buckets_of_known_ids(spark, name, tmp_path):
    from pathlib import Path

    embedder, home = hashed_words(2), tmp_path / "collection"
    tables.create_collection(spark, name, embedder.dim, embedder.name, path=str(home), buckets=8)

    def chunks(ids, change="update"):
        rows = [(str(i), "u", f"{change} {i}", [0.0, 1.0], change) for i in ids]
        kinds = "id string, url string, content string, embedding array<float>, change string"
        return spark.createDataFrame(rows, kinds)

    def files():
        return {str(p.relative_to(home)) for p in Path(home).glob("bucket=*/*.parquet")}

    tables.add_to_collection(chunks(range(100)), name, embedder)
    before, bucket = files(), spark.table(name).where("id = '7'").first().bucket
    tables.sync_collection(chunks([7], "again"), name, embedder)
    own = {f for f in before if f.startswith(f"bucket={bucket}/")}
    assert before - files() == own and spark.table(name).where("id = '7'").first().document == "again 7"
    # New ids are appended; no file goes.
    now = files()
    tables.add_to_collection(chunks(range(100, 130)), name, embedder)
    assert now <= files() and spark.table(name).count() == 130
    # A bucket that loses all rows is empty, and can be filled again.
    ids = [r.id for r in spark.table(name).where(F.col("bucket") == bucket).collect()]
    tables.sync_collection(chunks(ids, "delete"), name, embedder)
    assert spark.table(name).count() == 130 - len(ids)
    tables.add_to_collection(chunks([7]), name, embedder)
    assert {r.id for r in spark.table(name).where(F.col("bucket") == bucket).collect()} == {"7"}


def test_wide_ids_fit_the_chunk_table(spark, name):
    from pagequarry.operators.ids import wide_id

    tables.create_chunk_table(spark, name, id_type="STRING")
    rows = spark.range(3).select(
        wide_id(F.col("id")).alias("id"), F.lit("u").alias("url"), F.lit("c").alias("content"),
        F.array(F.lit(0.0)).cast("array<float>").alias("embedding"),
    )
    tables.append_by_name(rows, name)
    assert {len(r.id) for r in spark.table(name).collect()} == {32}


ODD_FILES = {
    "ended.txt": b"one\ntwo\r\n\nthree\n",
    "open.txt": b"one\ntwo\nthree, not ended",
    "marked.csv": b"\xef\xbb\xbfa,b\n1,2\n3,4 and more\n",
    "marked open.csv": b"\xef\xbb\xbfa,b\n1,2\n3,4 and more",
    "lines.bin": b"\n" * 50,
    "no lines.bin": bytes(range(11, 256)) * 3,
    "packed.gz": gzip.compress(bytes(range(256)) * 20),
    "p%20 {x} [1]*ü.parquet": bytes(range(256)) * 5,
    "nodot": b"\x00\xff\n" * 40,
    "x": b"a name of one character\n",
    "exact.bin": b"0123456\n" * 4,
    "small": b"\n",
}


def test_files_in_pieces_are_whole_and_no_piece_is_large(spark, tmp_path):
    for name, content in ODD_FILES.items():
        (tmp_path / name).write_bytes(content)
    listed = files.scan_documents(spark, str(tmp_path))
    rows = files.file_pieces(listed.drop("content"), 16).cache()
    found = {}
    for r in rows.orderBy("piece").collect():
        found.setdefault(r.path.rpartition("/")[2], []).append(r)
    assert {n: b"".join(bytes(r.content) for r in p) for n, p in found.items()} == ODD_FILES
    assert max(len(r.content) for n, p in found.items() for r in p if n != "x") == 16
    facts = ("path", "modificationTime", "length")
    assert set(rows.select(*facts).collect()) == set(listed.select(*facts).collect())
    digests = files.piece_digests(rows).collect()
    assert {r.path.rpartition("/")[2]: (r.length, r.digest) for r in digests} == {
        n: (len(c), hashlib.md5(c).hexdigest()) for n, c in ODD_FILES.items()
    }
    assert files.file_pieces(listed.limit(0).drop("content")).count() == 0


def test_a_file_that_grows_while_it_is_cut_is_an_error(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"one\n" * 20)
    listed = files.list_documents(spark, str(tmp_path)).withColumn("length", F.lit(70).cast("long"))
    with pytest.raises(Exception, match="has changed while it was read"):
        files.file_pieces(listed, 16).collect()
