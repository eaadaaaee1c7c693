"""The registered queries over a small folder of tables, and each stage of the pipeline."""

import hashlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from test_texts import plain_components, plain_contamination, plain_entities, plain_repeats

import corpus_pipeline
from check import compare, register
from pagequarry.llm import bpe, oracles, queries, toxicity

COLUMNS = {
    "op1_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op2_decontaminate": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op3_hmm": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op4_minmax": "doc_id n_shingles component_id kept",
    "op5_imatch": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op6_warc": "page_id payload_bytes payload_digest record_type refers_to",
    "op7_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op8_repeats": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op9_html": "page_id url text n_chars",
    "op10_toxicity": "doc_id held_out score predicted",
    "op11_language": "doc_id held_out lang_pred score",
    "op12_middle": "doc_id n form prefix_chars middle_chars output_sha256 restored_sha256",
}


@pytest.fixture(scope="module")
def con(testdata):
    connection = duckdb.connect()
    register(connection, testdata)
    return connection


@pytest.mark.parametrize("query", list(COLUMNS))
def test_query_has_a_row_for_each_row(spark, testdata, con, query):
    frame = queries.QUERIES[query](spark, testdata)
    assert set(COLUMNS[query].split()) <= set(frame.columns)
    got = frame.toPandas()
    source = "pages" if "page_id" in frame.columns else "documents"
    assert len(got) == con.sql(f"SELECT count(*) FROM {source}").fetchall()[0][0]
    if query in oracles.ORACLES:
        assert compare(got, con.sql(oracles.ORACLES[query]).df()) is None


def test_repeats_and_components_of_the_tables(spark, testdata, con):
    docs = con.sql("SELECT doc_id, text FROM documents").fetchall()
    got = {r.doc_id: tuple(r)[1:5] for r in queries.op8_repeats(spark, testdata).collect()}
    assert got == plain_repeats(docs)
    roots = {r.doc_id: r.component_id for r in queries.op4_minmax(spark, testdata).collect()}
    assert roots == plain_components(docs)


def test_stages_of_the_pipeline(spark, testdata, con):
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{testdata}/documents.parquet")
    model = queries.toxicity_model(docs, spark.read.parquet(f"{testdata}/labels.parquet"))
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}

    now = stages["toxicity"](spark, docs, testdata)
    assert now.columns == docs.columns
    rows = {r.doc_id: r for r in now.collect()}
    assert set(rows) == {i for i, s in scores.items() if s < 0.5}

    now = stages["near_duplicates"](spark, now, testdata)
    roots = plain_components([(i, r.text) for i, r in rows.items()])
    assert now.columns == docs.columns
    rows = {r.doc_id: r for r in now.collect()}
    assert set(rows) == {i for i, root in roots.items() if i == root}

    items = con.sql("SELECT item_id, text FROM benchmark").fetchall()
    now = stages["decontamination"](spark, now, testdata)
    clean = {i for i, r in rows.items() if not plain_contamination(r.text, items)[-1]}
    assert now.columns == docs.columns
    before = {r.doc_id: r for r in now.collect()}
    assert set(before) == clean

    now = stages["personal_data"](spark, now, testdata)
    assert now.columns == docs.columns
    after = {r.doc_id: r for r in now.collect()}
    assert set(after) == clean
    for i, r in after.items():
        assert r.n_chars == len(r.text) and r.lang == before[i].lang
        if not plain_entities(before[i].text):
            assert r.text == before[i].text
        assert not plain_entities(r.text)

    content = bpe.read_ranks(public_tokenizers.path(queries.VOCABULARY))
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.parse_ranks(content), special_tokens={}
    )
    for r in stages["tokens"](spark, now, testdata).collect():
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids == library.encode_ordinary(after[r.doc_id].text)
        assert r.decoded_sha256 == hashlib.sha256(after[r.doc_id].text.encode()).hexdigest()


def test_one_row_of_each_group_stays(spark, testdata):
    same = " ".join(f"word{i}" for i in range(40))
    rows = [(1, same), (None, same), (None, same), (1, same), (1, "quite another text"), (7, same + " more")]
    rows += [(None, None), (None, None), (3, ""), (None, "only here, and without an id"), (0, "other words of its own")]
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], "doc_id long, text string, row string, n_chars long")
    kept = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs.repartition(3), testdata)
    assert kept.columns == docs.columns
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=key) == sorted(
        [(1, same), (1, "quite another text"), (None, None), (None, None), (3, "")]
        + [(None, "only here, and without an id"), (0, "other words of its own")],
        key=key,
    )


def test_pipeline_of_an_empty_table(spark, testdata):
    docs = spark.read.parquet(f"{testdata}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, testdata)
        assert docs.count() == 0
