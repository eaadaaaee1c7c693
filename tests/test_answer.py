import pytest
from conftest import plan
from pyspark.sql import functions as F

from pagequarry.operators import answer
from pagequarry.operators.answer import Generator
from pagequarry.operators.embed import embed, hashed_words
from pagequarry.sources import tables

EMBEDDER = hashed_words(64)
CHUNKS = [
    (1, "u1", "red apples grow. On trees they do.", 3),
    (2, "u2", "green pears grow! On trees too.", 1),
    (3, "u1", "ships sail the sea", 3),
]


def chunks(spark):
    df = spark.createDataFrame(CHUNKS, "id long, url string, content string, page int")
    return df.withColumn("embedding", embed(F.col("content"), EMBEDDER))


def questions(spark, *asked):
    return spark.createDataFrame(list(enumerate(asked)), "qid long, question string")


def only_asked():
    """A model that must never see a blank question."""

    def load():
        import re

        def call(prompts):
            asked = [re.search(r"Question: (.*)\nAnswer:$", p, re.S).group(1) for p in prompts]
            assert all(q.strip() for q in asked)
            return [f"about {q}" for q in asked]

        return call

    return Generator("asked", load)


def test_blank_questions_never_reach_the_model(spark):
    asked = questions(spark, "red apples", " \t", "ships", " ")
    rows = answer.answer_questions(asked, chunks(spark), EMBEDDER, only_asked(), k=2).collect()
    got = {r.qid: (r.result, r.sources) for r in rows}
    assert got[0][0] == "about red apples" and got[0][1][0] == "u1"
    assert got[1] == ("ERROR the question should not be empty", [])
    assert got[3] == ("ERROR the question should not be empty", [])
    assert len(rows) == 4


def test_extractive_answer_and_bounded_parallelism(spark):
    asked = questions(spark, "red apples grow on trees", "ships sea")
    answered = answer.answer_questions(
        asked, chunks(spark), EMBEDDER, answer.extractive(), k=1, parallel=5
    )
    assert "RoundRobinPartitioning(5)" in plan(answered, "simple")
    # Once for the chunks, which are not stored here, and once for the answers.
    assert plan(answered, "simple").count("ArrowEvalPython") == 2
    assert {r.qid: r.result for r in answered.collect()} == {
        0: "red apples grow.",
        1: "ships sail the sea",
    }


def test_extractive_limit():
    call = answer.extractive(3).load()
    assert call(["a b c d e.\n\nmore", "x. y", ""]) == ["a b c", "x.", ""]


def test_question_without_hits_keeps_its_row(spark):
    none = chunks(spark).where("false")
    rows = answer.answer_questions(
        questions(spark, "any"), none, EMBEDDER, answer.extractive()
    ).collect()
    assert [(r.qid, r.sources) for r in rows] == [(0, [])]


def hits(spark):
    rows = [
        (0, 2, 2, "u2", "second", 1),
        (0, 1, 1, "u1", "first", 3),
        (0, 3, 3, "u1", "third", 3),
        (1, 1, 1, "u1", "first", 3),
    ]
    return spark.createDataFrame(
        rows, "qid long, rank int, id long, url string, content string, page int"
    )


def test_prompts(spark):
    rows = answer.build_prompts(questions(spark, "why?", "", "none?"), hits(spark)).collect()
    got = {r.qid: r for r in rows}
    assert got[0].prompt == "first\n\nsecond\n\nthird\n\nQuestion: why?\nAnswer:"
    assert got[0].sources == ["u1", "u2"]
    assert got[1].prompt is None
    assert got[2].prompt == "\n\nQuestion: none?\nAnswer:" and got[2].sources == []


def test_sources(spark):
    got = {r.qid: r.sources for r in answer.answer_sources(hits(spark)).collect()}
    assert got == {0: ["u1", "u2"], 1: ["u1"]}


def test_source_summary(spark):
    row = answer.source_summary(hits(spark)).where("qid = 0").first()
    assert row.doc_pages == "Document Page Numbers =1,3"
    assert row.doc_names == "Document =u1,u2"
    assert row.doc_content == "Document Details =first.\nsecond.\nthird"


def test_format_and_split(spark):
    df = spark.createDataFrame(
        [(0, "a\n\nb", ["u"])], "qid long, result string, sources array<string>"
    )
    assert answer.format_answers(df).first().html.startswith("a<br/><br/>b<br/>")
    items = answer.split_answers(df, "qid").collect()
    assert [(r.pos, r.item) for r in items] == [(0, "a"), (1, "b")]


def test_limit_questions(spark):
    df = questions(spark, *[f"q{i}" for i in range(60)]).repartition(5)
    got = [r.question for r in answer.limit_questions(df, "qid").collect()]
    assert got == [f"q{i}" for i in range(50)]


def test_collection_is_searched_by_its_metric_and_embedder(spark, name):
    tables.create_collection(spark, name, 64, EMBEDDER.name, "cosine")
    tables.add_to_collection(chunks(spark), name, EMBEDDER)
    asked = questions(spark, "red apples grow", "ships")
    rows = answer.retrieve_from(name, asked, EMBEDDER, k=1).collect()
    assert {(r.qid, r.id, r.url) for r in rows} == {(0, "1", "u1"), (1, "3", "u1")}
    with pytest.raises(ValueError):
        answer.retrieve_from(name, asked, hashed_words(32))


def recorded(tmp_path, **options):
    """A model that writes down what it is asked at once."""
    import json

    log = str(tmp_path / "requests")

    def load():
        def call(request):
            with open(log, "a") as file:
                file.write(json.dumps([request.prompts, request.max_tokens, request.key]) + "\n")
            return [f"{p}!" for p in request.prompts]

        return call

    return Generator("recorded", load, requests=True, **options), lambda: [
        json.loads(line) for line in open(log)
    ]


def test_requests_are_filled_across_batches_and_bounded(spark, tmp_path):
    model, asked = recorded(tmp_path, max_tokens=2)
    prompts = [" ".join(["w"] * n) for n in (3, 3, 3, 30, 1, 1, 1, 1, 1, 3)]
    rows = [(i, p) for i, p in enumerate(prompts)] + [(10, None)]
    df = spark.createDataFrame(rows, "id long, prompt string").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        answers = df.withColumn("a", answer.generate(F.col("prompt"), model, 4, 12)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {r.id: r.a for r in answers} == {i: p and f"{p}!" for i, p in rows}
    # With two tokens of answer each: 5 + 5, 5, 32 alone, four of 3, 3 + 5.
    assert [len(p) for p, _, _ in asked()] == [2, 1, 1, 4, 2]
    assert all(most == 2 for _, most, _ in asked()) and len({key for *_, key in asked()}) == 5


def test_a_request_is_asked_again_under_its_key(spark, tmp_path):
    marker = str(tmp_path / "keys")

    def load():
        def call(request):
            with open(marker, "a+") as file:
                file.seek(0)
                nth = len(file.readlines())
                file.write(request.key + "\n")
            if nth < 2:
                raise TimeoutError
            return ["late"] * len(request.prompts)

        return call

    model = Generator("slow", load, requests=True, retry_on=(TimeoutError,), pause=0.01)
    df = spark.createDataFrame([("a",), ("b",)], "prompt string").coalesce(1)
    assert {r[0] for r in df.select(answer.generate(F.col("prompt"), model)).collect()} == {"late"}
    keys = open(marker).read().split()
    assert len(keys) == 3 and len(set(keys)) == 1


def test_the_token_limit_reaches_the_model(spark):
    asked = questions(spark, "red apples grow on trees")
    found = answer.answer_questions(asked, chunks(spark), EMBEDDER, answer.extractive(2), k=1)
    assert found.first().result == "red apples"
