import pytest
from conftest import plan
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagequarry.operators import chunk

SPACES = " \t\r\n"
TEXT = st.text(alphabet="ab é.,!?;\n\t ", max_size=400)


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "doc long, text string")


def chunks_of(spark, column, *values):
    rows = chunk.explode_chunks(texts(spark, *values), column, "doc")
    return [(r.doc, r.chunk_ix, r.content, r.n_units) for r in rows.orderBy("doc", "chunk_ix").collect()]


@pytest.mark.parametrize(
    "n, starts", [(10, [0, 3, 6]), (1, [0]), (0, []), (4, [0]), (5, [0, 3]), (7, [0, 3])]
)
def test_stride_starts(spark, n, starts):
    words = [f"w{i}" for i in range(n)]
    got = chunks_of(spark, chunk.stride_chunks(F.col("text"), 4, 1), " ".join(words))
    assert got == [
        (0, i, " ".join(words[s : s + 4]), len(words[s : s + 4])) for i, s in enumerate(starts)
    ]


def test_stride_computes_the_words_once_per_row(spark):
    df = chunk.explode_chunks(texts(spark, "a b"), chunk.stride_chunks(F.col("text")), "doc")
    assert plan(df, "simple").count("split(") == 1


@settings(max_examples=200, deadline=None)
@given(TEXT, st.integers(1, 12), st.integers(0, 11))
def test_sentence_packing_invariants(text, size, overlap):
    overlap = min(overlap, size - 1)
    pieces = list(chunk.sentence_pieces(text, chunk.count_words, size))
    assert "".join(t for t, _ in pieces) == text
    assert all(n <= size for _, n in pieces)
    check_packing(pieces, size, overlap)


@settings(max_examples=200, deadline=None)
@given(TEXT, st.integers(2, 30), st.integers(0, 29))
def test_character_packing_invariants(text, size, overlap):
    overlap = min(overlap, size - 1)
    runs = list(chunk.character_runs(text, size))
    assert "".join(t for run in runs for t, _ in run) == text
    for run in runs:
        assert all(0 < n == len(t) <= size for t, n in run)
        check_packing(run, size, overlap)


def check_packing(pieces, size, overlap):
    """Against a direct search for each chunk's end and the next one's start."""
    sizes = [n for _, n in pieces]
    expected, start = [], 0
    while start < len(pieces):
        end = max(e for e in range(start, len(pieces)) if sum(sizes[start : e + 1]) <= size)
        expected.append(("".join(t for t, _ in pieces[start : end + 1]), sum(sizes[start : end + 1])))
        if end + 1 == len(pieces):
            break
        start = min(
            s
            for s in range(start, end + 2)
            if sum(sizes[s : end + 1]) <= overlap and sum(sizes[s : end + 2]) <= size
        )
    assert list(chunk.pack(pieces, size, overlap)) == expected


def test_sentence_chunks(spark):
    long = " ".join(f"w{i}" for i in range(25)) + "."
    text = f"One two. Three four five! {long} Last one?"
    got = chunks_of(spark, chunk.sentence_chunks(F.col("text"), 10, 3), text, "", "  \n", None)
    assert {d for d, *_ in got} == {0}
    assert all(n <= 10 for *_, n in got)
    assert got[0][2].startswith("One two. Three four five! w0")
    seen = [w for *_, c, _ in got for w in c.split()]
    assert set(seen) == set(text.split()) and got[-1][2].endswith("Last one?")


def test_tokenizer_of_the_caller(spark):
    def load():
        return lambda text: -(-len(text) // 4)

    column = chunk.sentence_chunks(F.col("text"), 5, 2, tokenizer=load)
    got = chunks_of(spark, column, "abcdefgh " * 20 + "x" * 90)
    assert all(n <= 5 and len(c) <= 5 * 4 for *_, c, n in got)
    assert "".join(c for *_, c, _ in got).count("x") >= 90


def test_recursive_chunks(spark):
    text = "para one\n\n" + "word " * 30 + "\n\n" + "y" * 50 + "\n\nend"
    got = [c for *_, c, _ in chunks_of(spark, chunk.recursive_chunks(F.col("text"), 40, 10), text)]
    assert got[0] == "para one" and got[-1] == "end"
    assert all(len(c) <= 40 for c in got)
    assert any(set(c) == {"y"} for c in got)


def test_documents_without_chunks_give_no_row(spark):
    df = texts(spark, "a", "b").withColumn(
        "c", F.when(F.col("doc") == 0, F.array().cast(chunk.CHUNKS))
    )
    assert chunk.explode_chunks(df, F.col("c"), "doc").count() == 0
