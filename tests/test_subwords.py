"""Subword counts, and chunks of text without spaces."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagequarry.functions.subwords import Trie, read_pieces, subword_counter
from pagequarry.operators import chunk

PIECES = [b"a", b"ab", b"abc", b"bcd", b"c", "é".encode(), b"the", b"th"]


def plain(raw, pieces):
    out = 0
    while raw:
        fits = [p for p in pieces if raw.startswith(p)]
        raw = raw[max(map(len, fits), default=1) :]
        out += 1
    return out


@settings(max_examples=200, deadline=None)
@given(st.text("abcdéth漢", max_size=40), st.sets(st.binary(min_size=1, max_size=4), max_size=20))
def test_longest_pieces(text, more):
    raw, pieces = text.encode(), PIECES + sorted(more)
    cut = Trie(pieces).cut(raw)
    assert b"".join(cut) == raw and len(cut) == plain(raw, pieces)


@settings(max_examples=60, deadline=None)
@given(st.text("abcdeth", min_size=1, max_size=600), st.integers(3, 20))
def test_chunks_of_spaceless_text_are_bounded(text, size):
    count = subword_counter(PIECES)()
    pieces = list(chunk.sentence_pieces(text, count, size))
    chunks = [c for c, _ in chunk.pack(pieces, size, 0)]
    assert "".join(chunks) == text and all(count(c) <= size + 1 for c in chunks)
    assert chunk.count_words(text) == 1


def test_in_a_job(spark, tmp_path):
    import base64

    path = tmp_path / "pieces"
    path.write_bytes(b"".join(base64.b64encode(p) + b" %d\n" % k for k, p in enumerate(PIECES)))
    assert read_pieces(str(path)) == PIECES
    docs = spark.createDataFrame([(1, "abc" * 100), (2, "the the"), (3, None)], "id long, text string")
    chunks = chunk.sentence_chunks(F.col("text"), 10, 0, subword_counter(PIECES))
    rows = {r.id: r.c for r in docs.select("id", chunks.alias("c")).collect()}
    assert len(rows[1]) == 10 and "".join(c.chunk for c in rows[1]) == "abc" * 100
    assert [c.n_units for c in rows[2]] == [2] and rows[3] == []
