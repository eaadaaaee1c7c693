"""Cutting text into overlapping chunks."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.functions.arrays import let
from pagequarry.functions.text import SPACES, split_words, words
from pagequarry.operators.explode import explode_once

CHUNKS = "array<struct<chunk:string,n_units:int>>"

# Sizes and overlaps of the three chunkers, the paragraph break, where
# sentences, phrases and words end, and the separators of the character chunker.
SENTENCE_SIZE, SENTENCE_OVERLAP = 500, 50
CHARACTER_SIZE, CHARACTER_OVERLAP = 1000, 200
STRIDE_SIZE, STRIDE_OVERLAP = 100, 10
PARAGRAPH = re.compile(r"(?:(?!\n\n\n).)+(?:\n\n\n)?|\n\n\n", re.S)
SENTENCE = re.compile(r".+?(?:[.!?][ \t\r\n]+|\Z)", re.S)
PHRASE = re.compile(r".+?(?:[,;:][ \t\r\n]+|\Z)", re.S)
WORD = re.compile(r"[^ \t\r\n]*[ \t\r\n]+|[^ \t\r\n]+")
CHARACTER = re.compile(r".", re.S)
SEPARATORS = ("\n\n", "\n", " ", "")

Piece = tuple[str, int]


def pack(pieces: list[Piece], size: int, overlap: int) -> Iterator[Piece]:
    """Join consecutive pieces into chunks of at most ``size`` units.

    A chunk starts with the last pieces of the one before, as many as total at most
    ``overlap`` and leave room for the next new piece. No piece may exceed ``size``.
    """
    start = total = 0
    for i, (_, n) in enumerate(pieces):
        if total + n > size:
            yield "".join(t for t, _ in pieces[start:i]), total
            while start < i and (total > overlap or total + n > size):
                total -= pieces[start][1]
                start += 1
        total += n
    if pieces:
        yield "".join(t for t, _ in pieces[start:]), total


def sentence_pieces(text: str, count: Callable[[str], int], size: int) -> Iterator[Piece]:
    """Pieces of at most ``size`` tokens: paragraphs if they fit, else their
    sentences, phrases, words, and tokens (``count.pieces``, else characters)."""
    last = getattr(count, "pieces", CHARACTER.findall)

    def cut(part: str, levels: tuple) -> Iterator[Piece]:
        n = count(part)
        if n <= size or not levels:
            yield part, n
        else:
            for piece in levels[0](part):
                yield from cut(piece, levels[1:])

    return cut(text, (PARAGRAPH.findall, SENTENCE.findall, PHRASE.findall, WORD.findall, last))


def character_runs(text: str, size: int, separators=SEPARATORS) -> Iterator[list[Piece]]:
    """Runs of pieces shorter than ``size``, cut at the first separator that occurs.

    A piece that is too long is cut at the later separators into runs of its own, and
    chunks never span two runs. Separators stay at the front of the following piece.
    """
    at = next(i for i, s in enumerate(separators) if s in text)
    sep, later = separators[at], separators[at + 1 :]
    parts = text.split(sep) if sep else list(text)
    pieces = [p for p in parts[:1] + [sep + p for p in parts[1:]] if p]
    run: list[Piece] = []
    for piece in pieces:
        if len(piece) < size or not later:
            run.append((piece, len(piece)))
        else:
            if run:
                yield run
            run = []
            yield from character_runs(piece, size, later)
    if run:
        yield run


def count_words(text: str) -> int:
    return len(split_words(text))


def _chunked(text: Column, chunk_text: Callable[[str], Iterator[Piece]]) -> Column:
    def chunks(document: str | None) -> list[dict]:
        stripped = ((c.strip(SPACES), n) for c, n in chunk_text(document or ""))
        return [{"chunk": c, "n_units": n} for c, n in stripped if c]

    def split(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(chunks)

    return F.pandas_udf(split, CHUNKS)(text)


def sentence_chunks(
    text: Column,
    size: int = SENTENCE_SIZE,
    overlap: int = SENTENCE_OVERLAP,
    tokenizer: Callable[[], Callable[[str], int]] | None = None,
) -> Column:
    """Chunks along sentences. ``tokenizer()`` is called once per batch stream in the
    worker and returns a token counter; words are counted without one."""

    def chunk_text(document: str) -> Iterator[Piece]:
        if "count" not in loaded:
            loaded["count"] = tokenizer() if tokenizer else count_words
        return pack(list(sentence_pieces(document, loaded["count"], size)), size, overlap)

    loaded: dict[str, Callable[[str], int]] = {}
    return _chunked(text, chunk_text)


def recursive_chunks(
    text: Column, size: int = CHARACTER_SIZE, overlap: int = CHARACTER_OVERLAP
) -> Column:
    """Chunks of at most ``size`` characters along blank lines, lines, words."""

    def chunk_text(document: str) -> Iterator[Piece]:
        for run in character_runs(document, size):
            yield from pack(run, size, overlap)

    return _chunked(text, chunk_text)


def stride_chunks(
    text: Column, size: int = STRIDE_SIZE, overlap: int = STRIDE_OVERLAP
) -> Column:
    """Windows of ``size`` words, each ``overlap`` words into the one before.

    Built-in expressions only; ``explode_chunks`` takes the result.
    """
    def windows(listed: Column) -> Column:
        count = F.size(listed)
        starts = F.sequence(
            F.lit(0), F.greatest(count - overlap - 1, F.lit(0)), F.lit(size - overlap)
        )

        def window(start: Column) -> Column:
            return F.struct(
                F.array_join(F.slice(listed, start + 1, size), " ").alias("chunk"),
                F.least(count - start, F.lit(size)).alias("n_units"),
            )

        return F.when(count > 0, F.transform(starts, window))

    return let(words(text), windows)


def explode_chunks(df: DataFrame, chunks: Column, *keys: str) -> DataFrame:
    """One row per chunk with its position; a document without chunks gives no row."""
    return explode_once(df, chunks, *keys, pos="chunk_ix", item="_c").select(
        *keys, "chunk_ix", F.col("_c.chunk").alias("content"), F.col("_c.n_units").alias("n_units")
    )
