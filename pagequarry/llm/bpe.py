"""Byte-level BPE as a monoid: encodings of neighbouring strings are joined, not redone.

A string is halved down to a few bytes, whose merges are done in place. Two encodings are joined by encoding again a
window of tokens around the seam, which grows until the tokens outside it stand: a row of
tokens is the encoding of its bytes exactly when every two neighbours, encoded alone, come
out as they are (a merge across a seam would be the lowest one for its two neighbours
too). Decoding concatenates the bytes of tokens up the tree.

Defined cases: a null or empty text has no tokens and decodes to nothing. Repeated rows
each get their row. Only the named columns are read.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

LEAF_BYTES = 6  # strings up to this size are not halved
REMEMBERED = 64  # characters; longer pieces are not remembered
# Pieces, leaves and seams in a generation, some 50 MB in all: a worker meets most
# pieces of its partition again, so each is encoded about once.
PIECES, LEAVES, SEAMS = 200_000, 60_000, 60_000
TEXT_BLOCK = 1 << 20  # characters of a text that are split into pieces at a time
LEAF = 4096  # tokens that decoding concatenates at once
SAFE_CUT = regex.compile(r"(?<=\p{L})(?= \p{L})")


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def parse_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(t): int(r) for t, r in map(bytes.split, content.splitlines()) if t}


class Memory(dict):
    """Results of ``make``, the recently used ones kept: what is asked for again while its
    generation is the old one moves to the new one, the rest is forgotten."""

    def __init__(self, make: Callable, size: int):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Encoder:
    """The merges of one vocabulary, and what is remembered of earlier pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.split = regex.compile(pattern)
        self.packed = {t: r.to_bytes(4, "little") for t, r in ranks.items()}
        self.seams = Memory(lambda pair: self.short(pair[0] + pair[1]), SEAMS)
        self.leaves = Memory(self.merge, LEAVES)
        self.pieces = Memory(self.piece, PIECES)

    def piece(self, piece: str) -> bytes:
        """Packed ids of one match of the pattern: of the token it is, or of its encoding."""
        raw = piece.encode()
        known = self.packed.get(raw)
        if known is None:
            known = b"".join(map(self.packed.__getitem__, self.tree(raw)))
        return known

    def tree(self, raw: bytes) -> list[bytes]:
        """Encode the two halves and join them."""
        if len(raw) <= LEAF_BYTES:
            return self.leaves[raw]
        half = len(raw) // 2
        return self.join(self.tree(raw[:half]), self.tree(raw[half:]))

    def join(self, left: list[bytes], right: list[bytes]) -> list[bytes]:
        """The encoding of two neighbours' bytes from their encodings."""
        window = self.seams[left[-1], right[0]]
        a = b = 1
        while True:
            fits_left = a == len(left) or self.stand(left[-a - 1], window[0])
            fits_right = b == len(right) or self.stand(window[-1], right[b])
            if fits_left and fits_right:
                return left[: len(left) - a] + window + right[b:]
            if not fits_left:
                a = min(2 * a, len(left))
            if not fits_right:
                b = min(2 * b, len(right))
            window = self.short(b"".join(left[len(left) - a :] + right[:b]))

    def stand(self, a: bytes, b: bytes) -> bool:
        """Whether two tokens, encoded as neighbours, stay as they are."""
        window = self.seams[a, b]
        return len(window) == 2 and window[0] == a

    def short(self, raw: bytes) -> list[bytes]:
        """Merges that are remembered if the string is short."""
        return self.leaves[raw] if len(raw) <= 2 * LEAF_BYTES else self.merge(raw)

    def merge(self, raw: bytes) -> list[bytes]:
        """Join the two neighbours of the lowest rank, the leftmost first, while any has one."""
        if len(raw) > 48:
            return self._merge_long(raw)
        none, rank = 1 << 31, self.ranks.get
        parts = [raw[i : i + 1] for i in range(len(raw))]
        ranks = [rank(raw[i : i + 2], none) for i in range(len(raw) - 1)]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            parts[i] += parts.pop(i + 1)
            ranks.pop(i)
            if i < len(ranks):
                ranks[i] = rank(parts[i] + parts[i + 1], none)
            if i:
                ranks[i - 1] = rank(parts[i - 1] + parts[i], none)
        return parts

    def _merge_long(self, raw: bytes) -> list[bytes]:
        """The same over a heap of neighbours and a linked list of parts."""
        size, rank = len(raw), self.ranks.get
        end, before = list(range(1, size + 1)), list(range(-1, size))
        heap = [(r, i, i + 2) for i in range(size - 1) if (r := rank(raw[i : i + 2])) is not None]
        heapq.heapify(heap)
        gone = bytearray(size + 1)
        while heap:
            _, i, stop = heapq.heappop(heap)
            middle = end[i]
            if gone[i] or middle >= size or end[middle] != stop:
                continue  # one of the two parts has changed since
            gone[middle], end[i] = 1, stop
            if stop < size:
                before[stop] = i
                r = rank(raw[i : end[stop]])
                if r is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if i:
                p = before[i]
                r = rank(raw[p:stop])
                if r is not None:
                    heapq.heappush(heap, (r, p, stop))
        out, i = [], 0
        while i < size:
            out.append(raw[i : end[i]])
            i = end[i]
        return out

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers.

        A long text is cut where the pattern must end a match: before a space between letters.
        """
        out, at = [], 0
        while at < len(text):
            stop = len(text)
            if stop - at > TEXT_BLOCK and (cut := SAFE_CUT.search(text, at + TEXT_BLOCK)):
                stop = cut.start()
            found = self.split.findall(text[at:stop])
            if max(map(len, found)) <= REMEMBERED:
                out += map(self.pieces.__getitem__, found)
            else:
                out += [self.pieces[p] if len(p) <= REMEMBERED else self.piece(p) for p in found]
            at = stop
        return b"".join(out)

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= LEAF:
            return b"".join(map(self.tokens.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


_ENCODERS: dict[tuple[int, str], Encoder] = {}


def _encoder(content: bytes, pattern: str) -> Encoder:
    """One encoder for each vocabulary and worker process, with what it remembers."""
    key = hash(content), pattern
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(parse_ranks(content), pattern)
    return _ENCODERS[key]


def forget() -> None:
    """Let go of what an idle worker would hold."""
    _ENCODERS.clear()
    pa.default_memory_pool().release_unused()


def ship_ranks(spark: SparkSession, path: str):
    """A vocabulary, read on the driver: a file of ranks, one line a token."""
    return spark.sparkContext.broadcast(read_ranks(path))


def _replace(batch: pa.RecordBatch, old: str, new: pa.Array, name: str) -> pa.RecordBatch:
    place = batch.schema.get_field_index(old)
    arrays, names = list(batch.columns), list(batch.schema.names)
    arrays[place], names[place] = new, name
    return pa.RecordBatch.from_arrays(arrays, names=names)


def encode(docs: DataFrame, ranks, pattern: str) -> DataFrame:
    """(doc_id, text) to (doc_id, ids): token ids as little-endian unsigned 32-bit integers."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks.value, pattern)
        for batch in parts:
            texts = batch.column("text").cast(pa.binary())
            ids = [encoder.encode((t.as_py() or b"").decode("utf-8", "replace")) for t in texts]
            yield _replace(batch, "text", pa.array(ids, pa.binary()), "ids")
        forget()

    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, ids binary")


def decode(encoded: DataFrame, ranks, pattern: str) -> DataFrame:
    """(doc_id, ids) to (doc_id, ids, decoded): the bytes that the ids stand for."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks.value, pattern)
        for batch in parts:
            texts = [
                encoder.decode(np.frombuffer(i.as_py() or b"", "<u4").tolist())
                for i in batch.column("ids")
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.binary())],
                names=[*batch.schema.names, "decoded"],
            )
        forget()

    encoded = encoded.select("doc_id", "ids")
    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.mapInArrow(run, f"doc_id {kind}, ids binary, decoded binary")


def round_trip(docs: DataFrame, ranks, pattern: str) -> DataFrame:
    """(doc_id, text) to (doc_id, ids, decoded): encoded, and decoded from the ids alone, in the
    same task, so that one worker holds the vocabulary and the ids move once."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks.value, pattern)
        for batch in parts:
            ids, texts = [], []
            for text in batch.column("text").cast(pa.binary()):
                ids.append(encoder.encode((text.as_py() or b"").decode("utf-8", "replace")))
                texts.append(encoder.decode(np.frombuffer(ids[-1], "<u4").tolist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array(texts, pa.binary())],
                names=["doc_id", "ids", "decoded"],
            )
        forget()

    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, ids binary, decoded binary")
