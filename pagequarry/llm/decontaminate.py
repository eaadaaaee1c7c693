"""Benchmark decontamination: a Wu-Manber search for the word windows of test items.

The letters of the search are whole words. A table of shifts, indexed by the hash of a
block of two words, tells how far the search may move without missing a window; where the
shift is zero, the block picks a bucket of windows that end in it, the hash of their first
block leaves few of them, and these are compared word by word.

Defined cases: a null or empty text has no words and no hits. An item of fewer words than
a window, but not none, is one window. Null item ids are left out of ``items`` and their
windows still count as hits. Repeated rows each get their row. Only the named columns are
read, so others may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.llm import batches

WINDOW = 10
BLOCK = 2
BLOCK_BYTES = 16 << 20  # windows of one broadcast block
LANE = 256  # neighbouring window ends that one lane of the scan walks over
RESULT = (
    "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
    "items array<string>"
)


def item_windows(text: str | None, window: int = WINDOW) -> list[bytes]:
    """The windows of an item: ``window`` neighbouring words, or all of a shorter item."""
    data = batches.lower(np.frombuffer((text or "").encode(), np.uint8))
    found = batches.Words(data, np.array([0, len(data)]), batches.WORD_BYTES)
    raw = data.tobytes()
    words = [raw[s:e] for s, e in zip(found.start.tolist(), found.end.tolist(), strict=True)]
    if not words:
        return []
    return [b" ".join(words[i : i + window]) for i in range(max(1, len(words) - window + 1))]


def _hash_words(windows: list[list[bytes]]) -> np.ndarray:
    flat = b" ".join(w for words in windows for w in words)
    data = np.frombuffer(flat, np.uint8)
    found = batches.Words(data, np.array([0, len(data)]), batches.WORD_BYTES)
    return found.hashes().reshape(len(windows), -1)


class Search:
    """The tables for windows of one length."""

    def __init__(self, windows: dict[bytes, list[str]]):
        self.windows = sorted(windows)
        self.items = [windows[w] for w in self.windows]
        hashes = _hash_words([w.split() for w in self.windows])
        self.length = hashes.shape[1]
        self.block = min(BLOCK, self.length)
        places = self.length - self.block + 1
        blocks = np.stack(
            [self.blocks(row) for row in hashes] if len(hashes) else np.empty((0, places))
        )
        bits = max(16, int(4 * blocks.size).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        # The furthest move that cannot pass the end of any window.
        self.shift = np.full(1 << bits, places, np.int64)
        for place in range(places):
            np.minimum.at(self.shift, blocks[:, place] & self.mask, places - 1 - place)
        order = np.argsort(blocks[:, -1], kind="stable")
        self.order, self.suffix, self.prefix = order, blocks[order, -1], blocks[order, 0]

    def blocks(self, words: np.ndarray) -> np.ndarray:
        return batches.sequence_hash(words, self.block)

    def candidates(self, blocks: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Places of blocks with shift zero; each lane walks from ``first`` to before ``last``."""
        moves = self.shift[blocks & self.mask]
        found = []
        at, last = first[first < last], last[first < last]
        while len(at):
            move = moves[at]
            found.append(at[move == 0])
            at = at + np.maximum(move, 1)
            going = at < last
            at, last = at[going], last[going]
        return np.sort(np.concatenate(found)) if found else np.empty(0, np.int64)

    def find(self, words: batches.Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word, window) of every occurrence inside a text."""
        none = np.empty(0, np.int64), np.empty(0, np.int64)
        starts = batches.inside_texts(words.first, self.length)
        if not len(starts):
            return none
        offset = self.length - self.block
        blocks = self.blocks(hashes)
        runs = np.maximum(words.counts() - self.length + 1, 0)
        lanes = -(-runs // LANE)
        text = np.repeat(np.arange(len(runs)), lanes)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        first = words.first[text] + nth * LANE
        last = np.minimum(first + LANE, words.first[text] + runs[text])
        ends = self.candidates(blocks, first + offset, last + offset)
        low = np.searchsorted(self.suffix, blocks[ends], "left")
        many = np.searchsorted(self.suffix, blocks[ends], "right") - low
        found_at, found_window = [], []
        for part in np.array_split(np.arange(len(ends)), max(1, int(many.sum()) // 1_000_000)):
            count = many[part]
            entry = np.repeat(low[part] - (np.cumsum(count) - count), count) + np.arange(count.sum())
            at = np.repeat(ends[part] - offset, count)
            likely = self.prefix[entry] == blocks[at]
            found_at.append(at[likely])
            found_window.append(self.order[entry[likely]])
        at, window = np.concatenate(found_at), np.concatenate(found_window)
        same = np.fromiter(
            (self.equal(words, a, w) for a, w in zip(at.tolist(), window.tolist(), strict=True)),
            bool,
            len(at),
        )
        return at[same], window[same]

    def equal(self, words: batches.Words, at: int, window: int) -> bool:
        """Compare word by word: everything between words counts as one space."""
        text = words.clean[words.start[at] : words.end[at + self.length - 1]]
        return b" ".join(text.split()) == self.windows[window]


TO_SPACE = bytes(b if batches.WORD_BYTES[b] else 32 for b in range(256))


def searches(rows: list[tuple[bytes, str | None]]) -> list[Search]:
    """One search for each length of window."""
    lengths: dict[int, dict[bytes, list[str]]] = {}
    for window, item in rows:
        items = lengths.setdefault(window.count(b" ") + 1, {}).setdefault(window, [])
        if item is not None:
            items.append(item)
    return [Search(windows) for _, windows in sorted(lengths.items())]


def scan(blocks: list, keep: Callable | None, columns: list[str]) -> Callable:
    """A job over Arrow batches: look for the windows of every block in every text."""
    built: dict[int, list[Search]] = {}

    def tables(k: int) -> list[Search]:
        if k not in built:
            built.clear()  # one block's tables at a time
            built[k] = searches(blocks[k].value)
        return built[k]

    def rows(batch: pa.RecordBatch) -> dict[str, list]:
        out: dict[str, list] = {"n_words": [], "n_hit": [], "items": []}
        done = []
        for _, _, data, texts in batches.pieces(batch):
            words = batches.Words(batches.lower(data), texts, batches.WORD_BYTES)
            words.clean = words.data.tobytes().translate(TO_SPACE)
            done.append((words, words.hashes(), np.zeros(len(words) + 1, np.int64), {}))
        for k in range(len(blocks)):
            for search in tables(k):
                for words, hashes, hit, items in done:
                    at, window = search.find(words, hashes)
                    np.add.at(hit, at, 1)
                    np.add.at(hit, at + search.length, -1)
                    owner = np.searchsorted(words.first, at, "right") - 1
                    for text, w in set(zip(owner.tolist(), window.tolist(), strict=True)):
                        items.setdefault(text, set()).update(search.items[w])
        for words, _, hit, items in done:
            covered = np.concatenate([[0], np.cumsum(np.cumsum(hit)[:-1] > 0)])
            out["n_words"] += words.counts().tolist()
            out["n_hit"] += (covered[words.first[1:]] - covered[words.first[:-1]]).tolist()
            out["items"] += [sorted(items.get(t, ())) for t in range(len(words.first) - 1)]
        return out

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            found = rows(batch)
            if keep:
                yield batch.filter(pa.array([n == 0 for n in found["n_hit"]], pa.bool_()))
                continue
            items = found["items"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in columns]
                + [
                    pa.array(found["n_words"], pa.int64()),
                    pa.array(found["n_hit"], pa.int64()),
                    pa.array([len(i) for i in items], pa.int64()),
                    pa.array([hashlib.sha256(",".join(i).encode()).hexdigest() for i in items]),
                    pa.array([n > 0 for n in found["n_hit"]], pa.bool_()),
                    pa.array(items, pa.list_(pa.string())),
                ],
                names=[*columns, "n_words", "n_hit",
                       "n_items", "items_sha256", "contaminated", "items"],
            )

    return run


def window_blocks(benchmark: DataFrame, window: int = WINDOW, most: int = BLOCK_BYTES) -> list:
    """The distinct (window, item) rows in broadcast blocks of about ``most`` bytes.

    The rows are dealt to blocks by their hash, so a window shared by many items is
    spread as well; the driver holds one block at a time.
    """

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            items, windows = [], []
            for item, text in zip(
                batch.column("item_id").to_pylist(), batch.column("text").to_pylist(), strict=True
            ):
                own = item_windows(text, window)
                items += [item] * len(own)
                windows += own
            yield pa.RecordBatch.from_arrays(
                [pa.array(windows, pa.binary()), pa.array(items, pa.string())],
                names=["window", "item"],
            )

    spark = benchmark.sparkSession
    rows = (
        benchmark.select(F.col("item_id").cast("string"), "text")
        .mapInArrow(cut, "window binary, item string")
        .distinct()
    )
    size = rows.agg(F.sum(F.octet_length("window") + 64)).first()[0] or 0
    count = max(1, -(-size // most))
    block = F.pmod(F.xxhash64("window", "item"), F.lit(count))
    return [
        spark.sparkContext.broadcast(
            [(bytes(r.window), r.item) for r in rows.where(block == k).collect()]
        )
        for k in range(count)
    ]


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """For each document the words that lie in a window of a benchmark item, and the items.

    ``docs`` (doc_id, text) is scanned where it lies, with no shuffle; ``benchmark``
    (item_id, text) goes past it in blocks.
    """
    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    job = scan(window_blocks(benchmark, window), None, ["doc_id"])
    return docs.mapInArrow(job, f"doc_id {kind}, {RESULT}")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents, with all their columns, in which no benchmark window occurs."""
    return docs.mapInArrow(scan(window_blocks(benchmark, window), True, []), docs.schema)
