"""Removal of bytes that repeat earlier text, by suffix arrays over the shared passages.

A byte goes if a string of 100 bytes that covers it also starts earlier: in a document of
smaller id, or earlier in its own. Every such string (window) contains an anchor, the
least of its 16-byte hashes, which depends on the window alone. Windows with one anchor
lie in a run; its left and right half each have a core, the bytes that all windows of the
half share. Equal windows have equal cores, so halves are dealt by the hash of their core,
packed, and three things happen where they meet: a core that nothing else has is dropped;
halves equal to an earlier one are repeats; of halves that share a core but differ, the
first of each meet in a pool, where a suffix array (see ``grouping``) puts equal windows
side by side. Each text moves once to meet its repeats, and again if it is in a pool.

Hashes of 48 bits deal the cores and tell halves of one core apart; windows in the suffix
array are compared byte by byte.

Defined cases: a null or empty text, or one shorter than a window, keeps its bytes. Ids are
integers, null is the largest. Rows of one id are ordered by the start alone, and told apart by
64 bits of hash of their texts: of rows that are repeated exactly none is earlier, so all come
out alike.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.llm import batches
from pagequarry.llm.grouping import suffix_array
from pagequarry.scratch import materialise

WINDOW = 100
ANCHOR = 16
REACH = WINDOW - ANCHOR + 1  # windows that may share an anchor
HALF = (REACH + 1) // 2
FINE = 8  # windows of the finer cores that are compared before sorting
LONG = 4 << 20  # texts beyond this are read in overlapping parts
POOL_BYTES = 128 << 10  # text of one suffix array
NO_ID = 2**63 - 1
PLACE = np.uint64(0xFFFFFFF)  # low bits of an anchor's hash give way to its place
HASH_BITS = np.uint64(16)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    step = 1
    while step * 2 <= width:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    rest = width - step
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def halves(data: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, first window, windows, distance to the anchor, hash of the core, hash of all) of
    every half run. Positions count from the beginning of ``data``."""
    at = batches.inside_texts(texts, WINDOW)
    if not len(at):
        return tuple(np.empty(0, t) for t in (int, int, int, int, np.uint64, np.uint64))
    sums = batches.prefix_sums(data)
    place = np.arange(len(data) - ANCHOR + 1)
    key = batches.span_hash(sums, place, place + ANCHOR) & ~PLACE | place.astype(np.uint64)
    anchor = (_least(key, REACH)[at] & PLACE).astype(np.int64)
    left = anchor - at >= HALF
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(anchor) != 0) | (left[1:] != left[:-1]) | (np.diff(at) != 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(at)))
    start, anchor, left = at[first], anchor[first], left[first]
    low = np.where(left, anchor - HALF, anchor)
    high = np.where(left, anchor - REACH + 1, anchor - HALF + 1) + WINDOW
    core = batches.span_hash(sums, low, high) ^ left
    whole = batches.span_hash(sums, start, start + count - 1 + WINDOW)
    owner = np.searchsorted(texts, start, "right") - 1
    return owner, start, count, anchor - start, core >> HASH_BITS, whole >> HASH_BITS


def _six(values: np.ndarray) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from_six(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return wide.reshape(-1).view("<u8")


def pack(core, whole, ident, mark, start, count, distance) -> bytes:
    """Half runs as bytes: the hashes, then the numbers by byte, compressed."""
    steps = np.diff(ident, prepend=0)
    numbers = b"".join(
        x.astype(f"<i{w}").view(np.uint8).reshape(-1, w).T.tobytes()
        for x, w in ((steps, 8), (start, 8), (count, 1), (distance, 1))
    )
    return _six(core) + _six(whole) + mark.astype("<i8").tobytes() + zlib.compress(numbers, 1)


def unpack(blob: bytes, size: int) -> list[np.ndarray]:
    core, whole = _from_six(blob[: 6 * size]), _from_six(blob[6 * size : 12 * size])
    mark = np.frombuffer(blob, "<i8", size, 12 * size)
    numbers, out, at = zlib.decompress(blob[20 * size :]), [], 0
    for w in (8, 8, 1, 1):
        rows = np.frombuffer(numbers, np.uint8, size * w, at).reshape(w, size).T.copy()
        out.append(rows.view(f"<i{w}").reshape(-1).astype(np.int64))
        at += size * w
    return [core, whole, np.cumsum(out[0]), mark, *out[1:]]


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, text ends, row, offset) of a few texts at a time; long texts in parts that
    overlap by less than a window, so that each window lies in one."""
    for first, last, data, texts in batches.pieces(batch):
        if len(data) <= LONG:
            yield data, texts, np.arange(first, last), np.zeros(last - first, np.int64)
            continue
        for offset in range(0, max(len(data) - WINDOW + 1, 1), LONG):
            part = data[offset : offset + LONG + WINDOW - 1]
            yield part, np.array([0, len(part)]), np.array([first]), np.array([offset])


def _dealt(docs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, n, runs): the half runs of (ident, mark, text), packed by hash of their core."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            idents = batch["ident"].to_numpy()
            marks = batch["mark"].to_numpy()
            for data, texts, rows, offset in _parts(batch):
                owner, start, count, distance, core, whole = halves(data, texts)
                ident, mark = idents[rows[owner]], marks[rows[owner]]
                at = start - texts[owner] + offset[owner]
                bucket = (core % np.uint64(buckets)).astype(np.int64)
                order = np.lexsort((at, ident, bucket))
                cuts = np.flatnonzero(np.diff(bucket[order])) + 1
                names, sizes, blobs = [], [], []
                for which in np.split(order, cuts) if len(order) else ():
                    names.append(int(bucket[which[0]]))
                    sizes.append(len(which))
                    columns = (core, whole, ident, mark, at, count, distance)
                    blobs.append(pack(*(x[which] for x in columns)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(blobs, pa.binary()),
                    ],
                    names=["bucket", "n", "runs"],
                )

    return docs.mapInArrow(run, "bucket long, n long, runs binary")


FOUND = "ident long, mark long, at long, count int, distance int, core long, same boolean"


def _met(dealt: DataFrame) -> DataFrame:
    """Half runs that repeat an earlier one (``same``), and the first ones of those that share a
    core but differ. A task holds the packed runs of its buckets."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[int, bytes]]] = {}
        for batch in parts:
            for name, size, blob in zip(
                batch["bucket"].to_pylist(), batch["n"].to_pylist(), batch["runs"], strict=True
            ):
                held.setdefault(name, []).append((size, blob.as_py()))
        for name in sorted(held):
            unpacked = [unpack(blob, size) for size, blob in held.pop(name)]
            core, whole, ident, mark, at, count, distance = map(
                np.concatenate, zip(*unpacked, strict=True)
            )
            # Only cores that come up twice are sorted further.
            kept = np.argsort(core, kind="stable")
            new = np.ones(len(kept) + 1, bool)
            new[1:-1] = core[kept][1:] != core[kept][:-1]
            kept = kept[~(new[:-1] & new[1:])]
            if not len(kept):
                continue
            order = kept[np.lexsort((at[kept], ident[kept], whole[kept], core[kept]))]
            core, whole, ident, at = core[order], whole[order], ident[order], at[order]
            mark, count, distance = mark[order], count[order], distance[order]
            head = np.ones(len(order), bool)
            head[1:] = core[1:] != core[:-1]
            first = head.copy()
            first[1:] |= whole[1:] != whole[:-1]
            group = np.cumsum(head) - 1
            kinds = np.bincount(group, first)
            # Equal to one that starts earlier; a tie (rows of one id) is not earlier.
            lead = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
            same = ~first & ((ident != ident[lead]) | (at != at[lead]))
            out = np.flatnonzero(same | (kinds[group] > 1) & ~same)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ident[out]),
                    pa.array(mark[out]),
                    pa.array(at[out]),
                    pa.array(count[out].astype(np.int32)),
                    pa.array(distance[out].astype(np.int32)),
                    pa.array(np.where(same[out], 0, core[out].view(np.int64))),
                    pa.array(same[out]),
                ],
                names=[c.split()[0] for c in FOUND.split(", ")],
            )

    return dealt.repartition("bucket").mapInArrow(run, FOUND)


def _covered(size: int, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Which bytes lie in windows ``start`` to ``start + count - 1``."""
    edge = np.zeros(size + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + count - 1 + WINDOW, -1)
    return np.cumsum(edge[:-1]) > 0


def _result(text: bytes, gone: np.ndarray) -> tuple[int, int, int, bytes, list[int]]:
    edges = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
    kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
    return len(text), int(gone.sum()), len(edges) // 2, kept, edges.tolist()


POOL = "struct<core: bigint, at: bigint, count: int, distance: int, piece: binary>"
MEET = (
    "doc_id {kind}, ident long, mark long, n_bytes long, n_removed long, n_spans long, "
    "kept_sha256 string, kept binary, spans array<long>, packed binary, starts array<long>, "
    f"counts array<int>, pool array<{POOL}>"
)
MEET_TYPES = [
    *[pa.int64()] * 5, pa.string(), pa.binary(), pa.list_(pa.int64()), pa.binary(),
    pa.list_(pa.int64()), pa.list_(pa.int32()),
    pa.list_(
        pa.struct(
            {"core": pa.int64(), "at": pa.int64(), "count": pa.int32(), "distance": pa.int32(),
             "piece": pa.binary()}
        )
    ),
]
MEET_NAMES = [
    "doc_id", "ident", "mark", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans",
    "packed", "starts", "counts", "pool",
]


def _rows(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(MEET_NAMES)
    types = [kind, *MEET_TYPES]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=MEET_NAMES
    )


def _finished(doc_id, ident, mark, text: bytes, start, count, with_kept: bool) -> tuple:
    n, removed, spans, kept, edges = _result(text, _covered(len(text), start, count))
    digest = hashlib.sha256(kept).hexdigest()
    return (
        doc_id, ident, mark, n, removed, spans, digest, kept if with_kept else None, edges,
        None, None, None, None,
    )


def _packed(docs: DataFrame) -> DataFrame:
    """Texts compressed, as they move twice."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            packed = [zlib.compress(t.as_buffer(), 1) for t in batch["text"].cast(pa.binary())]
            yield batch.set_column(3, "packed", pa.array(packed, pa.binary()))

    docs = docs.select("doc_id", "ident", "mark", "text")
    return docs.mapInArrow(run, f"doc_id {kind}, ident long, mark long, packed binary")


def _meet(docs: DataFrame, found: DataFrame, with_kept: bool) -> DataFrame:
    """Each document with its repeats: finished, or with its text and the pieces for the pool;
    then ``starts`` and ``counts`` keep the windows already known to go."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    runs = found.groupBy("ident", "mark").agg(
        F.collect_list(F.struct("at", "count", "distance", "core", "same")).alias("runs")
    )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            rows, size = [], 0
            names = ("doc_id", "ident", "mark")
            heads = zip(*(batch[c].to_pylist() for c in names), strict=True)
            for k, head in enumerate(heads):
                packed = batch["packed"][k].as_py()
                text = zlib.decompress(packed)
                own = batch["runs"][k].as_py() or []
                gone = [(x["at"], x["count"]) for x in own if x["same"]]
                start = np.array([x[0] for x in gone], np.int64)
                count = np.array([x[1] for x in gone], np.int64)
                if len(gone) == len(own):
                    rows.append(_finished(*head, text, start, count, with_kept))
                else:
                    pool = [
                        {
                            **{c: x[c] for c in ("core", "at", "count", "distance")},
                            "piece": text[x["at"] : x["at"] + x["count"] - 1 + WINDOW],
                        }
                        for x in own
                        if not x["same"]
                    ]
                    rows.append((*head, *[None] * 6, packed, start, count, pool))
                size += len(text)
                if size > batches.PIECE_BYTES:
                    yield _rows(rows, batch["doc_id"].type)
                    rows, size = [], 0
            yield _rows(rows, batch["doc_id"].type)

    joined = _packed(docs).join(runs, ["ident", "mark"], "left")
    return joined.select("doc_id", "ident", "mark", "packed", "runs").mapInArrow(
        run, MEET.format(kind=kind)
    )


def shared_windows(
    pieces: list[bytes], ident: np.ndarray, at: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(piece, window) of each window that also starts earlier in some piece.

    The suffix array of all pieces, with a mark between them, has equal windows side by
    side; neighbours are compared byte by byte.
    """
    none = np.empty(0, np.int64)
    if not pieces:
        return none, none
    sizes = np.array([len(p) for p in pieces])
    text = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8).astype(np.int64) + 2
    ends = np.cumsum(sizes + 1) - 1
    text[ends] = 1
    order = suffix_array(text)
    piece = np.searchsorted(ends, order, "left")
    order, piece = order[order < ends[piece]], piece[order < ends[piece]]
    whole = ends[piece] - order >= WINDOW
    order, piece = order[whole], piece[whole]
    if len(order) < 2:
        return none, none
    views = np.lib.stride_tricks.sliding_window_view(text, WINDOW)
    equal = np.zeros(len(order), bool)
    for i in range(1, len(order), 20_000):
        now = slice(i, min(i + 20_000, len(order)))
        equal[now] = (views[order[now]] == views[order[i - 1 : now.stop - 1]]).all(axis=1)
    group = np.cumsum(~equal)
    offset = order - (ends[piece] - sizes[piece])
    owner, start = ident[piece], at[piece] + offset
    by = np.lexsort((start, owner, group))
    head = np.ones(len(by), bool)
    head[1:] = group[by][1:] != group[by][:-1]
    lead = by[np.maximum.accumulate(np.where(head, np.arange(len(by)), 0))]
    later = (owner[by] != owner[lead]) | (start[by] != start[lead])
    return piece[by][later], offset[by][later]


def _fine(rows: list[tuple]) -> list[tuple[bytes, int, int, int]]:
    """Parts of the pieces whose windows have a finer core that another piece has as well:
    (text, ident, at, mark). Every eight windows by distance from the anchor share a core."""
    pieces = [r[5] for r in rows]
    sizes = np.array([len(p) for p in pieces])
    begin = np.cumsum(sizes) - sizes
    sums = batches.prefix_sums(np.frombuffer(b"".join(pieces), np.uint8))
    count, distance = np.array([r[3] for r in rows]), np.array([r[4] for r in rows])
    owner = np.repeat(np.arange(len(rows)), count)
    window = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    block = (REACH - 1 - distance[owner] + window) // FINE
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (block[1:] != block[:-1])
    owner, block = owner[new], block[new]
    # The last window of the block to the end of the first, as far as the anchor allows.
    low = begin[owner] + block * FINE + FINE - 1 - (REACH - 1) + distance[owner]
    high = begin[owner] + block * FINE - (REACH - 1) + distance[owner] + WINDOW
    low, high = np.maximum(low, begin[owner]), np.minimum(high, begin[owner] + sizes[owner])
    last = (REACH - 1) // FINE
    low = np.where(block == last, begin[owner] + distance[owner], low)
    cores = np.array([r[0] for r in rows], np.int64)[owner]
    # Two keys with one hash would only be compared for nothing.
    key = batches.mix(cores.view(np.uint64) * batches.STEP + block.astype(np.uint64))
    key = batches.mix(key ^ batches.span_hash(sums, low, high))
    _, which, times = np.unique(key, return_inverse=True, return_counts=True)
    kept = times[which] > 1
    out: list[tuple[bytes, int, int, int]] = []
    before = None
    for k, b in zip(owner[kept].tolist(), block[kept].tolist(), strict=True):
        first = max(b * FINE - (REACH - 1) + int(distance[k]), 0)
        stop = min((b + 1) * FINE - (REACH - 1) + int(distance[k]), int(count[k]))
        if before and before[0] == k and before[2] == first:
            before[2] = stop
        else:
            if before:
                out.append(_cut(rows, before))
            before = [k, first, stop]
    if before:
        out.append(_cut(rows, before))
    return out


def _cut(rows: list[tuple], part: list[int]) -> tuple[bytes, int, int, int]:
    k, first, stop = part
    return rows[k][5][first : stop - 1 + WINDOW], rows[k][1], rows[k][2] + first, rows[k][6]


def _pooled(met: DataFrame) -> DataFrame:
    """(ident, mark, at, count): windows of the pool that start earlier elsewhere."""
    pool = met.select("ident", "mark", F.explode("pool").alias("x")).select(
        "x.core", "ident", "x.at", "x.count", "x.distance", "x.piece", "mark"
    )

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        parts = _fine(rows)
        owner = np.array([p[1] for p in parts], np.int64)
        start = np.array([p[2] for p in parts], np.int64)
        mark = np.array([p[3] for p in parts], np.int64)
        piece, window = shared_windows([p[0] for p in parts], owner, start)
        by = np.lexsort((window, piece))
        piece, window = piece[by], window[by]
        new = np.ones(len(by), bool)
        new[1:] = (np.diff(piece) != 0) | (np.diff(window) != 1)
        head = np.flatnonzero(new)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(owner[piece[head]]),
                pa.array(mark[piece[head]]),
                pa.array(start[piece[head]] + window[head]),
                pa.array(np.diff(np.append(head, len(by))).astype(np.int32)),
            ],
            names=["ident", "mark", "at", "count"],
        )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        for batch in parts:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size > POOL_BYTES and row[0] != rows[-1][0]:
                    yield solve(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[5])
        if rows:
            yield solve(rows)

    return (
        pool.repartition("core")
        .sortWithinPartitions("core", "ident", "at", "mark")
        .mapInArrow(run, "ident long, mark long, at long, count int")
    )


def _settled(met: DataFrame, pooled: DataFrame, with_kept: bool) -> DataFrame:
    """The documents that waited for the pool, finished."""
    runs = pooled.groupBy("ident", "mark").agg(
        F.collect_list(F.struct("at", "count")).alias("runs")
    )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            rows = []
            names = ("doc_id", "ident", "mark")
            heads = zip(*(batch[c].to_pylist() for c in names), strict=True)
            for k, head in enumerate(heads):
                own = batch["runs"][k].as_py() or []
                start = batch["starts"][k].as_py() + [x["at"] for x in own]
                count = batch["counts"][k].as_py() + [x["count"] for x in own]
                text = zlib.decompress(batch["packed"][k].as_py())
                now = np.array(start, np.int64), np.array(count, np.int64)
                rows.append(_finished(*head, text, *now, with_kept))
            yield _rows(rows, batch["doc_id"].type)

    waiting = met.where("packed IS NOT NULL").select(
        "doc_id", "ident", "mark", "packed", "starts", "counts"
    )
    kind = met.schema["doc_id"].dataType.simpleString()
    return waiting.join(runs, ["ident", "mark"], "left").mapInArrow(run, MEET.format(kind=kind))


def remove_repeats(docs: DataFrame, with_kept: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept, spans) for each row of (doc_id, text).

    ``spans`` holds where removed runs begin and end, in turn; ``kept`` the bytes that are left
    (null unless asked for).
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = docs.select(
        "doc_id",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("ident"),
        F.xxhash64(text).alias("mark"),
        text.alias("text"),
    )
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = _met(_dealt(docs.select("ident", "mark", "text"), buckets))
    met = materialise(_meet(docs, found, with_kept), "met")
    pooled = materialise(_pooled(met), "pooled")
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"]
    done = met.where("packed IS NULL").select(*columns)
    return done.unionByName(_settled(met, pooled, with_kept).select(*columns))
