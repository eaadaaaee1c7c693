"""Near-duplicate documents by min-max hashing.

A document is the set of its five-word shingles. Under each of 125 permutations both the
smallest and the largest shingle are kept, so one evaluation gives two values whose chance
to agree is the similarity. Five permutations make a band, of smallest and of largest
values: 50 bands. Two documents at the threshold of 0.75 miss each other in all of them
with odds of about one in 700,000. Every link is confirmed on the full sets.

Documents with equal sets are one class before the bands are formed. In a bucket the
document with the fewest shingles of its own (that no other candidate has) is compared
with the others first: in a group of edited copies it is the least edited, and near to
most. Linked documents are then one component, and only documents of different components
are compared further, with more hubs in each round, until every bucket is through. A pair
is left out only if its sizes, the shingles that either has alone, and what both share
with the first hub rule it out: they can share no more of the hub than the one that
shares less of it. What they share outside of the hub is looked up by the shingle: pairs
that no such shingle brings together have to reach the threshold by the hub alone. So a
bucket of near copies costs about a comparison a document, also where many of them just
miss the threshold.

Defined cases: a null text, or one without words, has no shingles and is linked with
nothing. Fewer than five words are one shingle. A row without an id joins the class of
documents with its very set, if there is one. Repeated rows each get their row; rows of one
id with different texts are one document with the links of all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagequarry.llm import batches
from pagequarry.llm.components import components
from pagequarry.scratch import materialise

SHINGLE = 5
SIMILAR = 75  # per cent of the union that two sets must share
ROWS = 5  # permutations of a band
BANDS = 25  # of smallest values, and as many of largest
SEED = 20240229
GROWTH = 16  # times as many hubs in a round as in all before it


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(SEED)
    flips, factors = random.integers(0, 2**63, (2, ROWS * BANDS), dtype=np.uint64)
    return flips, factors * np.uint64(2) + np.uint64(1)


def shingles(
    data: np.ndarray, texts: np.ndarray, length: int = SHINGLE
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and where each text's begin."""
    words = batches.Words(batches.lower(data), texts, batches.TOKEN_BYTES)
    hashes, counts = words.hashes(), words.counts()
    owner, value = [], []
    for size in range(1, length + 1):
        start = batches.inside_texts(words.first, size)
        at = np.searchsorted(words.first, start, "right") - 1
        if size < length:
            whole = counts[at] == size
            start, at = start[whole], at[whole]
        if len(start):
            owner.append(at)
            value.append(batches.sequence_hash(hashes, size)[start] ^ np.uint64(size))
    size = len(texts) - 1
    if not owner:
        return np.empty(0, np.uint64), np.zeros(size + 1, np.int64)
    at, value = np.concatenate(owner), np.concatenate(value)
    order = np.lexsort((value, at))
    at, value = at[order], value[order]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (value[1:] != value[:-1])
    at, value = at[new], value[new]
    return value, np.searchsorted(at, np.arange(size + 1))


def signature(value: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(two numbers that tell a set from others, keys of the bands) of non-empty sets."""
    flips, factors = _permutations()
    bands = np.zeros((2 * BANDS, len(first)), np.uint64)
    for k, (flip, factor) in enumerate(zip(flips, factors, strict=True)):
        moved = (value ^ flip) * factor
        moved ^= moved >> np.uint64(29)
        moved *= factor
        for which, best in ((0, np.minimum.reduceat(moved, first)), (1, np.maximum.reduceat(moved, first))):
            band = bands[which * BANDS + k // ROWS]
            band *= batches.STEP
            band += batches.mix(best)
    names = np.arange(1, 2 * BANDS + 1, dtype=np.uint64)[:, None]
    spread = batches.mix(value)
    digest = np.stack(
        [np.add.reduceat(spread, first), np.bitwise_xor.reduceat(batches.mix(spread), first)]
    )
    return digest, batches.mix(bands + names * batches.STEP).T


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, digest_a, digest_b, bands) of (doc_id, text)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for first, last, data, texts in batches.pieces(batch):
                value, starts = shingles(data, texts)
                size = np.diff(starts)
                some = size > 0
                digest = np.zeros((2, len(size)), np.uint64)
                bands = np.zeros((len(size), 2 * BANDS), np.uint64)
                if some.any():
                    digest[:, some], bands[some] = signature(value, starts[:-1][some])
                flat = pa.array(bands[some].reshape(-1).view(np.int64))
                ends = np.concatenate([[0], np.cumsum(some * 2 * BANDS)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(first, last - first),
                        pa.array(size.astype(np.int64)),
                        pa.array(digest[0].view(np.int64)),
                        pa.array(digest[1].view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(ends), flat),
                    ],
                    names=["doc_id", "n_shingles", "digest_a", "digest_b", "bands"],
                )

    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(
        run,
        f"doc_id {kind}, n_shingles long, digest_a long, digest_b long, bands array<long>",
    )


def shingle_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, shingles) of (doc_id, text)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for first, last, data, texts in batches.pieces(batch):
                value, starts = shingles(data, texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(first, last - first),
                        pa.ListArray.from_arrays(
                            pa.array(starts.astype(np.int32)), pa.array(value.view(np.int64))
                        ),
                    ],
                    names=["doc_id", "shingles"],
                )

    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, shingles array<long>")


def _measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, shared, linked, rest) of (a, b), a the hub: the full sets compared. ``rest`` is
    what b has besides the hub."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b"))
    union = F.size("set_a") + F.size("set_b") - F.col("shared")
    return (
        pairs.join(right, "b")
        .join(left, "a")
        .withColumn("shared", F.size(F.array_intersect("set_a", "set_b")))
        .select(
            "a",
            "b",
            "shared",
            (100 * F.col("shared") >= SIMILAR * union).alias("linked"),
            F.array_except("set_b", "set_a").alias("rest"),
        )
    )


def _buckets(signed: DataFrame, classes: DataFrame) -> DataFrame:
    """(key, id, n): the classes in every band bucket that holds more than one."""
    first = signed.join(
        classes.select(F.col("rep").alias("doc_id"), "digest_a", "digest_b", "n_shingles"),
        ["doc_id", "digest_a", "digest_b", "n_shingles"],
        "left_semi",
    )
    rows = first.select(
        F.explode("bands").alias("key"), F.col("doc_id").alias("id"), F.col("n_shingles").alias("n")
    )
    shared = (
        rows.groupBy("key")
        .agg(F.min("id").alias("low"), F.max("id").alias("high"))
        .where("low < high")
        .select("key")
    )
    return rows.join(shared, "key").distinct()


def _ranked(member: DataFrame, sets: DataFrame) -> DataFrame:
    """``member`` with ``may``, the most shingles that a document may share with any other
    candidate, and its rank in the bucket: those with few shingles of their own first.
    ``single`` tells whether the id stands for one set."""
    alone = (
        sets.select(F.col("doc_id").alias("id"), F.explode("shingles").alias("s"))
        .groupBy("s")
        .agg(F.min("id").alias("id"), F.max("id").alias("high"))
        .where("id = high")
        .groupBy("id")
        .agg(F.count("*").alias("own"))
    )
    # An id with several rows may stand for several sets: nothing is known to be its own.
    sizes = sets.groupBy(F.col("doc_id").alias("id")).agg((F.count("*") == 1).alias("single"))
    own = F.when(F.col("single"), F.coalesce("own", F.lit(0))).otherwise(0)
    within = Window.partitionBy("key").orderBy(own, "id", "n")
    return (
        member.join(alone, "id", "left")
        .join(sizes, "id")
        .withColumn("rank", F.row_number().over(within))
        .select("key", "id", "n", (F.col("n") - own).alias("may"), "rank", "single")
    )


def _with_hub(rows: DataFrame, measured: DataFrame) -> DataFrame:
    """``rows`` with ``core``: how much each shares with the first hub of its bucket, null if
    it was not compared with it, and that hub as ``first``."""
    hub = rows.where("rank = 1").select("key", F.col("id").alias("a"), F.col("single").alias("one"))
    shared = measured.select("a", F.col("b").alias("id"), "shared").dropDuplicates(["a", "id"])
    core = F.when(F.col("rank") == 1, F.col("n")).otherwise(F.col("shared"))
    return (
        rows.join(hub, "key")
        .join(shared, ["a", "id"], "left")
        .withColumn("core", F.when(F.col("single") & F.col("one"), core))
        .select(*rows.columns, "core", F.col("a").alias("first"))
    )


def _outside(measured: DataFrame) -> DataFrame:
    """(first, s, id): the shingles besides the hub ``first`` that several of the documents
    compared with it have."""
    rest = measured.select(
        F.col("a").alias("first"), F.explode("rest").alias("s"), F.col("b").alias("id")
    )
    several = (
        rest.groupBy("first", "s")
        .agg(F.min("id").alias("low"), F.max("id").alias("high"))
        .where("low < high")
        .select("first", "s")
    )
    return rest.join(several, ["first", "s"]).distinct()


def _enough(shared: Column) -> Column:
    """Whether two documents that share so much are similar enough."""
    return 100 * shared >= SIMILAR * (F.col("n") + F.col("hub_n") - shared)


def _by_hub() -> Column:
    """Whether both documents were compared with the first hub of the bucket."""
    return F.col("core").isNotNull() & F.col("hub_core").isNotNull()


def _possible() -> Column:
    """Whether two documents that share nothing outside of the first hub may be similar
    enough: of the hub they share at most the lesser of their shares of it. Where that is not
    known, it is the lesser of what others may have as well."""
    shared = F.when(_by_hub(), F.least("core", "hub_core")).otherwise(F.least("may", "hub_may"))
    return _enough(shared)


def _possible_outside() -> Column:
    """The same of two documents that share something outside of the first hub: at most the
    lesser of what others may have of it as well."""
    outside = F.least(F.col("may") - F.col("core"), F.col("hub_may") - F.col("hub_core"))
    shared = F.least("may", "hub_may", F.least("core", "hub_core") + outside)
    return _by_hub() & _enough(shared)


def _against(left: DataFrame, low: int, high: int, on: list[str], possible: Column) -> DataFrame:
    """(a, b): documents of ``left`` and the hubs of this round, ranked before them, that
    meet in ``on``, belong to different components and may be similar enough."""
    hub = left.where((F.col("rank") >= low) & (F.col("rank") < high)).select(
        *on,
        F.col("id").alias("a"),
        F.col("n").alias("hub_n"),
        F.col("may").alias("hub_may"),
        F.col("core").alias("hub_core"),
        F.col("rank").alias("hub_rank"),
        F.col("label").alias("hub_label"),
    )
    return (
        left.join(hub, on)
        .where("rank > hub_rank AND label <> hub_label AND id <> a")
        .where(possible)
        .select("a", F.col("id").alias("b"))
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of (doc_id, text)."""
    signed = materialise(signatures(docs), "signatures")
    same_set = ["digest_a", "digest_b", "n_shingles"]
    classes = (
        signed.where("n_shingles > 0").groupBy(*same_set).agg(F.min("doc_id").alias("rep"))
    )
    member = materialise(_buckets(signed, classes), "buckets")
    ids = member.select(F.col("id").alias("doc_id")).distinct()
    sets = materialise(
        shingle_sets(docs.select("doc_id", "text").join(ids, "doc_id", "left_semi")), "sets"
    )
    rows = materialise(_ranked(member, sets), "ranked")
    rows = rows.withColumn("core", F.lit(None).cast("long"))
    labelled = rows.withColumn("label", F.col("id"))
    links, tested, roots, outside = None, None, None, None
    low, high = 1, 2
    while True:
        # Buckets that still hold more than one component and documents not yet hubs.
        open_keys = (
            labelled.groupBy("key")
            .agg(F.min("label").alias("a"), F.max("label").alias("b"), F.max("rank").alias("r"))
            .where((F.col("a") < F.col("b")) & (F.col("r") > low))
            .select("key")
        )
        left = labelled.join(open_keys, "key", "left_semi")
        pairs = _against(left, low, high, ["key"], _possible())
        if outside is not None:
            wide = left.where("core IS NOT NULL").join(outside, ["first", "id"])
            pairs = pairs.unionByName(
                _against(wide, low, high, ["key", "s"], _possible_outside())
            )
        pairs = pairs.distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = materialise(pairs, "pairs")
        if not pairs.isEmpty():
            measured = _measured(pairs, sets)
            measured = materialise(measured if low == 1 else measured.drop("rest"), "measured")
            found = measured.where("linked").select("a", "b").distinct()
            if low == 1:
                rows = materialise(_with_hub(rows.drop("core"), measured), "ranked")
                outside = materialise(_outside(measured), "outside")
                labelled = rows.withColumn("label", F.col("id"))
            links = found if links is None else links.unionByName(found)
            tested = pairs if tested is None else tested.unionByName(pairs)
            if not found.isEmpty():
                roots = materialise(components(links), "components")
                labelled = materialise(
                    rows.join(roots, "id", "left").withColumn("label", F.coalesce("root", "id")),
                    "labelled",
                )
        low, high = high, high * GROWTH
        last = labelled.agg(F.max("rank")).first()[0]
        if last is None or last <= low:
            break
    base = signed.select("doc_id", *same_set).join(classes, same_set, "left")
    if roots is None:
        base = base.withColumn("root", F.lit(None).cast(base.schema["rep"].dataType))
    else:
        base = base.join(roots.withColumnRenamed("id", "rep"), "rep", "left")
    component = F.coalesce("root", "rep", "doc_id")
    return base.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )
