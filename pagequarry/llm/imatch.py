"""I-Match fingerprints over randomised lexicons, with built-in expressions only.

The lexicon holds the terms whose document frequency lies in a band: terms of nearly every
document say nothing, rare ones change with any edit. Copies of one text, exact or near,
are one document where frequent terms are left out, else a large group of them would have no
term of its own in the lexicon: texts are counted by their shapes, the smallest hashes of
their terms, as soon as a shape is that of more than one in ``GROUPS`` rows. Since a term must occur in a fixed
share of all documents, the lexicon has at most (mean distinct terms of a document) / share
entries however large the corpus is. It is cut into random subsets of several sizes; the
distinct terms of a text that lie in a subset, sorted, are hashed. The fingerprint lists
these hashes; the likeness of two fingerprints is the share of equal ones among the subsets
in which either text has a term.

Defined cases: a null or empty text, or one without a term of the lexicon, has a
fingerprint of empty places; two of these have likeness 1 if their texts are equal, else 0.
Rows of one id and text are one document in the order of documents; rows of one id with
different texts follow each other in the order of their hashes, null ids come last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.operators.ids import with_dense_ids
from pagequarry.scratch import materialise

LEAST_SHARE, MOST_SHARE = 0.0005, 0.2  # document frequencies of the lexicon
LEAST_DOCUMENTS = 2
# Shapes of a text, hashes in one, and the least; at most GROUPS of a kind are weighed.
SHAPES, SMALLEST, FEWEST, GROUPS = 4, 5, 3, 128
UNIT = 1 << 30  # the weight of a document, in whole numbers
SHARDS = 1 << 16
# (subsets, one in so many terms): small subsets see few terms and bear many edits.
SUBSETS = ((4, 8), (8, 64), (12, 512))
TERMS = r"[^\p{L}\p{N}]+"


def terms(text: str) -> Column:
    """Distinct lower-case words."""
    return F.array_distinct(F.split(F.lower(text), TERMS, -1))


def _shaped(texts: DataFrame) -> DataFrame:
    """(terms, shapes) of (text). Each shape looks at terms of its own; near copies are likely
    to have one in common. A text with too few terms for a shape has the set of them instead."""
    hashes = "array_sort(transform(terms, t -> xxhash64(t))) AS hs"
    parts = [f"filter(hs, h -> (h & {SHAPES - 1}) = {k}) AS p{k}" for k in range(SHAPES)]
    shapes = ", ".join(
        f"xxhash64({k}, if(size(p{k}) < {FEWEST}, hs, slice(p{k}, 1, {SMALLEST})))"
        for k in range(SHAPES)
    )
    return (
        texts.select(F.filter(terms("text"), lambda t: t != "").alias("terms"))
        .selectExpr("terms", hashes)
        .selectExpr("terms", "hs", *parts)
        .selectExpr("terms", f"array({shapes}) AS shapes")
    )


def lexicon(
    texts: DataFrame,
    least: float = LEAST_SHARE,
    most: float = MOST_SHARE,
    documents: int = LEAST_DOCUMENTS,
) -> DataFrame:
    """(term) of the band, counted over all documents (text), before the shuffle and after.

    A term must be in the least share of rows, and in no more than the most of documents when
    the rows of each large group of copies weigh as much as one.
    """
    shaped = _shaped(texts)
    shapes = materialise(shaped.select("shapes"), "shapes")
    total = shapes.count()
    large = (
        shapes.select(F.explode("shapes").alias("shape"))
        .groupBy("shape")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= max(2, total / GROUPS))
    )
    # One row of at most SHAPES * GROUPS numbers.
    sizes = materialise(
        large.agg(F.map_from_entries(F.collect_list(F.struct("shape", "n"))).alias("sizes")), "sizes"
    )
    weight = f"{UNIT} div array_max(transform(shapes, s -> coalesce(sizes[s], 1L))) AS weight"
    weighed = shapes.withColumn("sizes", sizes.scalar()).selectExpr(weight)
    whole = weighed.agg(F.sum("weight").alias("w")).first()["w"] or 0
    found = (
        shaped.withColumn("sizes", sizes.scalar())
        .selectExpr("terms", weight)
        .select(F.explode("terms").alias("term"), "weight")
        .groupBy("term")
        .agg(F.count("*").alias("n"), F.sum("weight").alias("w"))
    )
    low, high = max(documents, least * total), max(documents * UNIT, most * whole)
    return found.where((F.col("n") >= low) & (F.col("w") <= high)).select("term")


def _sharded(words: DataFrame) -> DataFrame:
    """One row: the hashes of the lexicon's terms, sorted into shards by hash."""
    hashed = words.select(F.xxhash64("term").alias("h")).distinct()
    shard = hashed.groupBy(F.pmod("h", F.lit(SHARDS)).alias("k")).agg(F.collect_list("h").alias("hs"))
    places = hashed.sparkSession.range(SHARDS).select(F.col("id").alias("k"))
    # One row of at most (mean terms of a document / least share) numbers.
    return (
        places.join(shard, "k", "left")
        .agg(F.array_sort(F.collect_list(F.struct("k", "hs"))).alias("all"))
        .select(F.expr("transform(all, x -> coalesce(x.hs, cast(array() AS array<bigint>)))").alias("shards"))
    )


def in_lexicon(text: str, shards: str) -> str:
    """SQL for the sorted hashes of a text's terms that lie in the lexicon."""
    words = f"array_distinct(split(lower({text}), r'{TERMS}', -1))"
    hashes = f"transform({words}, t -> xxhash64(t))"
    return (
        f"array_sort(filter({hashes}, h -> array_contains("
        f"{shards}[cast(pmod(h, {SHARDS}) AS int)], h)))"
    )


def fingerprint(hashes: str) -> str:
    """SQL for array<bigint>: for each subset a hash, or null where the text has no term of it.

    Which terms a subset holds depends on other bits of the term's hash than its shard.
    """
    subsets, bit = [], 16  # the low bits choose the shard
    for count, one_in in SUBSETS:
        for k in range(count):
            own = f"(shiftrightunsigned(h, {bit}) & {one_in - 1}) = {k}"
            subsets.append(f"filter({hashes}, h -> {own})")
        bit += one_in.bit_length() - 1
    whole = f"array({hashes}, {', '.join(subsets)})"
    return f"transform({whole}, s -> if(size(s) = 0, NULL, xxhash64(s)))"


def as_text(prints: str) -> str:
    """SQL for a fingerprint as one string."""
    return f"array_join(transform({prints}, x -> coalesce(hex(x), '')), '-')"


def likeness(a: str, b: str) -> str:
    """SQL for the share of equal hashes among the places not empty in both, null if there are none."""
    both = f"zip_with({a}, {b}, (x, y) -> struct(x, y))"
    return f"""aggregate({both}, struct(0 AS same, 0 AS n), (acc, p) -> if(p.x IS NULL AND p.y IS NULL, acc,
        struct(acc.same + int(p.x <=> p.y) AS same, acc.n + 1 AS n)),
        acc -> if(acc.n = 0, NULL, acc.same / acc.n))"""


def neighbours(docs: DataFrame) -> DataFrame:
    """(key, next_key, need): for each distinct document the one after it by falling id, from
    the last back to the first, and how many code points its edit takes from it.

    Only keys and lengths are sorted, in a range shuffle; there is no window over all rows.
    """
    keys = docs.select("doc_id", "key", F.length("body").alias("n")).distinct()
    order = keys.withColumns(
        {
            "last": F.col("doc_id").isNull(),
            "falling": -F.coalesce(F.col("doc_id"), F.lit(0)).cast("long"),
        }
    )
    ranked = materialise(with_dense_ids(order, ["last", "falling", "key"], "rank"), "order")
    total = ranked.count()
    after = ranked.select(
        F.when(F.col("rank") == 1, F.lit(total)).otherwise(F.col("rank") - 1).alias("rank"),
        F.col("key").alias("next_key"),
    )
    return ranked.join(after, "rank").select(
        "key", "next_key", F.floor(F.col("n") / 3).cast("int").alias("need")
    )


def fingerprints(docs: DataFrame, words: DataFrame | None = None) -> DataFrame:
    """Each row of (doc_id, text) with its fingerprint, that of its edited text and the next
    document's: (doc_id, body, edited, print, edited_print, next_id, next_print, next_body_md5).

    The edit replaces the last third of a text by the beginning of the next document. That
    document's row sends as much of its text as is needed, and its fingerprint, to the row
    before it. Both sides of that join begin with one exchange, which Spark writes once
    as both use the same columns. The lexicon reaches the expressions as one value of
    bounded size.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("body"))
    number = F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    docs = docs.withColumn("key", F.md5(F.concat_ws("|", number, "body")))
    words = lexicon(docs.select(F.col("body").alias("text"))) if words is None else words
    shards = materialise(_sharded(words), "lexicon")
    links = materialise(neighbours(docs), "neighbours")
    # The one row of the lexicon is a scalar subquery; as no other column is computed beside
    # it, the optimizer puts it into the expressions, and no row carries it.
    printed = (
        docs.withColumn("shards", shards.scalar())
        .selectExpr("doc_id", "body", "key", f"{in_lexicon('body', 'shards')} AS hashes")
        .selectExpr("doc_id", "body", "key", f"{fingerprint('hashes')} AS print")
    )
    before = links.select(
        F.col("next_key").alias("key"),
        F.col("key").alias("to_key"),
        F.col("need").alias("head_size"),
    )
    sent = (
        printed.join(before, "key")
        .select(
            F.col("to_key").alias("key"),
            F.col("doc_id").alias("next_id"),
            F.expr("substring(body, 1, head_size)").alias("head"),
            F.col("print").alias("next_print"),
            F.md5("body").alias("next_body_md5"),
        )
        .dropDuplicates(["key"])
    )
    met = printed.join(sent, "key")
    need = "cast(floor(length(body) / 3) AS int)"
    edited = f"concat(substring(body, 1, length(body) - {need}), head)"
    kept = ["doc_id", "body", "print", "next_id", "next_print", "next_body_md5"]
    return (
        met.withColumn("shards", shards.scalar())
        .selectExpr(*kept, f"{edited} AS edited", f"{in_lexicon(edited, 'shards')} AS hashes")
        .selectExpr(*kept, "edited", f"{fingerprint('hashes')} AS edited_print")
    )
