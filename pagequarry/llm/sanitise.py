"""Personal data and the words that give it away, found with built-in expressions only.

Fixed kinds (email, ip, card, phone) are found by patterns. Then an estimate from the
corpus tells how strongly a word discloses such an entity: the document is the context, and
a word whose pointwise mutual information with a target comes close to the target's own
information content (``share`` of it) is a disclosure, if at least ``support`` documents
show the two together. The targets of an entity are its value and what recurs where values
do not: its kind, and its domain or block of numbers. Disclosing words are further spans in
every document, with an entity or without; in sanitised text entities become their kind and
disclosing words a mark.

Defined cases: a null or empty text has no spans. Repeated rows each get their row and
count as documents. Words inside entities are not counted. Other columns may have any name. All positions are code points, the
end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.scratch import materialise

SUPPORT = 3
SHARE = 0.8
BITS = 1 << 16  # numbers of 64 bits in a filter of hashes
PARTS = 64  # that a target is copied to, as frequent ones meet many words
KINDS = ("email", "ip", "card", "phone")
TERM = "term"

# What the kinds look like. Where a run of letters of the pattern cannot
# begin a match, no later place in the run can: so a match begins where its run does (or
# where the match before it ended), and long runs are read once.
_LOCAL, _HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
HINT = {"email": "@", "ip": ".", "card": None, "phone": "+"}
PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
WORD = r"[\p{L}\p{N}]+"


def quoted(pattern: str) -> str:
    return "r'" + pattern.replace("'", "\\'") + "'"


def matches(text: str, pattern: str) -> str:
    """SQL for array<struct<s, e, v>>: where a pattern occurs in ``text``, and what is there.

    The text between two matches, from splitting by the pattern, tells how far apart they are.
    """
    found = f"regexp_extract_all({text}, {quoted(pattern)}, 0)"
    gaps = f"split({text}, {quoted(pattern)}, -1)"
    return f"""aggregate(
      zip_with({found}, {gaps}, (v, g) -> struct(length(g) AS g, v)),
      struct(0 AS at, cast(array() AS array<struct<s: int, e: int, v: string>>) AS a),
      (acc, x) -> if(x.v IS NULL, acc, struct(acc.at + x.g + length(x.v) AS at,
        concat(acc.a, array(struct(acc.at + x.g AS s, acc.at + x.g + length(x.v) AS e, x.v AS v))) AS a)),
      acc -> acc.a)"""


def _luhn(value: str) -> str:
    """SQL: whether the digits of ``value`` pass the check sum of card numbers."""
    digits = f"reverse(translate({value}, ' -', ''))"
    return f"""aggregate(split({digits}, ''), struct(0 AS n, 0 AS sum), (acc, d) -> if(d = '', acc,
        struct(acc.n + 1 AS n, acc.sum + if(acc.n % 2 = 0, int(d),
          if(int(d) > 4, 2 * int(d) - 9, 2 * int(d))) AS sum)), acc -> acc.sum % 10 = 0)"""


VALID = {
    "email": "true",
    "ip": f"x.v RLIKE {quoted(rf'^{PART}(?:\.{PART}){{3}}$')}",
    "card": _luhn("x.v"),
    "phone": "length(regexp_replace(x.v, '[^0-9]', '')) BETWEEN 9 AND 15",
}
EMPTY = "cast(array() AS array<struct<s: int, e: int, v: string>>)"


def entities(text: str, kind: str) -> str:
    """SQL for the valid occurrences of a kind, leftmost first, none overlapping."""
    found = f"filter({matches(text, PATTERNS[kind])}, x -> {VALID[kind]})"
    hint = HINT[kind]
    maybe = f"contains({text}, '{hint}')" if hint else f"{text} RLIKE '[0-9]{{2}}|[0-9][ -][0-9]'"
    return f"if({maybe}, {found}, {EMPTY})"


def _outside(text: str) -> str:
    """SQL for ``text`` with entities blanked; all else keeps its place."""
    spans = "array_sort(transform(found, x -> struct(x.s AS s, x.e AS e)))"
    return f"""if(size(found) = 0, {text}, aggregate({spans},
        struct(0 AS at, cast(array() AS array<string>) AS out),
        (acc, x) -> struct(greatest(acc.at, x.e) AS at, concat(acc.out, array(
          if(x.s > acc.at, substring({text}, acc.at + 1, x.s - acc.at), ''),
          repeat(' ', greatest(x.e - greatest(acc.at, x.s), 0)))) AS out),
        acc -> concat(array_join(acc.out, ''), substring({text}, acc.at + 1))))"""


def _words(text: str) -> str:
    """SQL for the distinct lower-case words of ``text``."""
    found = f"array_distinct(regexp_extract_all({text}, {quoted(WORD)}, 0))"
    return f"array_distinct(transform({found}, w -> lower(w)))"


def _targets() -> str:
    """SQL for what the words of a document may disclose: of each entity in ``found`` the kind,
    the domain or block of numbers, and the value."""
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    block = """CASE x.k WHEN 0 THEN substring_index(x.v, '@', -1) WHEN 1 THEN substring_index(x.v, '.', 3)
        WHEN 2 THEN left(x.v, 6) ELSE left(x.v, length(x.v) - 4) END"""
    return f"""array_distinct(flatten(transform(found, x -> array({names}[x.k],
        concat({names}[x.k], '~', {block}), concat({names}[x.k], '=', x.v)))))"""


def _bits(values: DataFrame) -> DataFrame:
    """One row: a filter of the hashes of ``values`` (value), of a size that is always the same."""
    hashed = values.select(F.xxhash64("value").alias("h"))
    filled = hashed.groupBy(F.expr(f"pmod(shiftright(h, 6), {BITS})").alias("k")).agg(
        F.expr("bit_or(shiftleft(1L, cast(h & 63 AS int)))").alias("b")
    )
    return (
        values.sparkSession.range(BITS)
        .select(F.col("id").alias("k"))
        .join(filled, "k", "left")
        .agg(F.array_sort(F.collect_list(F.struct("k", F.coalesce("b", F.lit(0)).alias("b")))).alias("all"))
        .select(F.col("all.b").alias("bits"))
    )


def _maybe(value: str) -> str:
    """SQL: whether ``value`` may be among those of ``bits``; none of them is missed."""
    h = f"xxhash64({value})"
    number = f"bits[cast(pmod(shiftright({h}, 6), {BITS}) AS int)]"
    return f"(shiftright({number}, cast({h} & 63 AS int)) & 1) = 1"


def _as_strings(kind: str, spans: str) -> str:
    return f"transform({spans}, x -> concat('{kind}:', x.s, ':', x.e))"


def detect(docs: DataFrame) -> DataFrame:
    """(row, key, found): each row with its entities, array<struct<k, s, e, v>> with kinds by
    number. Written once, as both the counts and the result are taken from it.
    """
    named = docs.select(F.struct("*").alias("row")).withColumn(
        "body", F.coalesce(F.col("row.text"), F.lit(""))
    )
    for kind in KINDS:
        named = named.withColumn(f"of_{kind}", F.expr(entities("body", kind)))
    tagged = ", ".join(
        f"transform(of_{k}, x -> struct({i} AS k, x.s AS s, x.e AS e, "
        + ("lower(x.v)" if k in ("email", "ip") else "regexp_replace(x.v, '[^0-9]', '')")
        + " AS v))"
        for i, k in enumerate(KINDS)
    )
    return (
        named.withColumn("found", F.expr(f"concat({tagged})"))
        .withColumn("key", F.monotonically_increasing_id())
        .drop("body", *[f"of_{k}" for k in KINDS])
    )


def _listed(detected: DataFrame) -> DataFrame:
    """(key, found, words): the distinct words of each row outside of entities."""
    body = _outside("coalesce(row.text, '')")
    return detected.selectExpr("key", "found", f"{body} AS body").selectExpr(
        "key", "found", f"{_words('body')} AS words"
    )


def disclosures(
    detected: DataFrame, support: int = SUPPORT, share: float = SHARE
) -> DataFrame:
    """(target, word, information): words that disclose a target.

    With N documents, n(t) with the target, n(w) with the word and n(t, w) with both:
    log2(N n(t, w) / (n(t) n(w))) is compared with log2(N / n(t)). Targets in fewer than
    ``support`` documents are left out before words are put beside them.
    """
    total = detected.count()
    some = detected.where("size(found) > 0")
    target = materialise(
        some.select(F.explode(F.expr(_targets())).alias("target"))
        .groupBy("target")
        .agg(F.count("*").alias("n_target"))
        .where(F.col("n_target") >= support),
        "targets",
    )
    bits = materialise(_bits(target.select(F.col("target").alias("value"))), "target_bits")
    pair = (
        _listed(some)
        .withColumn("bits", bits.scalar())
        .selectExpr("words", f"filter({_targets()}, t -> {_maybe('t')}) AS targets")
        .select("words", F.explode("targets").alias("target"))
        .select("target", F.explode("words").alias("word"))
        .groupBy("target", "word")
        .agg(F.count("*").alias("n_pair"))
        .where(F.col("n_pair") >= support)
        .withColumn("part", F.pmod(F.xxhash64("word"), F.lit(PARTS)))
    )
    copies = target.withColumn("part", F.expr(f"explode(sequence(0L, {PARTS - 1}L))"))
    counts = (
        _listed(detected)
        .select(F.explode("words").alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("n_word"))
    )
    content = F.log2(F.lit(float(total)) / F.col("n_target"))
    shared = F.log2(F.lit(float(total)) * F.col("n_pair") / F.col("n_target") / F.col("n_word"))
    return (
        pair.join(copies, ["target", "part"])
        .join(counts, "word")
        .withColumn("information", shared)
        .where((F.col("information") > 0) & (F.col("information") >= share * content))
        .select("target", "word", "information")
    )


def find(docs: DataFrame, support: int = SUPPORT, share: float = SHARE) -> DataFrame:
    """(row, found, terms): each row of ``docs`` with its entities and disclosing words."""
    detected = materialise(detect(docs), "detected")
    words = materialise(disclosures(detected, support, share).select("word").distinct(), "words")
    bits = materialise(_bits(words.select(F.col("word").alias("value"))), "word_bits")
    # A word is marked wherever it occurs; the filter keeps most words out of the join.
    giving = (
        _listed(detected)
        .withColumn("bits", bits.scalar())
        .selectExpr("key", f"explode(filter(words, w -> {_maybe('w')})) AS word")
        .join(words, "word")
        .groupBy("key")
        .agg(F.collect_list("word").alias("giving"))
    )
    body = _outside("coalesce(row.text, '')")
    none = "cast(array() AS array<struct<s: int, e: int>>)"
    gaps, every = f"split(body, {quoted(WORD)}, -1)", f"regexp_extract_all(body, {quoted(WORD)}, 0)"
    terms = f"""if(giving IS NULL, {none}, aggregate(zip_with({every}, {gaps}, (v, g) -> struct(v, length(g) AS g)),
        struct(0 AS at, {none} AS a), (acc, x) -> if(x.v IS NULL, acc, struct(
          acc.at + x.g + length(x.v) AS at,
          if(array_contains(giving, lower(x.v)), concat(acc.a, array(struct(
            acc.at + x.g AS s, acc.at + x.g + length(x.v) AS e))), acc.a) AS a)), acc -> acc.a))"""
    return (
        detected.join(giving, "key", "left")
        .selectExpr("row", "found", "giving", f"if(giving IS NULL, '', {body}) AS body")
        .selectExpr("row", "found", f"{terms} AS terms")
    )


def count_of(kind: str) -> Column:
    return F.expr(f"size(filter(found, x -> x.k = {KINDS.index(kind)}))").cast("long")


def span_strings() -> tuple[Column, Column]:
    """(base spans, all spans) of a row as kind:start:end, joined by commas."""
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    base = f"transform(found, x -> concat({names}[x.k], ':', x.s, ':', x.e))"
    terms = _as_strings(TERM, "terms")
    return F.expr(f"array_join({base}, ',')"), F.expr(f"array_join(concat({base}, {terms}), ',')")


def sanitise(docs: DataFrame, support: int = SUPPORT, share: float = SHARE) -> DataFrame:
    """The rows of ``docs`` with entities in ``text`` replaced by their kind and disclosing
    words by a mark; ``n_chars``, if there, is counted again. Overlapping spans become one
    mark."""
    marks = "array(" + ", ".join(f"'[{k.upper()}]'" for k in (*KINDS, TERM)) + ")"
    spans = f"""array_sort(concat(transform(found, x -> struct(x.s AS s, x.e AS e, x.k AS k)),
        transform(terms, x -> struct(x.s AS s, x.e AS e, {len(KINDS)} AS k))))"""
    text = f"""aggregate({spans}, struct(0 AS at, cast(array() AS array<string>) AS out),
        (acc, x) -> if(x.s >= acc.at,
          struct(x.e AS at, concat(acc.out, array(substring(row.text, acc.at + 1, x.s - acc.at),
            {marks}[x.k])) AS out),
          struct(greatest(acc.at, x.e) AS at, acc.out AS out)),
        acc -> concat(array_join(acc.out, ''), substring(row.text, acc.at + 1)))"""
    out = find(docs, support, share).withColumn(
        "clean", F.expr(f"if(size(found) + size(terms) > 0, {text}, row.text)")
    )
    new = {"text": F.col("clean"), "n_chars": F.length("clean").cast("long")}
    return out.select(
        *[new[c].alias(c) if c in new else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    )
