"""Fill-in-middle: texts cut in three and put in another order, by one regular expression.

``regexp_count`` gives the number of units of a text, the id decides after how many of them
to cut, and a pattern made for the row takes so many units possessively, ``unit{a}+`` and
``unit{b-a}+``: one match captures prefix, middle and suffix, and its replacement writes them
in the order wanted. Possessive counts never give a unit back, so the match is one pass over
the text without a stack, however long it is.

Defined cases: a null text is empty; an empty text, or one that holds a mark, stays plain. A
null id is hashed as an empty one. Repeated rows each get their row and are cut alike. Only
doc_id and text are read, so other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The unit of cutting, the marks, and the shares out of 100.
UNIT = "[A-Za-z]+|[^A-Za-z]"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARK = f"{PREFIX}|{SUFFIX}|{MIDDLE}"
SEED = "1"
PLAIN_FROM, SPM_BELOW = 90, 20


def _draw(nth: int) -> Column:
    """The nth number that the hash of a row gives."""
    return F.conv(F.substring("hash", 8 * nth + 1, 8), 16, 10).cast("long")


def cut_pattern(first: Column, then: Column) -> Column:
    """A pattern of three groups: ``first`` units, ``then`` units, and all the rest."""
    unit = f"((?:{UNIT})" + "{%d}+)"
    return F.format_string(f"(?s)\\A{unit}{unit}(.*)\\z", first, then)


def fill_in_middle(
    docs: DataFrame, seed: str = SEED, plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW
) -> DataFrame:
    """(doc_id, text) to (doc_id, n, form, output): every text in its form.

    ``plain`` is the text itself, ``psm`` puts the middle last, ``spm`` the suffix before the
    prefix as well. ``n`` counts the units; ``parts`` and ``restore`` read the output.
    """
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumns(
        {
            "n": F.regexp_count("text", F.lit(UNIT)).cast("long"),
            "hash": F.sha2(named.cast("binary"), 256),
            "whole": (F.col("text") == "") | F.col("text").rlike(MARK),
        }
    )
    one, two = _draw(0) % (F.col("n") + 1), _draw(1) % (F.col("n") + 1)
    rows = rows.withColumns(
        {
            "a": F.least(one, two),
            "b": F.greatest(one, two),
            "form": F.when(F.col("whole") | (_draw(2) % 100 >= plain_from), "plain")
            .when(_draw(3) % 100 < spm_below, "spm")
            .otherwise("psm"),
        }
    )
    order = F.when(F.col("form") == "psm", f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2").otherwise(
        f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2"
    )
    pattern = cut_pattern(F.col("a"), F.col("b") - F.col("a"))
    moved = F.regexp_replace("text", pattern, order)
    output = F.when(F.col("form") == "plain", F.col("text")).otherwise(moved)
    return rows.select("doc_id", "n", "form", output.alias("output"))


def parts(output: Column, form: Column) -> Column:
    """(prefix, middle, suffix) of an output; null if it is plain.

    A cut text holds no mark and marks do not overlap, so those in the output are the
    three that were put there.
    """
    piece = F.split(output, MARK, -1)
    psm = F.struct(piece[1].alias("prefix"), piece[3].alias("middle"), piece[2].alias("suffix"))
    spm = F.struct(piece[2].alias("prefix"), piece[3].alias("middle"), piece[1].alias("suffix"))
    return F.when(form == "psm", psm).when(form == "spm", spm)


def restore(output: Column, cut: Column) -> Column:
    """The text again, from an output and its ``parts``."""
    return F.coalesce(F.concat(cut["prefix"], cut["middle"], cut["suffix"]), output)
