"""Text expressions."""

from __future__ import annotations

import json
import re
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# The separators of words, spelled out because the meaning of \s
# differs between regular-expression engines.
SPACES = " \t\r\n"
WORD_BREAK = f"[{SPACES}]+"

# The names of HTML character references, from the standard library.
NAMED = {name[:-1]: char for name, char in html5.items() if name.endswith(";")}

_WORD = re.compile(f"[^{SPACES}]+")

# Fixed value: the reply to a blank question.
EMPTY_QUESTION = "ERROR the question should not be empty"


def words(text: Column) -> Column:
    """Non-empty whitespace-separated words."""
    return F.filter(F.split(text, WORD_BREAK), lambda w: w != "")


def split_words(text: str) -> list[str]:
    """The same words in a Python worker."""
    return _WORD.findall(text)


def token_count(text: Column) -> Column:
    return F.size(words(text))


def clean_section(text: Column, newline: str = "") -> Column:
    """Replace each newline by ``newline``, then drop at most one space before each dot."""
    return F.regexp_replace(F.replace(text, F.lit("\n"), F.lit(newline)), " ?\\.", ".")


def join_sections(sections: Column, newline: str = "") -> Column:
    """Cleaned sections of one document, one per line."""
    return F.array_join(F.transform(sections, lambda s: clean_section(s, newline)), "\n")


def is_blank(text: Column) -> Column:
    """True for text made only of Unicode white space.

    ``trim`` would not do: it knows U+0020 only.
    """
    return text.rlike(r"(?U)\A[\s\x1c-\x1f]*\z")


def guarded(question: Column, otherwise: Column) -> Column:
    """The fixed error text for a blank question, else ``otherwise``."""
    return F.when(is_blank(question), F.lit(EMPTY_QUESTION)).otherwise(otherwise)


def basename(url: Column) -> Column:
    """Last segment of a path or URL."""
    return F.substring_index(url, "/", -1)


def split_items(answer: Column) -> Column:
    """Pieces between blank lines; empty pieces are kept."""
    return F.split(answer, "\n\n")


def decode_text(content: Column, charset: str = "UTF-8") -> Column:
    """Bytes as text. Malformed UTF-8 becomes U+FFFD: one bad page must not end a job."""
    if charset.upper() == "UTF-8":
        return F.make_valid_utf8(content.cast("string"))
    return F.decode(content, charset)


def character(number: Column) -> Column:
    """The character of a code point; U+FFFD for numbers that are none."""
    valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
    code = F.lpad(F.hex(F.when(valid, number).otherwise(0xFFFD)), 8, "0")
    return F.decode(F.unhex(code), "UTF-32")


def unescape(text: Column) -> Column:
    """Character references, named and numeric, as the characters they stand for.

    Text without an ampersand passes at once; unknown names stay as they are.
    """
    # One literal, which the optimizer reads once: a literal for each name takes seconds to plan.
    names = F.from_json(F.lit(json.dumps(NAMED)), "map<string,string>")
    pattern = "&(#[0-9]{1,9}|#[xX][0-9a-fA-F]{1,7}|[A-Za-z][A-Za-z0-9]*);"

    def decoded(name: Column) -> Column:
        hexadecimal = F.conv(F.substr(name, F.lit(3)), 16, 10).cast("bigint")
        decimal = F.substr(name, F.lit(2)).try_cast("bigint")
        return (
            F.when(name.rlike("^#[xX]"), character(hexadecimal))
            .when(name.startswith("#"), character(decimal))
            .otherwise(
                F.coalesce(F.try_element_at(names, name), F.concat(F.lit("&"), name, F.lit(";")))
            )
        )

    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), decoded)
    between = F.split(text, pattern, -1)
    whole = F.array_join(F.flatten(F.transform(F.arrays_zip(between, found), _pair)), "")
    return F.when(F.contains(text, F.lit("&")), whole).otherwise(text)


def _pair(item: Column) -> Column:
    return F.array(item["0"], F.coalesce(item["1"], F.lit("")))


def sorted_distinct(values: Column, sep: str) -> Column:
    """Aggregate: distinct values as strings, sorted, joined."""
    return F.array_join(F.array_sort(F.collect_set(values.cast("string"))), sep)
