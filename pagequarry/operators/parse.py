"""Binary documents to typed elements and plain text."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.functions.arrays import let
from pagequarry.functions.text import SPACES, clean_section, decode_text, join_sections, unescape
from pagequarry.operators.concat import ordered_concat
from pagequarry.operators.explode import explode_once

ELEMENTS = (
    "array<struct<type:string,text:string,page_number:int,metadata:map<string,string>>>"
)

# HTML that is not text, tags that open or close a block of text,
# and the element type of each.
NOT_TEXT = (
    r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<!doctype[^>]*>"
)
BLOCK_TAG = (
    r"(?i)<(/?)(html|head|title|body|nav|header|footer|article|section|aside|main|div"
    r"|ul|ol|li|table|tr|td|th|blockquote|pre|p|h[1-6])\b[^>]*>"
)
INLINE_BREAK = r"(?i)<br\b[^>]*>"
ANY_TAG = "<[^>]*>"
EDGES = f"^[{SPACES}]+|[{SPACES}]+$"
MARK, TAG_END = "\u0001", "\u0002"


def html_elements(html: Column) -> Column:
    """Elements for the text blocks of a page, in order; a page is page number 1.

    Block tags become marks, the page is split at them, and each piece is typed by
    the tag before it; text after a closing tag has no tag of its own. All of it is
    built-in expressions: no Python worker.
    """
    marked = F.regexp_replace(
        F.regexp_replace(F.translate(html, MARK + TAG_END, ""), NOT_TEXT, ""), BLOCK_TAG, f"{MARK}$1$2{TAG_END}"
    )

    def element(piece: Column) -> Column:
        tag = F.lower(F.regexp_extract(piece, f"^([^/{TAG_END}]+){TAG_END}", 1))
        text = F.substring_index(piece, TAG_END, -1)
        text = F.regexp_replace(F.regexp_replace(text, INLINE_BREAK, "\n"), ANY_TAG, "")
        text = let(text, lambda t: F.translate(unescape(t), "\u00a0", " "))
        kind = (
            F.when(tag.rlike("^(title|h[1-6])$"), "Title")
            .when(tag == "li", "ListItem")
            .when(tag == "p", "NarrativeText")
            .otherwise("Text")
        )
        return F.struct(
            kind.alias("type"),
            F.regexp_replace(text, EDGES, "").alias("text"),
            F.lit(1).alias("page_number"),
            F.create_map(F.lit("tag"), tag).alias("metadata"),
        )

    pieces = F.transform(F.split(marked, MARK), element)
    return F.filter(pieces, lambda e: e["text"] != "").cast(ELEMENTS)


def element_rows(df: DataFrame, elements: Column, *keys: str) -> DataFrame:
    """One row per element with its position in the document."""
    return explode_once(df, elements, *keys, item="_e").select(*keys, "pos", "_e.*")


def parse_html(df: DataFrame, *keys: str, content: str = "content") -> DataFrame:
    """Elements of binary HTML documents."""
    return element_rows(df, html_elements(decode_text(F.col(content))), *keys)


def elements_text(elements: Column, newline: str = "") -> Column:
    """Text of a document: its cleaned elements, one per line."""
    return join_sections(F.transform(elements, lambda e: e["text"]), newline)


def html_text(content: Column, newline: str = "") -> Column:
    """Text of a binary HTML document."""
    return elements_text(html_elements(decode_text(content)), newline)


def parse_with(parser: Callable[..., list[dict]], content: Column, **options) -> Column:
    """Elements from a caller's parser, called as ``parser(bytes, **options)``.

    For formats Spark cannot read itself (PDF, images): the parser returns one dict
    per element with ``text`` and optionally ``type``, ``page_number``, ``metadata``.
    Options such as a parsing strategy are passed through. Run the job inside
    ``small_arrow_batches`` when files are large.
    """

    def rows(document: bytes | None) -> list[dict] | None:
        if document is None:
            return None
        return [
            {
                "type": e.get("type", "Text"),
                "text": e["text"],
                "page_number": e.get("page_number"),
                "metadata": {k: str(v) for k, v in e.get("metadata", {}).items()},
            }
            for e in parser(document, **options)
        ]

    def parse(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(rows)

    return F.pandas_udf(parse, ELEMENTS).asNondeterministic()(content)


def texts_by_page(df: DataFrame, elements: Column, *keys: str) -> DataFrame:
    """Text of each page of each document, as ``page_texts``, from an array of elements.

    A document's elements stay in its row until they are joined: nothing is shuffled.
    """

    def by_page(own: Column) -> Column:
        def joined(page: Column) -> Column:
            here = F.filter(own, lambda e: e["page_number"].eqNullSafe(page))
            return F.struct(page.alias("page_number"), elements_text(here).alias("text"))

        return F.transform(F.array_distinct(F.transform(own, lambda e: e["page_number"])), joined)

    pages = explode_once(df, let(elements, by_page), *keys, item="_p")
    return pages.select(*keys, "_p.*")


def page_texts(elements: DataFrame, *keys: str) -> DataFrame:
    """Text of each page of each document: its cleaned elements, one per line."""
    return ordered_concat(
        elements, [*keys, "page_number"], "pos", clean_section(F.col("text")), "\n", "text"
    )


def image_texts(images: DataFrame, documents: DataFrame, parser: Callable, **options) -> DataFrame:
    """``images`` (pdf_page, page_image_loc) with the text the parser finds in each.

    ``documents`` is a scan of the image folder, with ``path`` and ``content``.
    """
    elements = parse_with(parser, F.col("content"), **options)
    text = F.array_join(F.transform(elements, lambda e: e["text"]), "\n")
    found = documents.select(F.col("path").alias("page_image_loc"), text.alias("text_extract"))
    return images.join(found, "page_image_loc")


def slice_elements(elements: DataFrame, start: int, stop: int) -> DataFrame:
    """Elements at positions ``start`` up to but not including ``stop``."""
    return elements.where((F.col("pos") >= start) & (F.col("pos") < stop))


def element_at(elements: DataFrame, position: int) -> DataFrame:
    """The element at one position of each document."""
    return elements.where(F.col("pos") == position)


def element_type_counts(elements: DataFrame) -> DataFrame:
    return elements.groupBy("type").agg(F.count("*").alias("n"))
