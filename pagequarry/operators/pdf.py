"""PDF documents to typed elements.

Every file is read where its row lies: objects, fonts and runs of text, then lines and
elements page by page. A file that is damaged gives the pages that can still be read, one that
is encrypted or no PDF gives none; ``pdf_status`` tells which it is. No file ends a job.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from pagequarry.functions.text import decode_text
from pagequarry.operators.parse import ELEMENTS, html_elements, parse_with
from pagequarry.pdf.layout import elements
from pagequarry.pdf.objects import Document
from pagequarry.pdf.text import Page

STRATEGIES = ("fast", "hi_res")

# What broken files raise wherever they are read.
BROKEN = (ValueError, TypeError, IndexError, KeyError, AttributeError, OverflowError, RecursionError)


def read_pdf(content: bytes, strategy: str = "fast") -> list[dict]:
    """The elements of one file. ``fast`` keeps the order in which text is drawn;
    ``hi_res`` finds columns, paragraphs and ruled tables."""
    found: list[dict] = []
    try:
        document = Document(content)
        pages = [] if document.encrypted else document.pages()
        for number, page in enumerate(pages, 1):
            drawn = _drawn(document, page)
            if drawn is not None:
                own = elements(drawn.runs, drawn.rules, strategy == "hi_res")
                found += [e | {"page_number": number} for e in own]
    except BROKEN:
        pass  # what was read before stands
    return found


def _drawn(document: Document, page: dict) -> Page | None:
    try:
        return Page(document, page)
    except BROKEN:
        document.damaged = True
        return None


def status(content: bytes) -> str:
    """``ok``, ``damaged`` (parts may be missing), ``encrypted`` or ``not_pdf``."""
    if b"%PDF-" not in content[:4096]:
        return "not_pdf"
    try:
        document = Document(content)
        if document.encrypted:
            return "encrypted"
        pages = [_drawn(document, page) for page in document.pages()]
        return "ok" if pages and not document.damaged else "damaged"
    except BROKEN:
        return "damaged"


def is_pdf(content: Column) -> Column:
    return F.coalesce(F.substring(content, 1, 5) == F.lit(b"%PDF-"), F.lit(False))


def pdf_elements(content: Column, strategy: str = "fast") -> Column:
    """Elements of binary PDF documents, in order; null for null."""
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy is one of {STRATEGIES}")
    return parse_with(read_pdf, content, strategy=strategy)


def pdf_status(content: Column) -> Column:
    """How each document could be read."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda c: None if c is None else status(c))

    return F.pandas_udf(run, "string")(content)


def document_elements(content: Column, strategy: str = "fast") -> Column:
    """Elements of documents of either kind: PDF by its first bytes, HTML else.

    Only PDF files go to Python workers; pages are read by built-in expressions."""
    pdf = is_pdf(content)
    by_worker = pdf_elements(F.when(pdf, content), strategy)
    return F.when(pdf, by_worker).otherwise(html_elements(decode_text(content))).cast(ELEMENTS)
