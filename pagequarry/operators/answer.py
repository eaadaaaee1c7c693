"""Retrieved chunks to contexts, prompts, answers and source lists."""

from __future__ import annotations

import hashlib
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagequarry.functions.html import answer_html
from pagequarry.functions.text import guarded, is_blank, sorted_distinct, split_items, split_words
from pagequarry.operators.chunk import count_words
from pagequarry.operators.embed import Embedder, embed
from pagequarry.operators.explode import explode_once
from pagequarry.operators.nearest import retrieve
from pagequarry.scratch import materialise
from pagequarry.sources import tables

# The answer limit in tokens and the prefixes of the source lists.
ANSWER_TOKENS = 256
PAGES_PREFIX = "Document Page Numbers ="
NAMES_PREFIX = "Document ="
DETAILS_PREFIX = "Document Details ="

CONTEXT_SEPARATOR = "\n\n"
PROMPT = "{context}\n\nQuestion: {question}\nAnswer:"


Search = Callable[[DataFrame, int], DataFrame]


# Most prompts and tokens of one request, answers included.
REQUEST_PROMPTS = 64
REQUEST_TOKENS = 32_000
# Rows without a prompt that a task holds before it passes them on.
MOST_WAITING = 10_000


class Request(NamedTuple):
    """What a model is asked at once. The key is the same whenever the same is asked, so a
    server can tell a repeated request."""

    prompts: list[str]
    max_tokens: int | None
    key: str


@dataclass(frozen=True)
class Generator:
    """A language model by name. ``load()`` runs in the worker and returns the call
    ``list of prompts -> list of answers`` or, with ``requests``, ``Request -> answers``.

    ``max_tokens`` bounds each answer, ``count`` counts the tokens of a prompt, and a call
    that raises one of ``retry_on`` is made again, up to ``retries`` times.
    """

    name: str
    load: Callable[[], Callable]
    max_tokens: int | None = None
    count: Callable[[str], int] = count_words
    requests: bool = False
    retry_on: tuple[type[Exception], ...] = ()
    retries: int = 3
    pause: float = 0.5


def extractive(max_tokens: int = ANSWER_TOKENS) -> Generator:
    """Offline stand-in for a language model, for tests: the first sentence of the
    first passage of the prompt, cut to ``max_tokens`` words."""
    sentence = re.compile(r".*?[.!?](?=[ \t\r\n]|\Z)", re.S)

    def answer(prompt: str) -> str:
        passage = prompt.split(CONTEXT_SEPARATOR)[0]
        found = sentence.match(passage)
        return " ".join(split_words(found.group() if found else passage)[:max_tokens])

    def load() -> Callable[[list[str]], list[str]]:
        return lambda prompts: [answer(p) for p in prompts]

    return Generator(f"extractive-{max_tokens}", load, max_tokens)


def _asked(call: Callable, generator: Generator, prompts: list[str]) -> list[str]:
    """The answers of one request, asked again after errors that pass."""
    key = hashlib.sha256("\0".join([generator.name, *prompts]).encode()).hexdigest()
    request = Request(prompts, generator.max_tokens, key)
    for nth in range(generator.retries + 1):
        try:
            answers = list(call(request if generator.requests else prompts))
            break
        except generator.retry_on:
            if nth == generator.retries:
                raise
            time.sleep(generator.pause * 2**nth)
    if len(answers) != len(prompts):
        raise ValueError(f"{generator.name}: not one answer per prompt")
    return answers


def generate(
    prompt: Column,
    generator: Generator,
    request_prompts: int = REQUEST_PROMPTS,
    request_tokens: int = REQUEST_TOKENS,
) -> Column:
    """Answers to a prompt column; null prompts are not sent to the model.

    Prompts are packed into requests in their order, across Arrow batches: a request is sent
    when one more prompt and its answer would exceed either bound. A longer prompt is a
    request of its own. Marked nondeterministic so that the optimizer never calls the model
    twice.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        call = generator.load()

        def answered(rows: list[str | None]) -> pd.Series:
            prompts = [p for p in rows if p is not None]
            given = iter(_asked(call, generator, prompts) if prompts else [])
            return pd.Series([None if p is None else next(given) for p in rows], dtype=object)

        waiting: list[str | None] = []
        size = tokens = 0
        for batch in batches:
            for text in batch.where(batch.notna(), None):
                cost = 0
                if text is not None:
                    cost = generator.count(text) + (generator.max_tokens or 0)
                full = size and (size >= request_prompts or tokens + cost > request_tokens)
                if (full and text is not None) or len(waiting) >= MOST_WAITING:
                    yield answered(waiting)
                    waiting, size, tokens = [], 0, 0
                waiting.append(text)
                size += text is not None
                tokens += cost
        if waiting:
            yield answered(waiting)

    return F.pandas_udf(run, "string").asNondeterministic()(prompt)


def _ranked(column: str) -> Column:
    """Aggregate: the values of one question in rank order; at most k of them."""
    pairs = F.array_sort(F.collect_list(F.struct("rank", column)))
    return F.transform(pairs, lambda p: p[column])


def build_contexts(hits: DataFrame, sep: str = CONTEXT_SEPARATOR) -> DataFrame:
    """Per question: all retrieved chunks in one text, and their distinct sources."""
    return hits.groupBy("qid").agg(
        F.array_join(_ranked("content"), sep).alias("context"),
        F.array_distinct(_ranked("url")).alias("sources"),
    )


def answer_sources(hits: DataFrame) -> DataFrame:
    """Per question: distinct sources, nearest first."""
    return hits.groupBy("qid").agg(F.array_distinct(_ranked("url")).alias("sources"))


def prompt(context: Column, question: Column, template: str = PROMPT) -> Column:
    """The template with both texts filled in."""
    before, rest = template.split("{context}")
    between, after = rest.split("{question}")
    return F.concat(F.lit(before), context, F.lit(between), question, F.lit(after))


def build_prompts(questions: DataFrame, hits: DataFrame, template: str = PROMPT) -> DataFrame:
    """Every question with its context, sources and prompt.

    A question without hits has an empty context; a blank one has no prompt.
    """
    filled = questions.join(build_contexts(hits), "qid", "left").select(
        "qid",
        "question",
        F.coalesce("context", F.lit("")).alias("context"),
        F.coalesce("sources", F.array().cast("array<string>")).alias("sources"),
    )
    text = prompt(F.col("context"), F.col("question"), template)
    return filled.withColumn("prompt", F.when(~is_blank(F.col("question")), text))


def embed_questions(questions: DataFrame, embedder: Embedder) -> DataFrame:
    """Non-blank questions with vectors, written down so the model is called once."""
    asked = questions.where(~is_blank(F.col("question")))
    return materialise(
        asked.select("qid", embed(F.col("question"), embedder).alias("embedding")), "questions"
    )


def answer_questions(
    questions: DataFrame,
    chunks: DataFrame,
    embedder: Embedder,
    generator: Generator,
    k: int = 4,
    metric: str = "l2",
    template: str = PROMPT,
    parallel: int | None = None,
    search: Search | None = None,
    request_prompts: int = REQUEST_PROMPTS,
    request_tokens: int = REQUEST_TOKENS,
) -> DataFrame:
    """Guard, retrieve, generate: (qid, question, result, sources) per question.

    ``questions`` is (qid, question), ``chunks`` (id, url, content, embedding).
    ``parallel`` bounds the number of concurrent model callers, and the request bounds what
    each asks at once (see ``generate``). ``search`` finds the
    neighbours of (qid, embedding) rows, by a stored index or in another way, and returns
    (qid, rank, id, dist); by default the chunks are scanned.
    """
    asked = embed_questions(questions, embedder)
    if search is None:
        hits = retrieve(asked, chunks, k, metric)
    else:
        hits = search(asked, k).join(chunks.drop("embedding"), "id")
    prompts = build_prompts(questions, hits, template)
    if parallel:
        prompts = prompts.repartition(parallel)
    answered = prompts.withColumn("_answer", generate(F.col("prompt"), generator, request_prompts, request_tokens))
    return answered.select(
        "qid", "question", guarded(F.col("question"), F.col("_answer")).alias("result"), "sources"
    )


def retrieve_from(
    collection: str, questions: DataFrame, embedder: Embedder, k: int = 4
) -> DataFrame:
    """Hits of (qid, question) rows in a collection, by the metric it was made for.

    The embedder must be the one the collection was filled with.
    """
    spark = questions.sparkSession
    metric = tables.check_embedder(spark, collection, embedder)["metric"]
    chunks = spark.read.table(collection).select(
        "id", F.col("uri").alias("url"), F.col("document").alias("content"), "embedding"
    )
    return retrieve(embed_questions(questions, embedder), chunks, k, metric)


def source_summary(hits: DataFrame) -> DataFrame:
    """Per question: the distinct pages, names and contents of its hits, as text.

    ``hits`` has ``page``, ``url`` and ``content``; each list is sorted.
    """

    def listed(prefix: str, column: str, sep: str) -> Column:
        return F.concat(F.lit(prefix), sorted_distinct(F.col(column), sep))

    return hits.groupBy("qid").agg(
        listed(PAGES_PREFIX, "page", ",").alias("doc_pages"),
        listed(NAMES_PREFIX, "url", ",").alias("doc_names"),
        listed(DETAILS_PREFIX, "content", ".\n").alias("doc_content"),
    )


def format_answers(answers: DataFrame) -> DataFrame:
    """Answers as HTML with their source links."""
    return answers.select("qid", answer_html(F.col("result"), F.col("sources")).alias("html"))


def split_answers(answers: DataFrame, *keys: str, column: str = "result") -> DataFrame:
    """One row per item of an answer whose items are set apart by blank lines."""
    return explode_once(answers, split_items(F.col(column)), *keys, item="item")


def limit_questions(questions: DataFrame, order: str, n: int = 50) -> DataFrame:
    """The first ``n`` questions in the order of ``order``."""
    return questions.orderBy(order).limit(n).select("question")
