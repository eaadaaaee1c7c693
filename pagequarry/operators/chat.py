"""Chat histories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.functions.html import answer_html, message_html
from pagequarry.operators.concat import ordered_concat


def render_conversations(
    messages: DataFrame, conversation: str = "conv_id", avatar_url: str | None = None
) -> DataFrame:
    """One HTML string per conversation, messages in turn order."""
    rendered = message_html(F.col("role"), F.col("text"), avatar_url)
    return ordered_concat(messages, [conversation], "turn", rendered, "", "html")


def chat_pages(
    messages: DataFrame,
    answers: DataFrame,
    conversation: str = "conv_id",
    avatar_url: str | None = None,
) -> DataFrame:
    """The page of each conversation: its history and, where there is one, the new answer with
    its sources as the last message of the assistant.

    ``answers`` is (conversation, result, sources), at most one of each; one without a history
    is a page of its own.
    """
    history = render_conversations(messages, conversation, avatar_url)
    reply = message_html(
        F.lit("assistant"), answer_html(F.col("result"), F.col("sources")), avatar_url
    )
    last = answers.select(conversation, reply.alias("reply"))
    page = F.concat(F.coalesce("html", F.lit("")), F.coalesce("reply", F.lit("")))
    return history.join(last, conversation, "full_outer").select(conversation, page.alias("html"))
