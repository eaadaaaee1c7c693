"""HTML expressions for rendering chats and answers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The layout of a rendered chat.
USER_OPEN = (
    '\n      <div style="width: 90%; border-radius: 10px; background-color: #c2efff; '
    "padding: 10px; box-shadow: 2px 2px 2px #F7f7f7; margin-bottom: 10px; "
    'font-size: 14px;">\n        '
)
ASSISTANT_OPEN = (
    '\n      <div style="width: 90%; border-radius: 10px; background-color: #e3f6fc; '
    "padding: 10px; box-shadow: 2px 2px 2px #F7f7f7; margin-bottom: 10px; "
    'margin-left: 40px; font-size: 14px">\n        '
)
MESSAGE_CLOSE = "\n      </div>"
AVATAR_STYLE = "float: left; width:40px; margin: -10px 5px 0px -10px"
SOURCES_OPEN = "<br/><br/><br/><strong>Sources:</strong><br/> <ul>"
SOURCES_CLOSE = "</ul>"


def message_html(role: Column, text: Column, avatar_url: str | None = None) -> Column:
    """One chat message; every role but ``user`` is rendered as the assistant, null text as
    an empty message."""
    text = F.coalesce(text, F.lit(""))
    avatar = (
        f'<img style="{AVATAR_STYLE}" src="{avatar_url}"/>\n        ' if avatar_url else ""
    )
    return F.when(
        role == "user", F.concat(F.lit(USER_OPEN), text, F.lit(MESSAGE_CLOSE))
    ).otherwise(F.concat(F.lit(ASSISTANT_OPEN + avatar), text, F.lit(MESSAGE_CLOSE)))


def answer_html(result: Column, sources: Column) -> Column:
    """Answer with line breaks, followed by a list of links when there are sources."""
    links = F.transform(
        sources,
        lambda s: F.concat(F.lit('<li><a href="'), s, F.lit('">'), s, F.lit("</a></li>")),
    )
    listing = F.concat(F.lit(SOURCES_OPEN), F.array_join(links, "\n"), F.lit(SOURCES_CLOSE))
    return F.concat(
        F.replace(result, F.lit("\n"), F.lit("<br/>")),
        F.when(F.size(sources) > 0, listing).otherwise(F.lit("")),
    )
