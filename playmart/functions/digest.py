"""Weekly digest text and HTML, built as columns from a ``weekly_stats`` row.

Delivery (a language-model call, mail) is outside the library; these columns
are what would be sent.  Names are HTML-escaped in the HTML body.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scalars import html_escape, newline_to_break, preview

# The digest's text pieces.  The list item formats
# "<name> (<n> plays)" and "<li><name> — <n> plays</li>", the label
# "Total listening time: <m> minutes" and the section headings follow the
# digest the pipeline sends; the prompt sentences are this library's own.
ITEM_TEXT = ("", " (", " plays)")
ITEM_HTML = ("<li>", " — ", " plays</li>")
LIST_SEP = ", "
TOTAL_LABEL = ("Total listening time: ", " minutes")
PROMPT_LINES = (
    "Write a short, upbeat weekly listening summary for one listener.",
    "Listening in the past 7 days:",
    "- {total}",
    "- Top songs: {songs}",
    "- Top artists: {artists}",
    "Three paragraphs of prose, under 200 words.",
)
HTML_PARTS = (
    "<html><body><h1>Your Weekly Listening</h1><p>",
    "</p><h3>By the Numbers</h3><p><strong>Total listening time:</strong> ",
    " minutes</p><h4>Top Songs</h4><ol>",
    "</ol><h4>Top Artists</h4><ol>",
    "</ol></body></html>",
)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def item_list(arr_col: str | Column) -> Column:
    """``name (n plays), ...`` from ``array<struct<name, plays>>``."""
    pre, mid, post = ITEM_TEXT
    return F.array_join(F.transform(_col(arr_col), lambda x: F.concat(
        F.lit(pre), F.coalesce(x["name"], F.lit("")), F.lit(mid), x["plays"].cast("string"),
        F.lit(post))), LIST_SEP)


def html_items(arr_col: str | Column) -> Column:
    """``<li>name — n plays</li>...`` with names escaped."""
    pre, mid, post = ITEM_HTML
    return F.array_join(F.transform(_col(arr_col), lambda x: F.concat(
        F.lit(pre), html_escape(F.coalesce(x["name"], F.lit(""))), F.lit(mid),
        x["plays"].cast("string"), F.lit(post))), "")


def prompt_text(stats_cols=("top_songs", "top_artists", "total_minutes")) -> Column:
    songs, artists, minutes = stats_cols
    total = F.concat(F.lit(TOTAL_LABEL[0]), F.col(minutes).cast("string"), F.lit(TOTAL_LABEL[1]))
    fills = {"{total}": total, "{songs}": item_list(songs), "{artists}": item_list(artists)}
    parts = []
    for i, line in enumerate(PROMPT_LINES):
        if i:
            parts.append(F.lit("\n"))
        slot = next((k for k in fills if k in line), None)
        if slot is None:
            parts.append(F.lit(line))
        else:
            head, tail = line.split(slot)
            parts += [F.lit(head), fills[slot], F.lit(tail)]
    return F.concat(*parts)


def html_body(body_text: Column, stats_cols=("top_songs", "top_artists", "total_minutes")) -> Column:
    songs, artists, minutes = stats_cols
    p0, p1, p2, p3, p4 = HTML_PARTS
    return F.concat(
        F.lit(p0), newline_to_break(html_escape(body_text)),
        F.lit(p1), F.col(minutes).cast("string"),
        F.lit(p2), html_items(songs),
        F.lit(p3), html_items(artists),
        F.lit(p4))


def digest(stats: DataFrame, group_cols=()) -> DataFrame:
    """``prompt, html, preview`` per stats row (the prompt stands in for the body)."""
    p = prompt_text()
    return stats.select(*group_cols, p.alias("prompt"),
                        html_body(p).alias("html"),
                        preview(p).alias("preview"))
