"""HTML clean-up before indexing, and highlight markers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Entities decoded, in this order, and the highlight markers.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#039;", "'"), ("&amp;", "&"))
BLOCKS = r"(?is)<(?:script|style)[^>]*>.*?</(?:script|style)>"
TAGS = r"<[^>]*>"
MARK_OPEN, MARK_CLOSE = "[HIGHLIGHT]", "[/HIGHLIGHT]"
MARKS = r"\[(/?)HIGHLIGHT\]"
# Characters cut from both ends of a snippet.
EDGE = r"[\x00-/:;=?@\[-`]"


def strip_html(html: Column) -> Column:
    """Drop script and style blocks and tags, decode five entities, join spaces."""
    text = F.regexp_replace(html, BLOCKS, " ")
    text = F.regexp_replace(text, TAGS, " ")
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def tag_texts(html: Column, tag: str) -> Column:
    """Texts directly inside ``<tag>`` elements, in document order."""
    return F.regexp_extract_all(html, F.lit(rf"<{tag}(?:\s[^>]*)?>([^<]*)"), F.lit(1))


def format_highlight(text: Column) -> Column:
    return F.regexp_replace(text, MARKS, "<$1strong>")


def clean_snippet(snippet: Column) -> Column:
    """Strip tags, broken tags at the ends and punctuation at the edges."""
    snippet = F.regexp_replace(snippet, TAGS, "")
    snippet = F.regexp_replace(snippet, r"^[^<>]*>|<[^<>]*$", "")
    snippet = format_highlight(snippet)
    return F.regexp_replace(snippet, rf"^{EDGE}+|{EDGE}+$", "")
