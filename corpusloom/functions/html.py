"""Markup expressions on whole documents (Column -> Column)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WHITESPACE, clean_text, empty_to_null, strip

TAG = r"<[^>]*>"
ANCHOR = r"(?is)<a(?:\s[^>]*)?>.*?</a\s*>"
ANCHOR_OPEN = r"(?is)<a(?:\s[^>]*)?>"
IMAGE = r"(?is)<img(?:\s[^>]*)?>"
ANCHOR_OR_IMAGE_OPEN = r"(?is)<(?:a|img)(?:\s[^>]*)?>"
# A Unicode noncharacter, never part of interchanged text, marks token borders.
BORDER = "\uffff"
NOISE = r"(?is)<!--.*?-->|<script(?:\s[^>]*)?>.*?</script\s*>|<style(?:\s[^>]*)?>.*?</style\s*>"

# The named entities that are decoded, ampersand last.
ENTITIES = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#x27;", "'"),
    ("&#39;", "'"),
    ("&amp;", "&"),
]


def escape(c: Column) -> Column:
    out = F.replace(c, F.lit("&"), F.lit("&amp;"))
    for old, new in (("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def unescape(c: Column) -> Column:
    out = c
    for entity, char in ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute in an opening tag, any namespace prefix allowed; '' when absent."""
    pattern = (
        rf"""(?is)\A<[^\s>]+(?:\s+[^\s=>]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+))?)*?"""
        rf"""\s+(?:[\w.-]+:)?{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
    )
    quoted = F.regexp_extract(tag, pattern, 1)
    return unescape(F.regexp_replace(quoted, r"""\A["']|["']\z""", ""))


def set_attribute(tag: Column, name: str, value: Column) -> Column:
    """The opening tag with another value of an attribute that it has, however the old one is quoted."""
    found = (
        rf"""(?is)\A(<[^\s>]+(?:\s+[^\s=>]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+))?)*?)"""
        rf"""\s+(?:[\w.-]+:)?{name}\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+)"""
    )
    rest = F.substring(tag, F.length(F.regexp_extract(tag, found, 0)) + 1, F.length(tag))
    return F.concat(F.regexp_extract(tag, found, 1), F.lit(f' {name}="'), value, F.lit('"'), rest)


def escape_text(c: Column) -> Column:
    """Escape what may not stand in text: ampersand and angle brackets."""
    out = F.replace(c, F.lit("&"), F.lit("&amp;"))
    for old, new in (("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def escape_attribute(c: Column) -> Column:
    return F.replace(escape_text(c), F.lit('"'), F.lit("&quot;"))


def unwrap_cdata(c: Column) -> Column:
    """Literal sections become ordinary escaped text."""
    inner = lambda t: escape_text(F.regexp_extract(t, r"(?s)\A<!\[CDATA\[(.*)\]\]>\z", 1))
    return map_tokens(c, r"(?s)<!\[CDATA\[.*?\]\]>", inner)


def tag_text(markup: Column, separator: str = " ") -> Column:
    """Visible text: markup between two texts becomes one separator.

    Each tag becomes a mark first and runs of marks and blanks collapse then: one repeated group for both
    would recurse in the regex engine for every tag.
    """
    marked = F.regexp_replace(markup, TAG, BORDER)
    blank = rf"[{WHITESPACE[1:-1]}{BORDER}]"
    spaced = F.regexp_replace(marked, rf"{WHITESPACE}*+{BORDER}{blank}*+", separator)
    return strip(unescape(spaced))


def drop_noise(markup: Column) -> Column:
    """Remove comments, scripts and styles so that no tag is seen inside them."""
    return F.regexp_replace(markup, NOISE, "")


def interleave(segments: Column, tokens: Column) -> Column:
    """Inverse of splitting a text at its tokens (one segment more than tokens)."""
    return F.array_join(
        F.zip_with(segments, tokens, lambda s, t: F.concat(s, F.coalesce(t, F.lit("")))), ""
    )


def pieces(text: Column, pattern: str) -> Column:
    """Text cut at its tokens: [text, token, text, ..., text], in one regex pass."""
    return F.split(F.regexp_replace(text, pattern, f"{BORDER}$0{BORDER}"), BORDER)


def map_tokens(text: Column, pattern: str, change: Callable[[Column], Column]) -> Column:
    """Replace every match of ``pattern`` by ``change(match)``, in place."""
    changed = F.transform(
        pieces(text, pattern), lambda piece, i: F.when(i % 2 == 1, change(piece)).otherwise(piece)
    )
    return F.array_join(changed, "")


def normalize_newlines(c: Column) -> Column:
    body = strip(F.regexp_replace(c, r"\n{3,}", "\n\n"))
    return F.when(body == "", F.lit("")).otherwise(F.concat(body, F.lit("\n")))


# Attributes that survive cleaning.
KEPT_ATTRIBUTES = ("href", "src", "alt", "title")


def clean_markup(markup: Column) -> Column:
    """Drop all but the kept attributes and unwrap span elements."""
    kept = "|".join(KEPT_ATTRIBUTES)
    attribute_pattern = rf"""(?is)\s(?:{kept})\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+)"""

    def rebuild(tag: Column) -> Column:
        name = F.regexp_extract(tag, r"\A<([a-zA-Z][^\s/>]*)", 1)
        keep = F.array_join(F.regexp_extract_all(tag, F.lit(attribute_pattern), F.lit(0)), "")
        close = F.when(tag.endswith("/>"), F.lit("/>")).otherwise(F.lit(">"))
        return F.when(F.lower(name) == "span", F.lit("")).otherwise(
            F.concat(F.lit("<"), name, keep, close)
        )

    without_span_ends = F.regexp_replace(markup, r"(?i)</span\s*>", "")
    return map_tokens(without_span_ends, r"(?s)<[a-zA-Z][^>]*>", rebuild)


def document_title(html: Column) -> Column:
    return unescape(F.regexp_extract(html, r"(?is)<title(?:\s[^>]*)?>(.*?)</title\s*>", 1))


def document_body(html: Column) -> Column:
    """Inside of the body element (which may be left open); the whole text without one."""
    inner = F.regexp_extract(html, r"(?is)<body(?:\s[^>]*)?>(.*?)(?:</body\s*>|\z)", 1)
    return F.coalesce(empty_to_null(inner), html)


HEADING = r"(?is)<h1(?:\s[^>]*)?>(.*?)</h1\s*>"


def answer_body(html: Column) -> Column:
    """Body without its first heading when that only repeats the document title."""
    body = document_body(html)
    heading = F.regexp_extract(body, HEADING, 0)
    repeats = (heading != "") & (tag_text(F.regexp_extract(body, HEADING, 1)) == document_title(html))
    at = F.instr(body, heading)
    cut = F.concat(
        F.substring(body, F.lit(1), at - 1),
        F.substring(body, at + F.length(heading), F.length(body)),
    )
    return strip(F.when(repeats, cut).otherwise(body))


def unwrap_code_images(markup: Column, asset_scheme: str = "asset") -> Column:
    """An image that was rendered as an indented code block becomes an image again."""
    return F.regexp_replace(
        markup,
        rf"(?s)<pre><code>\s*!\[([^\]]*)\]\(({asset_scheme}://[^)]+)\)\s*</code></pre>",
        '<img alt="$1" src="$2"/>',
    )


# Elements that hold others, and elements that hold a run of text (their end tag may be missing).
CONTAINERS = [
    "address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figure", "footer", "form", "header",
    "main", "nav", "ol", "pre", "section", "table", "tbody", "tfoot", "thead", "ul",
]
LEAVES = ["caption", "dd", "dt", "figcaption", "h1", "h2", "h3", "h4", "h5", "h6", "legend", "li", "p", "summary", "td", "th", "tr"]
BLOCK_TAG = rf"(?i)</?(?:hr|{'|'.join(CONTAINERS + LEAVES)})(?=[\s/>])[^>]*>"


def block_runs(html: Column) -> tuple[Column, Column]:
    """Borders of blocks (tags) in the body, and the markup before, between and after them (one more)."""
    body = document_body(drop_noise(html))
    return F.regexp_extract_all(body, F.lit(BLOCK_TAG), F.lit(0)), F.split(body, BLOCK_TAG, -1)


def run_text(markup: Column) -> Column:
    return clean_text(tag_text(markup))


def plain_text(html: Column) -> Column:
    """All visible text of the body, a line for each run between block borders, in document order."""
    texts = F.transform(block_runs(html)[1], run_text)
    return F.array_join(F.filter(texts, lambda t: t != ""), "\n")


def anchor_content(rest: Column) -> Column:
    """What an anchor holds, from the markup behind its opening tag up to the next anchor.

    It ends with its end tag, or, when that is missing, at the next block border.
    """
    ends = F.split(rest, r"(?i)</a\s*>", 2)
    return F.when(F.size(ends) > 1, ends[0]).otherwise(F.split(rest, BLOCK_TAG, 2)[0])
