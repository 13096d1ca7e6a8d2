"""SQL fragments for the check queries (the check database's dialect)."""

from __future__ import annotations

WS = r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def fold(x: str) -> str:
    # upper() keeps the sharp s here, so it is folded by hand.
    return f"replace(lower(upper({x})), 'ß', 'ss')"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '\A{WS}+|{WS}+\z', '', 'g')"


def clean(x: str) -> str:
    return f"coalesce(trim(regexp_replace({x}, '{WS}+', ' ', 'g')), '')"


def slug(x: str, key: str) -> str:
    return (
        f"coalesce(nullif(trim(regexp_replace(lower({x}), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'page-' || {key})"
    )


def unescape(x: str) -> str:
    out = x
    for entity, char in (
        ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "''"), ("&#39;", "''"), ("&amp;", "&"),
    ):
        out = f"replace({out}, '{entity}', '{char}')"
    return out


def escape(x: str) -> str:
    out = x
    for char, entity in (
        ("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("''", "&#x27;"),
    ):
        out = f"replace({out}, '{char}', '{entity}')"
    return out


def no_noise(x: str) -> str:
    return (
        f"regexp_replace({x}, '(?is)<!--.*?-->|<script(?:\\s[^>]*)?>.*?</script\\s*>"
        f"|<style(?:\\s[^>]*)?>.*?</style\\s*>', '', 'g')"
    )


def tag_text(x: str) -> str:
    return strip(unescape(f"regexp_replace({x}, '{WS}*(?:<[^>]*>{WS}*)+', ' ', 'g')"))


# Anchors of every page: position, href and text.
ANCHORS = rf"""
anchors AS (
  SELECT page_id, url, pos, {strip(unescape("regexp_extract(tok, '(?is)^<a[^>]*?href=\"([^\"]*)\"', 1)"))} AS href,
         {tag_text("tok")} AS label
  FROM (SELECT page_id, url, unnest(toks) AS tok, unnest(range(1, len(toks) + 1)) AS pos
        FROM (SELECT page_id, url, regexp_extract_all({no_noise("html")}, '(?is)<a(?:\s[^>]*)?>.*?</a\s*>') AS toks FROM pages)))
"""
