"""Wiki storage markup: references, links, images, macros and their warnings.

A body is cut once into text pieces and top-level tokens (outermost macro, link,
image, opening anchor). Tokens are exploded, resolved by joins, and put back in
place, so a body crosses the network once however many lookups it needs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import text as T
from .dedupe import last_wins

MACRO_OPEN = r"(?is)<ac:(?:structured-)?macro(?:\s[^>]*)?>"
MACRO_CLOSE = r"(?is)</ac:(?:structured-)?macro\s*>"
# One '<' stands before all alternatives, so that text between tags costs one test a character.
TOKEN = (
    r"(?is)<(?:ac:(?:structured-)?macro(?:\s[^>]*)?>|/ac:(?:structured-)?macro\s*>"
    r"|ac:link(?:\s[^>]*)?>.*?</ac:link\s*>|ac:image(?:\s[^>]*)?>.*?</ac:image\s*>|a(?:\s[^>]*)?>)"
)

# Macro families and the texts that stand in for markup.
CODE_MACROS = ["code", "noformat"]
NOTE_MACROS = ["info", "note", "warning", "tip", "panel"]
PLACEHOLDER = "[Confluence macro: "
WARN_MACRO = "Unsupported Confluence macro preserved as text: "
WARN_PAGE = "Unresolved Confluence page link: "
WARN_ATTACHMENT = "Unresolved Confluence attachment link: "
WARN_SPACE = "Unresolved Confluence space link: "
WARN_LINK = "Unresolved Confluence link without page or URL target"
WARN_IMAGE = "Embedded image was not mirrored: "
IMAGE_ALT = "Confluence image"


def tag(markup: Column, name: str) -> Column:
    """First opening tag of that name, or ''."""
    return F.regexp_extract(markup, rf"(?is)<{name}(?:\s[^>]*)?/?>", 0)


def page_references(bodies: DataFrame, key: str = "id", body: str = "body") -> DataFrame:
    """Referenced page titles with their space key; the last mention of a title wins."""
    found = F.regexp_extract_all(F.col(body), F.lit(r"(?is)<ri:page(?:\s[^>]*)?>"), F.lit(0))
    mentions = bodies.select(key, F.posexplode(found).alias("pos", "tok")).select(
        key,
        "pos",
        H.attribute(F.col("tok"), "content-title").alias("title"),
        T.empty_to_null(H.attribute(F.col("tok"), "space-key")).alias("space_key"),
    )
    mentions = mentions.filter("title <> ''")
    return last_wins(mentions, "title", [key, "pos"]).select("title", "space_key")


def title_map(pages: DataFrame, link_targets: DataFrame, knowledge_scheme: str = "knowledge") -> DataFrame:
    """Title -> address; a packaged page overrides an external address.

    ``pages`` has (id, title, uri_id); of several pages with one title the one
    whose id sorts last wins.
    """
    inside = pages.select(
        F.coalesce("title", F.lit("")).alias("title"),
        F.concat(F.lit(f"{knowledge_scheme}://"), "uri_id").alias("address"),
        F.lit(1).alias("_rank"),
        "id",
    )
    outside = link_targets.select(
        "title", F.col("url").alias("address"), F.lit(0).alias("_rank"), F.lit("").alias("id")
    )
    return last_wins(inside.unionByName(outside), "title", ["_rank", "id", "address"]).select(
        "title", "address"
    )


def ambiguous_titles(pages: DataFrame) -> DataFrame:
    """Titles shared by several packaged pages: links to them go to one page silently."""
    return pages.groupBy("title").agg(F.count("*").alias("pages")).filter("pages > 1")


def attachment_map(attachments: DataFrame) -> DataFrame:
    """(page_id, name) -> asset_id of available attachments; title and file name both count."""
    usable = attachments.filter("status = 'available'")
    names = usable.select(
        "page_id", "seq", "asset_id", F.posexplode(F.array("title", "filename")).alias("_n", "name")
    ).filter("coalesce(name, '') <> ''")
    return last_wins(names, ["page_id", "name"], ["seq", "_n"]).select("page_id", "name", "asset_id")


def cross_space(references: DataFrame, known: DataFrame, candidates: DataFrame, base_url: str) -> DataFrame:
    """Resolve titles that the known targets miss by case-folded exact title match.

    A candidate inside the referenced space wins (the first listed one); else a
    candidate counts only when it is the only one. Output: title, space_key,
    page_id, url; unresolved titles keep nulls. Candidates are aggregated per
    reference, never paired with each other.
    """
    open_refs = references.join(known.select("title").distinct(), "title", "left_anti")
    listed = candidates.select(
        T.fold(F.col("title")).alias("_folded"), F.col("id").alias("page_id"), "webui", "seq"
    )
    joined = open_refs.withColumn("_folded", T.fold(F.col("title"))).join(listed, "_folded", "left")
    marker = F.concat(F.lit("/spaces/"), "space_key", F.lit("/"))
    in_space = F.coalesce(F.col("webui").contains(marker), F.lit(False))
    best = joined.groupBy("title", "space_key").agg(
        F.count("page_id").alias("_n"),
        F.min_by(F.struct("page_id", "webui"), F.struct((~in_space).alias("o"), F.col("seq"))).alias("_pick"),
        F.max(in_space).alias("_inside"),
    )
    usable = (F.col("_inside") | (F.col("_n") == 1)) & (F.coalesce("_pick.webui", F.lit("")) != "")
    return best.select(
        "title",
        "space_key",
        F.when(usable, F.col("_pick.page_id")).alias("page_id"),
        F.when(usable, T.absolute_url(F.col("_pick.webui"), F.lit(base_url))).alias("url"),
    )


def cut(body: Column) -> Column:
    """Body as [text, token, text, token, ..., text] with only top-level tokens.

    Folds over the tags in document order with the macro depth; everything inside
    an outermost macro, nested macros included, stays part of that one token.
    """
    start = F.struct(
        F.lit(0).alias("depth"),
        F.lit(0).alias("i"),
        F.lit("").alias("buf"),
        F.array().cast("array<string>").alias("out"),
    )

    def step(acc: Column, x: Column) -> Column:
        is_mark = acc["i"] % 2 == 1
        closes = is_mark & x.rlike(r"\A" + MACRO_CLOSE)
        opens = is_mark & x.rlike(r"\A" + MACRO_OPEN) & ~x.endswith("/>")
        at_top = acc["depth"] == 0
        begins = is_mark & at_top & opens
        ends = closes & (acc["depth"] == 1)
        whole = is_mark & at_top & ~opens & ~closes  # a complete token at top level
        return F.struct(
            F.when(opens, acc["depth"] + 1)
            .when(closes & ~at_top, acc["depth"] - 1)
            .otherwise(acc["depth"])
            .alias("depth"),
            (acc["i"] + 1).alias("i"),
            F.when(whole | ends, F.lit("")).when(begins, x).otherwise(F.concat(acc["buf"], x)).alias("buf"),
            F.when(whole, F.concat(acc["out"], F.array(acc["buf"], x)))
            .when(begins, F.concat(acc["out"], F.array(acc["buf"])))
            .when(ends, F.concat(acc["out"], F.array(F.concat(acc["buf"], x))))
            .otherwise(acc["out"])
            .alias("out"),
        )

    return F.aggregate(
        H.pieces(body, TOKEN), start, step, lambda acc: F.concat(acc["out"], F.array(acc["buf"]))
    )


def _pieces(df: DataFrame, key: str, body: str) -> DataFrame:
    # The outer form keeps the optimizer from evaluating the cut again in a filter.
    tokens = df.select(key, F.posexplode_outer(cut(F.col(body))).alias("pos", "tok")).filter("pos % 2 = 1")
    kind = (
        F.when(F.col("tok").rlike(r"(?i)\A<ac:link"), "link")
        .when(F.col("tok").rlike(r"(?i)\A<ac:image"), "image")
        .when(F.col("tok").rlike(r"(?i)\A<a[\s>]"), "anchor")
        .otherwise("macro")
    )
    return tokens.withColumn("kind", kind)


def _anchor(address: Column, label: Column) -> Column:
    return F.concat(
        F.lit('<a href="'), H.escape_attribute(address), F.lit('">'), H.escape_text(label), F.lit("</a>")
    )


def _image(alt: Column, address: Column) -> Column:
    return F.concat(
        F.lit('<img alt="'), H.escape_attribute(alt), F.lit('" src="'), H.escape_attribute(address), F.lit('"/>')
    )


def _parts(tokens: DataFrame, key: str, pages: DataFrame | None) -> DataFrame:
    """Token rows with everything read from the markup: names, titles, labels."""
    # A macro token also yields its nested macros, for their warnings only.
    opens = F.regexp_extract_all("tok", F.lit(MACRO_OPEN), F.lit(0))
    after = F.split("tok", MACRO_OPEN)
    nested = F.when(
        F.col("kind") == "macro",
        F.zip_with(opens, F.slice(after, 2, F.size(after)), lambda o, t: F.struct(o.alias("open"), t.alias("after"))),
    ).otherwise(F.array(F.struct(F.col("tok").alias("open"), F.lit("").alias("after"))))
    rows = tokens.select(key, "pos", "kind", "tok", F.posexplode(nested).alias("idx", "_m"))
    scope = F.when(F.col("idx") == 0, F.col("tok")).otherwise(F.col("_m.after"))
    rows = rows.select(
        key, "pos", "idx", "kind", "tok", F.col("_m.open").alias("open"), H.unwrap_cdata(scope).alias("scope")
    )
    link_body = F.regexp_extract(
        "scope", r"(?is)<ac:(?:plain-text-)?link-body(?:\s[^>]*)?>(.*?)</ac:(?:plain-text-)?link-body\s*>", 1
    )
    macro_body = F.regexp_extract(
        "scope",
        r"(?is)<ac:(?:plain|rich)-text-body(?:\s[^>]*)?>(.*)</ac:(?:plain|rich)-text-body\s*>",
        1,
    )

    def parameter(name: str) -> Column:
        inner = F.regexp_extract(
            "scope", rf'(?is)<ac:parameter\s+(?:[^>]*\s)?(?:[\w.-]+:)?name="{name}"[^>]*>(.*?)</ac:parameter\s*>', 1
        )
        return H.tag_text(inner)

    is_macro, is_link = F.col("kind") == "macro", F.col("kind") == "link"
    name = F.when(is_macro, T.first_filled(H.attribute(F.col("open"), "name"), default="unknown"))
    href = F.when(F.col("kind") == "anchor", H.attribute(F.col("open"), "href"))
    tail = F.regexp_extract(F.split_part(href, F.lit("?"), F.lit(1)), r"([^/]*)/*\z", 1)
    page, url, space = (tag(F.col("scope"), f"ri:{t}") for t in ("page", "url", "space"))
    attachment = tag(F.col("scope"), "ri:attachment")
    rows = rows.withColumn("name", name).withColumn("label", F.when(is_link, H.tag_text(link_body)))
    link_kind = (
        F.when(page != "", "page").when(url != "", "url").when(attachment != "", "attachment").when(space != "", "space").otherwise("none")
    )
    rows = (
        rows.withColumn("link_kind", F.when(is_link, link_kind))
        .withColumn("diagram", F.when(F.col("name") == "drawio", parameter("diagramName")))
        .withColumn("badge", F.when(F.col("name") == "status", parameter("title")))
        .withColumn(
            "file",
            F.when(is_macro & (F.col("name") == "drawio"), F.col("diagram"))
            .when(F.col("kind") == "anchor", F.when(href.contains("/download/attachments/"), T.unquote(tail)))
            .when(is_link, T.first_filled(H.attribute(attachment, "filename"), F.col("label")))
            .otherwise(H.attribute(attachment, "filename")),
        )
        .withColumn("preview", F.concat(T.empty_to_null(F.col("diagram")), F.lit(".png")))
        .withColumn("title", F.when(F.col("link_kind") == "page", T.first_filled(H.attribute(page, "content-title"), F.col("label"), default="")))
        .withColumn("anchor", F.when(is_link, H.attribute(F.regexp_extract("tok", r"(?s)\A<[^>]*>", 0), "anchor")))
        .withColumn("url", F.when(F.col("link_kind") == "url", H.attribute(url, "value")))
        .withColumn("space", F.when(F.col("link_kind") == "space", T.first_filled(H.attribute(space, "space-key"), F.col("label"), default="")))
        .withColumn("body_text", F.when(is_macro, H.tag_text(F.when(macro_body != "", macro_body).otherwise(F.col("scope")), "\n")))
        .withColumn("link_text", F.when(is_link, H.tag_text(F.col("scope"))))
    )
    if pages is not None:
        rows = rows.join(pages.select(key, F.col("title").alias("page_title"), "uri_id"), key, "left")
    else:
        rows = rows.withColumn("page_title", F.lit(None).cast("string")).withColumn("uri_id", F.lit(None).cast("string"))
    return rows.drop("scope")


def resolve_tokens(
    bodies: DataFrame,
    attachments: DataFrame,
    titles: DataFrame,
    *,
    key: str = "id",
    body: str = "body",
    kinds: Sequence[str] = ("macro", "link", "image", "anchor"),
    base_url: str | None = None,
    knowledge_scheme: str = "knowledge",
    asset_scheme: str = "asset",
) -> DataFrame:
    """Token rows (key, pos, idx, kind, tok) with ``replacement`` and ``warning``.

    ``idx`` 0 is the token itself; higher ones are macros nested in it, which only
    contribute warnings. Tokens of other ``kinds`` are listed but left alone.
    """
    tokens = _pieces(bodies, key, body)
    pages = bodies.select(key, "title", "uri_id") if {"title", "uri_id"} <= set(bodies.columns) else None
    rows = _parts(tokens, key, pages)
    files = attachment_map(attachments)
    asset = files.select(F.col("page_id").alias(key), F.col("name").alias("file"), F.col("asset_id").alias("asset"))
    second = files.select(F.col("page_id").alias(key), F.col("name").alias("preview"), F.col("asset_id").alias("preview_asset"))
    address = titles.select("title", "address")
    rows = rows.join(asset, [key, "file"], "left").join(second, [key, "preview"], "left").join(address, "title", "left")

    uri = F.concat(F.lit(f"{asset_scheme}://"), "asset")
    preview_uri = F.concat(F.lit(f"{asset_scheme}://"), "preview_asset")
    name, label, body_text = F.col("name"), F.col("label"), F.col("body_text")
    # Macros
    shows_file = (name == "view-file") & F.col("asset").isNotNull()
    draws = (name == "drawio") & (F.col("asset").isNotNull() | F.col("preview_asset").isNotNull())
    supported = name.isin(CODE_MACROS + NOTE_MACROS + ["status"]) | shows_file | draws
    placeholder = F.concat(
        F.lit("<div>" + PLACEHOLDER), H.escape_text(name), F.lit("]"),
        F.when(body_text != "", F.concat(F.lit("<br/>"), H.escape_text(body_text))).otherwise(""),
        F.lit("</div>"),
    )
    drawing = F.concat(
        F.lit("<div>"),
        F.when(F.col("preview_asset").isNotNull(), _image(F.col("diagram"), preview_uri)).otherwise(""),
        F.when(F.col("asset").isNotNull(), _anchor(uri, F.concat(F.lit("Download "), "diagram"))).otherwise(""),
        F.lit("</div>"),
    )
    macro = (
        F.when(name.isin(CODE_MACROS), F.concat(F.lit("<pre><code>"), H.escape_text(body_text), F.lit("</code></pre>")))
        .when(
            name.isin(NOTE_MACROS),
            F.concat(F.lit("<blockquote>"), F.upper(name), F.lit(": "), H.escape_text(body_text), F.lit("</blockquote>")),
        )
        .when(
            name == "status",
            F.concat(F.lit("<span>[Status: "), H.escape_text(T.first_filled(F.col("badge"), body_text, default="Status")), F.lit("]</span>")),
        )
        .when(shows_file, _anchor(uri, F.col("file")))
        .when(draws, drawing)
        .otherwise(placeholder)
    )
    # Links, by priority page, url, attachment, space, self, none
    target = F.col("address")
    with_anchor = F.when(F.col("anchor") != "", F.concat(target, F.lit("#"), "anchor")).otherwise(target)
    space_url = F.lit("")
    if base_url:
        space_url = F.when(F.col("space") != "", F.concat(F.lit(base_url.rstrip("/") + "/wiki/spaces/"), "space")).otherwise("")
    is_self = (
        (F.coalesce("page_title", F.lit("")) != "") & (label != "")
        & F.endswith(T.fold(F.col("page_title")), T.fold(label))
    )
    self_uri = F.concat(F.lit(f"{knowledge_scheme}://"), "uri_id")
    kind = F.col("link_kind")
    link = (
        F.when(kind == "page", _anchor(F.coalesce(with_anchor, F.lit("")), T.first_filled(label, F.col("title"), default="")))
        .when(kind == "url", _anchor(F.col("url"), T.first_filled(label, F.col("url"), default="")))
        .when(kind == "attachment", _anchor(F.coalesce(uri, F.lit("")), T.first_filled(label, F.col("file"), default="")))
        .when(kind == "space", _anchor(space_url, T.first_filled(label, F.col("space"), default="")))
        .when(is_self, _anchor(self_uri, label))
        .otherwise(_anchor(F.lit(""), T.first_filled(label, F.col("link_text"), default="")))
    )
    link_warning = (
        F.when((kind == "page") & target.isNull(), F.concat(F.lit(WARN_PAGE), "title"))
        .when((kind == "attachment") & F.col("asset").isNull(), F.concat(F.lit(WARN_ATTACHMENT), F.coalesce("file", F.lit(""))))
        .when((kind == "space") & (space_url == ""), F.concat(F.lit(WARN_SPACE), "space"))
        .when((kind == "none") & ~F.coalesce(is_self, F.lit(False)), F.lit(WARN_LINK))
    )
    # Images and download addresses
    image = _image(T.first_filled(F.col("file"), default=IMAGE_ALT), F.coalesce(uri, F.lit("")))
    anchor = F.when(F.col("asset").isNotNull(), H.set_attribute(F.col("tok"), "href", uri))
    what = F.col("kind")
    replacement = F.when(what == "macro", macro).when(what == "link", link).when(what == "image", image).otherwise(anchor)
    warning = (
        F.when((what == "macro") & ~F.coalesce(supported, F.lit(False)), F.concat(F.lit(WARN_MACRO), name))
        .when(what == "link", link_warning)
        .when((what == "image") & F.col("asset").isNull(), F.concat(F.lit(WARN_IMAGE), T.first_filled(F.col("file"), default="<unknown>")))
    )
    wanted = what.isin(list(kinds))
    return rows.select(
        key, "pos", "idx", "kind", "tok",
        F.when(wanted, replacement).alias("replacement"),
        F.when(wanted, warning).alias("warning"),
    )


STAGE = {"macro": 0, "link": 1, "image": 2, "anchor": 3}


def warnings(resolved: DataFrame, key: str = "id") -> DataFrame:
    """Distinct warnings per document with the place of their first occurrence."""
    stage = F.create_map(*[F.lit(x) for kv in STAGE.items() for x in kv])
    place = F.struct(F.element_at(stage, F.col("kind")).alias("stage"), "pos", "idx")
    return (
        resolved.filter("warning IS NOT NULL")
        .groupBy(key, "warning")
        .agg(F.min(place).alias("place"))
    )


def convert(bodies: DataFrame, attachments: DataFrame, titles: DataFrame, *, key: str = "id", body: str = "body", **options) -> DataFrame:
    """Bodies with every token resolved, plus ``warnings`` in order of first occurrence."""
    return rebuilt(bodies, replacements(bodies, attachments, titles, key=key, body=body, **options), key=key, body=body)


def replacements(bodies: DataFrame, attachments: DataFrame, titles: DataFrame, *, key: str = "id", body: str = "body", **options) -> DataFrame:
    """(key, _new, _warned) of every document that has tokens: what stands in their places, and warnings."""
    resolved = resolve_tokens(bodies, attachments, titles, key=key, body=body, **options)
    stage = F.create_map(*[F.lit(x) for kv in STAGE.items() for x in kv])
    # Only one document's own tokens meet here; their number is bounded by its text.
    return resolved.groupBy(key).agg(
        F.array_sort(
            F.collect_list(F.when(F.col("idx") == 0, F.struct("pos", F.coalesce("replacement", "tok").alias("new"))))
        ).alias("_new"),
        F.array_sort(
            F.collect_list(
                F.when(
                    F.col("warning").isNotNull(),
                    F.struct(F.element_at(stage, F.col("kind")).alias("stage"), "pos", "idx", "warning"),
                )
            )
        ).alias("_warned"),
    )


def rebuilt(bodies: DataFrame, per_doc: DataFrame, *, key: str = "id", body: str = "body") -> DataFrame:
    """Bodies with their tokens replaced (:func:`replacements`), plus ``warnings``."""
    texts = F.filter(cut(F.col(body)), lambda _, i: i % 2 == 0)
    whole = H.interleave(texts, F.col("_new.new"))
    return (
        bodies.join(per_doc, key, "left")
        .withColumn(body, F.when(F.col("_new").isNull(), F.col(body)).otherwise(whole))
        .withColumn(
            "warnings",
            F.coalesce(F.array_distinct(F.col("_warned.warning")), F.array().cast("array<string>")),
        )
        .drop("_new", "_warned")
    )
