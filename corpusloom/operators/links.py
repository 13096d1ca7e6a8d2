"""Link inventory, link classes, block table and reference rewriting."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import text as T

# Default link classes in order, first match wins: (class, predicate over host and path).
# Hosts are parameters of a site; these are neutral ones.
# Fixed values.
DOWNLOAD_EXTENSIONS = ["pdf", "zip", "exe", "dmg", "pkg", "csv", "xlsx", "docx"]


def link_classes(
    href: Column,
    *,
    file_share_hosts: Sequence[str] = ("dropbox.com",),
    wiki_hosts: Sequence[str] = ("atlassian.net", "confluence"),
    video_hosts: Sequence[str] = ("youtube.com", "youtu.be"),
    help_host: str = "help.example.com",
    site_host: str = "example.com",
) -> Column:
    """Class of a link by host and path; the host lists are site settings."""
    host, path = T.url_host(href), F.lower(T.url_path(href))

    def on(hosts: Sequence[str]) -> Column:
        test = F.lit(False)
        for name in hosts:
            test = test | host.contains(name)
        return test

    return (
        F.when(href == "", "empty")
        .when(on(file_share_hosts), "dropbox")
        .when(on(wiki_hosts), "confluence")
        .when(on(video_hosts), "video")
        .when(host.contains(help_host) & path.contains("/s/article/"), "article")
        .when(host.contains(help_host) & path.contains("/s/topic/"), "topic")
        .when(host.contains(site_host), "site")
        .when(path.rlike(r"\.(?:" + "|".join(DOWNLOAD_EXTENSIONS) + r")\z"), "download")
        .when(host != "", "external")
        .otherwise("relative_or_internal")
    )


def tokens(
    df: DataFrame, key: str, text: Column, pattern: str, carry: Sequence[str] = ()
) -> DataFrame:
    """One row per match of ``pattern`` in a document: key, 1-based pos, tok."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # The outer form keeps the optimizer from running the regex again in a filter.
    rows = df.select(key, *carry, F.posexplode_outer(found).alias("pos", "tok"))
    return rows.filter("pos IS NOT NULL").withColumn("pos", (F.col("pos") + 1).cast("bigint"))


def link_inventory(df: DataFrame, key: str, html: str, carry: Sequence[str] = ()) -> DataFrame:
    """Every anchor of every document: href ('' when absent) and visible text; end tags may be missing."""
    markup = H.drop_noise(F.col(html))
    opening = F.regexp_extract_all(markup, F.lit(H.ANCHOR_OPEN), F.lit(0))
    behind = F.slice(F.split(markup, H.ANCHOR_OPEN, -1), 2, 1 << 30)
    rows = df.select(key, *carry, F.posexplode_outer(F.arrays_zip(opening.alias("tag"), behind.alias("rest"))).alias("pos", "_a"))
    return rows.filter("pos IS NOT NULL").select(
        key,
        *carry,
        (F.col("pos") + 1).cast("bigint").alias("pos"),
        T.strip(H.attribute(F.col("_a.tag"), "href")).alias("href"),
        H.tag_text(H.anchor_content(F.col("_a.rest"))).alias("label"),
    )


def targets(df: DataFrame, key: str, html: Column, carry: Sequence[str] = ()) -> DataFrame:
    """Address of every anchor and image in document order: pos, tok, tag, value."""
    rows = tokens(df, key, html, H.ANCHOR_OR_IMAGE_OPEN, carry)
    tag = F.lower(F.regexp_extract("tok", r"\A<([a-zA-Z]+)", 1))
    value = F.when(tag == "img", H.attribute(F.col("tok"), "src")).otherwise(
        H.attribute(F.col("tok"), "href")
    )
    return rows.withColumn("tag", tag).withColumn("value", value)


def block_table(df: DataFrame, key: str, html: str) -> DataFrame:
    """Every visible run of text of the body in exactly one block: key, pos, tag, text.

    A block lies between two block borders; its tag is the innermost block element that is open there. Depth is a
    running sum over the containers' tags; at one depth the last opening counts, so a missing end tag of a
    paragraph or list item ends with the next border and loses nothing. Text directly in the body has tag ``body``.
    """
    borders, runs = H.block_runs(F.col(html))
    both = F.arrays_zip(F.concat(F.array(F.lit("")), borders).alias("border"), runs.alias("run"))
    rows = df.select(key, F.posexplode(both).alias("at", "_b")).select(key, "at", "_b.border", "_b.run")
    name = F.lower(F.regexp_extract("border", r"\A</?([a-zA-Z0-9]+)", 1))
    close = F.col("border").startswith("</")
    rows = rows.select(key, "at", H.run_text(F.col("run")).alias("text"), name.alias("name"), close.alias("close"))
    holds = F.col("name").isin(H.CONTAINERS)
    document = Window.partitionBy(key).orderBy("at")
    move = F.when(holds & F.col("close"), -1).when(holds, 1).otherwise(0)
    rows = rows.withColumn("depth", F.sum(move).over(document))
    level = Window.partitionBy(key, "depth").orderBy("at")
    opened = F.when(~F.col("close") & (F.col("name") != ""), F.col("name"))
    container = F.last(F.when(holds & ~F.col("close"), F.col("name")), True).over(level)
    # The last tag of this depth, where a paragraph never reaches beyond its next border.
    kept = F.when(F.col("name").isin(H.LEAVES) & (F.col("name") != "p"), F.when(F.col("close"), F.lit("")).otherwise(F.col("name")))
    leaf = F.last(F.when(holds & ~F.col("close"), F.lit("")).otherwise(kept), True).over(level)
    inner = F.when(leaf != "", leaf).otherwise(F.coalesce(container, F.lit("body")))
    tag = F.when(F.col("name").isin(H.LEAVES) & ~F.col("close"), opened).otherwise(inner)
    rows = rows.withColumn("tag", tag).withColumn("pos", F.sum(F.when(F.col("text") != "", 1).otherwise(0)).over(document))
    return rows.filter("text <> ''").select(key, F.col("pos").cast("bigint"), "tag", "text")


def link_type_counts(links: DataFrame, kind: str = "type") -> DataFrame:
    return links.groupBy(kind).agg(F.count("*").alias("links")).orderBy(kind)


def article_urls(links: DataFrame, href: Column, marker: str, base: Column) -> DataFrame:
    """Distinct canonical addresses of article links, sorted."""
    full = F.when(T.is_absolute(href), href).otherwise(T.join_base(base, href))
    found = links.select(full.alias("url")).filter(F.col("url").contains(marker))
    return found.select(T.canonical_article_url(F.col("url")).alias("url")).distinct().orderBy("url")


def rewrite(
    df: DataFrame,
    key: str,
    text: str,
    pattern: str,
    resolve: Callable[[DataFrame], DataFrame],
    out: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Replace tokens of whole documents by looked-up texts.

    ``resolve`` receives rows (key, pos, tok) and must return them with a
    ``replacement`` column; null leaves a token untouched. Lookups therefore are
    ordinary joins on the exploded token rows: a hot target is split by the
    adaptive skew join, and only one document's own tokens are gathered again.
    Returns the documents with ``out`` and the resolved token rows.
    """
    resolved = resolve(tokens(df, key, F.col(text), pattern))
    pieces = (
        resolved.select(key, "pos", F.coalesce("replacement", "tok").alias("new"))
        .groupBy(key)
        .agg(F.array_sort(F.collect_list(F.struct("pos", "new"))).alias("_new"))
    )
    texts = F.filter(H.pieces(F.col(text), pattern), lambda _, i: i % 2 == 0)
    rebuilt = H.interleave(texts, F.col("_new.new"))
    done = (
        df.join(pieces, key, "left")
        .withColumn(out or text, F.when(F.col("_new").isNull(), F.col(text)).otherwise(rebuilt))
        .drop("_new")
    )
    return done, resolved
