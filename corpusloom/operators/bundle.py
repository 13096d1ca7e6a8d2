"""HTML bundle documents and publisher manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import text as T
from ..schemas import SCHEMA_VERSION


def bundle_documents(articles: DataFrame) -> DataFrame:
    """(id, title, path, html, sha256) of articles with id, title, slug, body, source_url."""
    title = H.escape(F.col("title"))
    footer = F.when(
        F.coalesce("source_url", F.lit("")) != "",
        F.concat(F.lit('  <p class="source"><a href="'), H.escape(F.col("source_url")), F.lit('">Original page</a></p>\n')),
    ).otherwise("")
    html = F.concat(
        F.lit('<!doctype html>\n<html lang="en">\n<head>\n  <meta charset="utf-8">\n  <meta name="article-id" content="'),
        "id", F.lit('">\n  <title>'), title, F.lit("</title>\n</head>\n<body>\n  <h1>"), title, F.lit("</h1>\n  "),
        "body", F.lit("\n"), footer, F.lit("</body>\n</html>\n"),
    )
    rows = articles.select("id", "title", F.concat(F.lit("articles/"), T.article_path(F.col("slug"), F.col("id"))).alias("path"), html.alias("html"))
    return rows.withColumn("sha256", T.sha256_text(F.col("html")))


def publisher_manifest(documents: DataFrame, assets: DataFrame, issues: DataFrame) -> DataFrame:
    """Manifest entries as one long table: section, id, title (of articles), path, sha256, size_bytes, issue.

    The nested lists of a one-row manifest grow with the corpus, so they stay rows;
    :func:`manifest_header` gives the counts.
    """
    none = F.lit(None)
    untitled = none.cast("string").alias("title")
    return (
        documents.select(F.lit("article").alias("section"), "id", "title", "path", "sha256", none.cast("bigint").alias("size_bytes"), none.cast("string").alias("issue"))
        .unionByName(assets.select(F.lit("asset").alias("section"), "id", untitled, "path", "sha256", "size_bytes", none.cast("string").alias("issue")))
        .unionByName(
            issues.select(F.lit("issue").alias("section"), "id", untitled, none.cast("string").alias("path"), none.cast("string").alias("sha256"), none.cast("bigint").alias("size_bytes"), "issue")
        )
    )


def manifest_header(entries: DataFrame, publisher: str, connector: str) -> DataFrame:
    count = lambda s: F.count_if(F.col("section") == s)
    return entries.agg(
        F.lit(SCHEMA_VERSION).alias("schema_version"), F.lit(publisher).alias("publisher"), F.lit(connector).alias("source_connector"),
        count("article").alias("article_count"), count("asset").alias("asset_count"), count("issue").alias("issue_count"),
    )


def instructions(header: DataFrame) -> DataFrame:
    """Short import notes made from the manifest counts."""
    return header.select(
        F.format_string(
            "# HTML import bundle\n\n- Articles: %d (articles/)\n- Assets: %d (assets/)\n- Issues: %d\n\n"
            "Keep articles/ and assets/ together so that relative links stay valid.\n",
            "article_count", "asset_count", "issue_count",
        ).alias("text")
    )
