"""End-to-end jobs over the derived views."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import bundle as U
from ..operators import dedupe as D
from ..plans import jobs as J
from . import packaging as K
from . import publishing as B
from . import sql as S
from .media import FETCH_SQL
from .registry import Registry

reg = Registry()
QUERIES, ORACLES = reg.queries, reg.oracles


@reg.query(
    "review_job",
    f"""WITH {K.REVIEW_SQL} SELECT (SELECT count(*) FROM c) AS article_count, count(*) AS finding_count, count(DISTINCT article_id) AS articles_with_findings, count(*) = 0 AS passed FROM findings""",
)
def review_job(v):
    articles, warnings, refs, rels = K.review_inputs(v)
    records = K.knowledge(v)
    objects = records.select(F.to_json(F.struct(*records.columns)).alias("json"))
    return J.review(objects, articles, warnings, refs, v.v_asset, rels)[0]


@reg.query(
    "publish_job",
    f"""WITH {B.BUNDLE_SQL}, n AS (SELECT (SELECT count(*) FROM out) AS a, (SELECT count(*) FROM {{v_asset}} WHERE id IN (SELECT asset_id FROM {{v_ref}})) AS s,
          (SELECT count(*) FILTER (kid IS NULL) + count(*) FILTER (sid IS NULL) FROM out) AS i)
        SELECT '1.0' AS schema_version, 'desk' AS publisher, 'wiki' AS source_connector, a AS article_count, s AS asset_count, i AS issue_count,
          '# HTML import bundle' || chr(10) || chr(10) || '- Articles: ' || a || ' (articles/)' || chr(10) || '- Assets: ' || s || ' (assets/)' || chr(10) || '- Issues: ' || i || chr(10) || chr(10)
          || 'Keep articles/ and assets/ together so that relative links stay valid.' || chr(10) AS text FROM n""",
)
def publish_job(v):
    about = B.articles(v).select("id", "slug", "source_url")
    bodies = v.v_article.withColumn("body", F.expr(B.BODY_SQL)).select("id", "title", "body").join(about, "id")
    paths = B.articles(v).select(F.col("id").alias("target_id"), T.article_path(F.col("slug"), F.col("id")).alias("path"))
    name = T.published_asset_name(F.col("id"), F.col("filename"))
    assets = v.v_asset.select("id", F.concat(F.lit("assets/"), name).alias("path"), "sha256", "size_bytes")
    asset_paths = v.v_asset.select(F.col("id").alias("target_id"), name.alias("path"))
    refs = v.v_ref.join(v.v_asset.select(F.col("id").alias("asset_id")), "asset_id", "left_semi")
    entries = J.publish_bundle(bodies, paths, assets, asset_paths, refs)[1]
    header = U.manifest_header(entries, "desk", "wiki")
    return header.crossJoin(U.instructions(header))  # one row each


@reg.query("import_job", B.ORACLES_IMPORT)
def import_job(v):
    return J.import_dry_run(B.articles(v), v.v_state, B.remotes(v), v.v_article)[1]


LINKS_SQL = """CASE WHEN href LIKE '/d%' THEN 'dropbox' WHEN href LIKE '/t%' THEN 'video' WHEN href LIKE '/s%' THEN 'external' ELSE 'relative_or_internal' END"""


@reg.query("link_census_job", f"WITH {S.ANCHORS} SELECT {LINKS_SQL} AS type, count(*) AS links FROM anchors GROUP BY 1")
def link_census_job(v):
    html = F.col("html")
    for letter, address in (("d", "https://www.dropbox.com/s"), ("t", "https://youtu.be"), ("s", "http://other.org")):
        html = F.regexp_replace(html, f'<a href="/{letter}', f'<a href="{address}/{letter}')
    packages = v.pages.select(F.col("page_id").cast("string").alias("folder"), html.alias("html"), F.lit("").alias("title"), F.col("url").alias("source_url"))
    return J.link_census(packages)[1]


@reg.query("bucket_job", f"WITH {K.LOCAL_SQL} SELECT {K.SIZE_STATUS} AS status, count(*) AS items FROM local GROUP BY 1")
def bucket_job(v):
    categories = v.part.select(F.lower("p_type").alias("category")).distinct()
    return J.bucket_sync(K.files(v), K.remote_objects(v), categories)[2]


@reg.query(
    "media_job",
    f"""WITH last AS (SELECT page_id, max_by({FETCH_SQL}, event_id) AS status FROM {{v_fetch}} GROUP BY page_id)
        SELECT page_id AS attachment_id, status FROM last WHERE page_id % 3 <> 0""",
)
def media_job(v):
    """A third of the items is held already; the last response decides on the others."""
    listing = v.pages.select(F.col("page_id").alias("attachment_id"))
    held = listing.where("attachment_id % 3 = 0").withColumn("status", F.lit("downloaded"))
    fields = ["http_status", "content_type", "body_text", "error_class", "content_length", "existing_size"]
    last = D.last_wins(v.v_fetch.select(F.col("page_id").alias("attachment_id"), "event_id", *fields), "attachment_id", "event_id")
    return J.media_run(listing, held, last).select("attachment_id", "status")
