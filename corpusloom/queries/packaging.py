"""Mirror, packaging, review and storage queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import audit as A
from ..operators import packaging as P
from ..operators import storage as B
from ..operators import dedupe as D
from ..session import staged
from . import sql as S
from .links import CONVERTED_SQL, FROM_MARKUP, TITLES_SQL, WARN_SQL, converted
from .registry import Registry

reg = Registry()
QUERIES, ORACLES = reg.queries, reg.oracles

INVENTORY_SQL = """SELECT t.id AS "Page ID", t.title AS "Title", coalesce(t.parent_id, '') AS "Parent ID", t.status AS "Status", '' AS "Created", '' AS "Updated",
  cast(t.seq AS varchar) AS "Version", '' AS "Author ID", t.kind AS "Space ID", CASE WHEN t.kind = 'region' THEN '/x/' || t.id ELSE 'https://wiki.example.com/x/' || t.id END AS "Source URL",
  'pages/' || t.id || '/body.storage.html' AS "Body Path", coalesce(a.n, 0) AS "Attachment Count", 'mirrored' AS "Mirror Status", sha256(t.title || t.id) AS "Content SHA256"
  FROM {v_tree} t LEFT JOIN (SELECT page_id, count(*) AS n FROM {v_attachment} GROUP BY page_id) a ON a.page_id = t.id"""


def tree_pages(v):
    none = F.lit(None).cast("string")
    return v.v_tree.select(
        "id", "title", "parent_id", "status", none.alias("created_at"), none.alias("updated_at"),
        F.col("seq").alias("version"), none.alias("author_id"), F.col("kind").alias("space_id"),
        F.when(F.col("kind") == "region", F.lit("")).otherwise("https://wiki.example.com").alias("base"),
        F.concat(F.lit("/x/"), "id").alias("webui"), F.concat("title", "id").alias("body"),
    )


@reg.query("inventory_pages", INVENTORY_SQL)
def inventory_pages(v):
    return P.inventory(tree_pages(v), v.v_attachment.select("page_id"))


MIRROR_SQL = """listing AS (SELECT page_id, CASE WHEN max(version) > 97 THEN '' ELSE cast(max(version) AS varchar) END AS version FROM {v_snapshot} GROUP BY page_id),
 held AS (SELECT page_id, cast(max_by(version, seq) AS varchar) AS version, max_by(status, seq) <> 'failed' AS has_body FROM {v_snapshot} WHERE version > 90 GROUP BY page_id)"""


@reg.query("mirror_plan", f"WITH {MIRROR_SQL} SELECT l.page_id, l.version, CASE WHEN l.version <> '' AND l.version = h.version AND h.has_body THEN 'resumed' ELSE 'mirrored' END AS action FROM listing l LEFT JOIN held h ON h.page_id = l.page_id")
def mirror_plan(v):
    s = v.v_snapshot
    top = F.max("version")
    listing = s.groupBy("page_id").agg(F.when(top > 97, F.lit("")).otherwise(top.cast("string")).alias("version"))
    last = D.last_wins(s.filter("version > 90").select("page_id", "version", "status", "seq"), "page_id", "seq")
    held = last.select("page_id", F.col("version").cast("string").alias("version"), (F.col("status") != "failed").alias("has_body"))
    return P.mirror_plan(listing, held).select("page_id", "version", "action")


ATT_SQL = """SELECT a.id || '-' || cast(a.size_bytes AS varchar) AS id, CASE WHEN a.version <= 3 AND (a.status = 'available' OR a.version = 1) THEN 'available' WHEN a.status = 'unavailable' THEN 'unavailable' ELSE 'download' END AS action FROM {v_attachment} a"""


@reg.query("attachment_mirror_plan", ATT_SQL)
def attachment_mirror_plan(v):
    # Local files exist for the first versions; one flag makes their size differ.
    key = F.concat("id", F.lit("-"), F.col("size_bytes").cast("string"))
    base = v.v_attachment.select(
        "page_id", key.alias("id"), "title", F.when(F.col("version") > 1, F.col("size_bytes")).alias("expected_size"),
        F.when(F.col("status") != "unavailable", F.lit("/download/x")).alias("link"), "status", "version", "size_bytes",
    )
    local = base.filter("version <= 3").groupBy(
        F.concat(F.lit("attachments/"), "id", F.lit("-"), "title").alias("local_path")
    ).agg(F.max(F.col("size_bytes") + F.when(F.col("status") == "available", 0).otherwise(1)).alias("local_size"))
    return P.attachment_plan(base, local).select("id", "action")


@reg.query(
    "mirror_failures",
    """SELECT page_id, id AS attachment_id, CASE WHEN status = 'failed' THEN 'HTTP 500' ELSE 'Attachment unavailable' END AS message, 'AttachmentDownloadError' AS type FROM {v_attachment} WHERE status <> 'available'
       UNION ALL SELECT page_id, NULL, 'event ' || cast(seq AS varchar), 'HTTPError' FROM {v_snapshot} WHERE status = 'failed'""",
)
def mirror_failures(v):
    files = v.v_attachment.withColumn("error", F.when(F.col("status") == "failed", F.lit("HTTP 500")))
    errors = v.v_snapshot.filter("status = 'failed'").select(
        "page_id", F.concat(F.lit("event "), F.col("seq").cast("string")).alias("message"), F.lit("HTTPError").alias("type")
    )
    return P.mirror_failures(files, errors)


@reg.query("mirror_metadata", "SELECT a.id AS page_id, '2026-01-01' AS mirrored_at, sha256(a.body) AS source_checksum, coalesce(n, 0) AS attachment_count FROM {v_article} a LEFT JOIN (SELECT page_id, count(*) AS n FROM {v_doc_attachment} GROUP BY page_id) d ON d.page_id = a.id")
def mirror_metadata(v):
    pages = v.v_article.select(F.col("id").alias("page_id"), "body", F.lit("2026-01-01").alias("mirrored_at"))
    return P.mirror_metadata(pages, v.v_doc_attachment)


@reg.query(
    "crawl_report",
    """SELECT count(*) AS requested_pages, count(*) FILTER (status = 'mirrored') AS mirrored_pages, count(*) FILTER (status = 'resumed') AS resumed_pages,
       cast(sum(CASE WHEN event_type = 'view' THEN version ELSE 0 END) AS bigint) AS attachments_downloaded, cast(sum(CASE WHEN event_type = 'click' THEN version ELSE 0 END) AS bigint) AS attachments_resumed,
       count(*) FILTER (status = 'failed') AS failure_count, count(*) FILTER (status = 'failed') = 0 AS successful FROM {v_snapshot}""",
)
def crawl_report(v):
    kind = F.col("event_type")
    return P.crawl_report(
        v.v_snapshot.select(
            "status", F.when(kind == "view", F.col("version")).otherwise(0).alias("downloaded"),
            F.when(kind == "click", F.col("version")).otherwise(0).alias("resumed_files"),
            F.when(F.col("status") == "failed", 1).otherwise(0).alias("failures"),
        )
    )


def assets(v):
    rows = v.v_attachment.select(
        "page_id", "id", F.when(F.col("version") > 2, F.col("title")).alias("title"), T.media_type(F.col("title"), None).alias("media_type"),
        F.when(F.col("version") > 4, F.col("size_bytes")).otherwise(0).alias("size_bytes"), F.col("size_bytes").alias("file_size"),
        "sha256", F.concat(F.lit("attachments/"), "id", F.lit("-"), "title").alias("local_path"), F.lit("").alias("url"), "status",
    )
    return P.package_assets(rows, "wiki")


@reg.query(
    "package_assets",
    """SELECT 'wiki-attachment-' || id AS id, CASE WHEN version > 2 THEN title ELSE id || '-' || title END AS filename,
       CASE regexp_extract(title, '\\.([^.]+)$', 1) WHEN 'png' THEN 'image/png' WHEN 'jpg' THEN 'image/jpeg' WHEN 'webp' THEN 'image/webp' WHEN 'pdf' THEN 'application/pdf' WHEN 'zip' THEN 'application/zip' ELSE 'application/octet-stream' END AS media_type,
       size_bytes, sha256, 'pages/' || page_id || '/attachments/' || id || '-' || title AS local_path, page_id AS container FROM {v_attachment} WHERE status = 'available'""",
)
def package_assets(v):
    return assets(v).select("id", "filename", "media_type", "size_bytes", "sha256", "local_path", F.col("source.container_external_id").alias("container"))


def knowledge(v):
    source = v.v_markup.select("id", "lang", "space", "seq", F.concat("text_html", "link_html", "image_html", "anchor_html", "macro_html").alias("source_body"))
    pages = converted(v).join(source, "id").withColumns(
        {"status": F.when(F.col("lang") == "en", "current").otherwise("draft"), "url": F.lit(""), "parent_id": F.lit(""),
         "revision": F.col("seq").cast("string"), "created_at": F.lit("2026-01-01T00:00:00Z"), "updated_at": F.lit("")}
    )
    return P.package_knowledge(pages, "wiki", "2026-01-02T00:00:00+00:00")


@reg.query(
    "package_knowledge",
    f"""WITH {TITLES_SQL}, c AS (SELECT m.*, {CONVERTED_SQL} AS out, m.text_html || m.link_html || m.image_html || m.anchor_html || m.macro_html AS src {FROM_MARKUP})
      SELECT 'wiki-' || id AS id, CASE WHEN title = '' THEN 'Page ' || id ELSE title END AS title, {S.slug('title', 'id')} AS slug, CASE WHEN lang = 'en' THEN 'published' ELSE 'draft' END AS status,
        out AS body, space, cast(seq AS varchar) AS revision, '2026-01-01T00:00:00+00:00' AS created_at, sha256(src) AS source_checksum, sha256(out) AS content_checksum FROM c""",
)
def package_knowledge(v):
    return knowledge(v).select(
        "id", "title", "slug", "status", F.col("content.body").alias("body"), F.col("source.space").alias("space"), F.col("source.revision").alias("revision"),
        F.col("timestamps.created_at").alias("created_at"), F.col("checksums.source").alias("source_checksum"), F.col("checksums.content").alias("content_checksum"),
    )


FROM_INVENTORY_SQL = f"SELECT 'wiki-' || id AS id, title, {S.slug('title', 'id')} AS slug, CASE lower(status) WHEN 'current' THEN 'published' WHEN 'draft' THEN 'draft' WHEN 'archived' THEN 'archived' ELSE 'review' END AS status, parent_id AS parent, cast(seq AS varchar) AS revision FROM {{v_tree}}"


def from_inventory(v):
    rows = P.inventory(tree_pages(v), v.v_attachment.select("page_id"))
    return P.package_inventory(rows, "wiki", "2026-01-02T00:00:00+00:00").select(
        "id", "title", "slug", "status", F.col("source.parent_external_id").alias("parent"), F.col("source.revision").alias("revision")
    )


@reg.query("package_from_inventory", FROM_INVENTORY_SQL)
def package_from_inventory(v):
    return from_inventory(v)


@reg.query("package_fallback", FROM_INVENTORY_SQL)
def package_fallback(v):
    # No page is mirrored (no such status), so the inventory supplies everything.
    mirrored = from_inventory(v).filter("status = 'mirrored'")
    return P.with_fallback(mirrored, from_inventory(v))


MANIFEST_SQL = """WITH RECURSIVE scope AS (SELECT id, title FROM {v_tree} WHERE id = 'region-1' UNION ALL SELECT t.id, t.title FROM {v_tree} t JOIN scope s ON t.parent_id = s.id WHERE t.id <> 'region-1'),
 failed AS (SELECT count(*) AS n FROM {v_attachment} a WHERE a.status <> 'available' AND a.page_id IN (SELECT id FROM scope))
 SELECT '1.0' AS schema_version, 'wiki' AS connector, 'region-1' AS root_page_id, (SELECT count(*) FROM scope WHERE title <> '') AS object_count,
  (SELECT count(*) FROM {v_attachment} a WHERE a.status = 'available' AND a.page_id IN (SELECT id FROM scope)) AS asset_count, n AS failure_count, n = 0 AS crawl_successful FROM failed"""


@reg.query("package_manifest", MANIFEST_SQL)
def package_manifest(v):
    """Flagship: scope, inventory records, validation gate, assets, failures, manifest."""
    from ..plans.crawl import crawl_to_manifest

    return crawl_to_manifest(v.v_tree, tree_pages(v), v.v_attachment, "region-1", "wiki")


# ---- the whole crawl: documents as pages, each below the one with an eighth of its number ---------------------------

CRAWL_SQL = """tree AS (SELECT id, seq, lang, space FROM {v_markup}),
 scope AS (SELECT id, seq, lang, space FROM tree WHERE seq = 0 UNION ALL SELECT t.id, t.seq, t.lang, t.space FROM tree t JOIN scope s ON t.seq > 0 AND t.seq // 8 = s.seq),
 fine AS (SELECT * FROM scope WHERE space <> 'src9'),
 files AS (SELECT a.* FROM {v_doc_attachment} a JOIN scope ON scope.id = a.page_id)"""


def crawled(v):
    """Runs the job into a fresh folder; one source of pages cannot be read, one in three is mirrored already."""
    from ..plans.crawl import crawl
    from ..session import scratch_path
    from .links import WIKI

    none = F.lit(None).cast("string")
    pages = v.v_markup.select(
        "id", F.when(F.col("seq") > 0, F.concat(F.lit("doc-"), F.floor(F.col("seq") / 8).cast("string"))).alias("parent_id"), "title", F.col("seq").alias("position"),
        F.when(F.col("lang") == "en", "current").otherwise("draft").alias("status"), F.concat("text_html", "link_html", "image_html", "anchor_html", "macro_html").alias("body"),
        F.col("seq").cast("string").alias("version"), F.lit("").alias("url"), "space", F.concat(F.lit("/x/"), "id").alias("webui"), F.lit(WIKI).alias("base"),
        F.lit("2026-01-01T00:00:00Z").alias("created_at"), F.lit("").alias("updated_at"), none.alias("author_id"),
    )
    files = v.v_doc_attachment.select(
        "page_id", "id", "title", "filename", "seq", "status", F.lit("").alias("error"), F.concat(F.lit("attachments/"), "id").alias("local_path"), none.alias("media_type"),
        F.lit(1).cast("bigint").alias("size_bytes"), F.lit(1).cast("bigint").alias("file_size"), T.sha256_text(F.col("id")).alias("sha256"), F.lit("").alias("url"),
    )
    held = v.v_markup.where("seq % 3 = 0").select(F.col("id").alias("page_id"), F.col("seq").cast("string").alias("version"), F.lit(True).alias("has_body"))
    errors = v.v_markup.where("space = 'src9'").select(F.col("id").alias("page_id"), F.lit("HTTP 500").alias("message"), F.lit("HTTPError").alias("type"))
    listed = v.nation.select(F.col("n_name").alias("title"), F.concat(F.lit(f"{WIKI}/nation-"), F.col("n_nationkey").cast("string")).alias("url"))
    out = scratch_path(v.spark, "crawl-job")
    report = crawl(
        pages, files, held, listed, out, root_id="doc-0", space_id="docs", connector="wiki", base_url=WIKI,
        generated_at="2026-01-02T00:00:00+00:00", page_errors=errors,
    )
    return out, report


@reg.query(
    "crawl_job",
    f"""WITH RECURSIVE {CRAWL_SQL} SELECT '1.0' AS schema_version, 'wiki' AS connector, '2026-01-02T00:00:00+00:00' AS generated_at, 'doc-0' AS root_page_id, 'docs' AS space_id,
        (SELECT count(*) FROM fine) AS object_count, (SELECT count(*) FROM files WHERE status = 'available') AS asset_count, f.n = 0 AS crawl_successful,
        count(*) AS requested_pages, count(*) FILTER (seq % 3 <> 0) AS mirrored_pages, count(*) FILTER (seq % 3 = 0) AS resumed_pages, f.n AS failure_count
        FROM scope, (SELECT (SELECT count(*) FROM files WHERE status = 'failed') + (SELECT count(*) FROM scope WHERE space = 'src9') AS n) f GROUP BY f.n""",
)
def crawl_job(v):
    return crawled(v)[1]


@reg.query(
    "crawl_manifest",
    f"""WITH RECURSIVE {CRAWL_SQL} SELECT 'object' AS kind, 'wiki-' || id AS id FROM fine UNION ALL SELECT 'asset', 'wiki-attachment-' || id FROM files WHERE status = 'available'""",
)
def crawl_manifest(v):
    parts = v.spark.read.json(f"{crawled(v)[0]}/manifest").select("json")
    lists = parts.select(F.from_json("json", "objects array<string>, assets array<string>").alias("m"))
    return lists.select(F.explode("m.objects").alias("id")).select(F.lit("object").alias("kind"), "id").unionByName(
        lists.select(F.explode("m.assets").alias("id")).select(F.lit("asset").alias("kind"), "id")
    )


@reg.query(
    "crawl_members",
    f"""WITH RECURSIVE {CRAWL_SQL}, edges AS (SELECT page_id AS page, 'asset' AS kind, 'wiki-attachment-' || id AS target_id, 0 AS rank FROM files WHERE status = 'available'
          UNION ALL SELECT c.id, 'parent', 'wiki-' || p.id, 1 FROM fine c JOIN fine p ON c.seq > 0 AND c.seq // 8 = p.seq
          UNION ALL SELECT p.id, 'child', 'wiki-' || c.id, 2 FROM fine c JOIN fine p ON c.seq > 0 AND c.seq // 8 = p.seq)
        SELECT 'wiki-' || page AS id, kind, row_number() OVER (PARTITION BY page ORDER BY rank, kind, target_id) AS position, target_id FROM edges""",
)
def crawl_members(v):
    return v.spark.read.parquet(f"{crawled(v)[0]}/members")


# ---- review ---------------------------------------------------------------

REVIEW_SQL = f"""{TITLES_SQL}, {WARN_SQL}, c AS (SELECT m.id, m.title, {CONVERTED_SQL} AS body {FROM_MARKUP}),
 refs AS (SELECT 'doc-' || replace(article_id, 'supplier-', '') AS id, asset_id FROM {{v_ref}}),
 rels AS (SELECT id, 'doc-' || cast(seq + 1 AS varchar) AS target_id FROM {{v_markup}}),
 findings AS (SELECT id AS article_id, 'unconverted_macro' AS finding FROM c WHERE contains(body, '[Confluence macro:')
   UNION ALL SELECT DISTINCT id, 'transform_warning: ' || warning FROM warned
   UNION ALL SELECT id, 'missing_asset: ' || asset_id FROM refs WHERE asset_id NOT IN (SELECT id FROM {{v_asset}}) AND id IN (SELECT id FROM c)
   UNION ALL SELECT id, 'missing_relationship: ' || target_id FROM rels WHERE target_id NOT IN (SELECT id FROM c))"""


def review_inputs(v):
    articles = staged(converted(v).select("id", "title", "body", "warnings"), "articles")  # converted once, read several times, mostly the ids
    warnings = articles.select("id", F.explode("warnings").alias("warning"))
    refs = v.v_ref.select(F.replace(F.col("article_id"), F.lit("supplier-"), F.lit("doc-")).alias("id"), "asset_id")
    rels = v.v_markup.select("id", F.concat(F.lit("doc-"), (F.col("seq") + 1).cast("string")).alias("target_id"))
    return articles, warnings, refs, rels


def _findings(v):
    articles, warnings, refs, rels = review_inputs(v)
    return A.review_findings(articles, warnings, refs, v.v_asset, rels)


@reg.query("review_findings", f"WITH {REVIEW_SQL} SELECT article_id, finding FROM findings")
def review_findings(v):
    return _findings(v)


@reg.query("review_summary", f"WITH {REVIEW_SQL} SELECT split_part(finding, ':', 1) AS finding_type, count(*) AS findings, count(DISTINCT article_id) AS articles FROM findings GROUP BY 1")
def review_summary(v):
    return A.review_summary(_findings(v))


@reg.query(
    "review_details",
    f"""WITH {REVIEW_SQL} SELECT c.id, c.title, length(c.body) AS content_characters, coalesce(r.n, 0) AS asset_count, 1 AS relationship_count, coalesce(f.n, 0) AS finding_count FROM c
        LEFT JOIN (SELECT id, count(*) AS n FROM refs GROUP BY id) r ON r.id = c.id LEFT JOIN (SELECT article_id, count(*) AS n FROM findings GROUP BY 1) f ON f.article_id = c.id""",
)
def review_details(v):
    articles, warnings, refs, rels = review_inputs(v)
    findings = A.review_findings(articles, warnings, refs, v.v_asset, rels)
    return A.review_details(articles, refs, rels, findings)


@reg.query("missing_assets", "SELECT article_id, asset_id FROM {v_ref} WHERE asset_id NOT IN (SELECT id FROM {v_asset})")
def missing_assets(v):
    return A.missing_targets(v.v_ref.select("article_id", "asset_id"), v.v_asset, "asset_id")


@reg.query("missing_relationships", "SELECT id, parent_id AS target_id FROM {v_tree} WHERE parent_id NOT IN (SELECT id FROM {v_tree} WHERE status <> 'automobile')")
def missing_relationships(v):
    edges = v.v_tree.filter("parent_id IS NOT NULL").select("id", F.col("parent_id").alias("target_id"))
    return A.missing_targets(edges, v.v_tree.filter("status <> 'automobile'"), "target_id")


@reg.query("referenced_assets", "SELECT DISTINCT asset_id FROM {v_ref}")
def referenced_assets(v):
    return v.v_ref.select("asset_id").distinct().orderBy("asset_id")


@reg.query("attachment_cap", "SELECT article_id, count(*) AS attachments FROM {v_ref} GROUP BY article_id HAVING count(*) > 50")
def attachment_cap(v):
    return A.attachment_cap(v.v_ref, "article_id")


# ---- storage --------------------------------------------------------------

FILES = "CASE WHEN p_size = 3 THEN '.DS_Store' WHEN p_size = 4 THEN 'manifest.json' ELSE p_name || '.bin' END"


def files(v):
    path = F.concat(F.lower("p_type"), F.lit("/"), F.col("p_partkey").cast("string"), F.lit("/"), F.expr(FILES))
    return v.part.select(path.alias("path"), F.col("p_size").cast("bigint").alias("size_bytes"), T.sha256_text(F.col("p_name")).alias("sha256"), "p_brand", "p_retailprice")


@reg.query(
    "bucket_manifest",
    f"""WITH f AS (SELECT lower(p_type) AS category, {FILES} AS filename, lower(p_type) || '/' || cast(p_partkey AS varchar) || '/' || {FILES} AS path, cast(p_size AS bigint) AS size_bytes, sha256(p_name) AS sha256 FROM {{part}}),
        cats AS (SELECT DISTINCT lower(p_type) AS category FROM {{part}} UNION SELECT DISTINCT r_name FROM {{region}})
        SELECT c.category, f.filename, f.path, f.size_bytes, f.sha256 FROM cats c LEFT JOIN f ON f.category = c.category AND f.filename NOT IN ('.DS_Store', 'manifest.json')""",
)
def bucket_manifest(v):
    categories = v.part.select(F.lower("p_type").alias("category")).union(v.region.select("r_name")).distinct()
    return B.bucket_manifest(files(v).select("path", "size_bytes", "sha256"), categories)


LOCAL_SQL = f"local AS (SELECT lower(p_type) || '/' || cast(p_partkey AS varchar) || '/' || {FILES} AS key, cast(p_size AS bigint) AS size_bytes, sha256(p_name) AS sha256, p_brand, p_retailprice FROM {{part}} WHERE p_size <> 3)"


def local_objects(v):
    return B.without_ignored(files(v)).withColumnRenamed("path", "key")


def remote_objects(v):
    """Objects already stored: one brand is absent, cheap parts changed size, one brand its content."""
    return local_objects(v).filter("p_brand <> 'Brand#11'").select(
        "key", F.when(F.col("p_retailprice") < 950, F.col("size_bytes") + 1).otherwise(F.col("size_bytes")).alias("size_bytes"),
        F.when(F.col("p_brand") == "Brand#12", F.lit("x")).otherwise(F.col("sha256")).alias("sha256"),
    )


SIZE_STATUS = "CASE WHEN p_brand <> 'Brand#11' AND p_retailprice >= 950 THEN 'skipped' ELSE 'uploaded' END"
SHA_STATUS = "CASE WHEN p_brand NOT IN ('Brand#11', 'Brand#12') AND p_retailprice >= 950 THEN 'skipped' ELSE 'uploaded' END"


@reg.query("bucket_diff_size", f"WITH {LOCAL_SQL} SELECT key, {SIZE_STATUS} AS status FROM local")
def bucket_diff_size(v):
    return B.diff_by_size(local_objects(v), remote_objects(v)).select("key", "status")


@reg.query("bucket_diff_sha", f"WITH {LOCAL_SQL} SELECT key, {SHA_STATUS} AS status FROM local")
def bucket_diff_sha(v):
    return B.diff_by_checksum(local_objects(v), remote_objects(v)).select("key", "status")


@reg.query("upload_totals", f"WITH {LOCAL_SQL} SELECT {SHA_STATUS} AS status, count(*) AS items FROM local GROUP BY 1")
def upload_totals(v):
    return B.status_totals(B.diff_by_checksum(local_objects(v), remote_objects(v)))


@reg.query("verify_checksums", f"WITH {LOCAL_SQL} SELECT key AS path, CASE WHEN p_brand = 'Brand#11' THEN 'missing' WHEN p_brand = 'Brand#12' THEN 'mismatch' ELSE 'ok' END AS result FROM local")
def verify_checksums(v):
    manifest = local_objects(v).select(F.col("key").alias("path"), "sha256")
    return B.verify_checksums(manifest, remote_objects(v).withColumnRenamed("key", "path")).select("path", "result")


@reg.query("embed_images", "SELECT p_partkey AS id, CASE WHEN p_type = 'PROMO' THEN 'data:x' WHEN p_brand = 'Brand#11' THEN NULL ELSE 'data:' || CASE WHEN p_type = 'SMALL' THEN 'image/jpeg' ELSE 'image/png' END || ';base64,' || base64(encode(p_name)) END AS src FROM {part}")
def embed_images(v):
    key = F.col("p_partkey").cast("string")
    ext = F.when(F.col("p_type") == "SMALL", F.lit(".jpg")).otherwise(F.lit(".zzz"))
    refs = v.part.select(F.col("p_partkey").alias("id"), F.when(F.col("p_type") == "PROMO", F.lit("data:x")).otherwise(F.concat(F.lit("images/"), key, ext)).alias("src"))
    blobs = v.part.filter("p_brand <> 'Brand#11'").select(F.concat(F.lit("images/"), key, ext).alias("src"), F.encode("p_name", "UTF-8").alias("content"))
    from ..operators.packaging import embed_images as embed

    return embed(refs, blobs)


@reg.query("exact_duplicates", "WITH s AS (SELECT id, sha256(body) AS sha256 FROM {v_article}), g AS (SELECT sha256, min(id) AS canonical_id, count(*) AS copies FROM s GROUP BY sha256 HAVING count(*) > 1) SELECT s.id, s.sha256, canonical_id, copies FROM s JOIN g ON g.sha256 = s.sha256")
def exact_duplicates(v):
    return B.exact_duplicates(v.v_article.select("id", T.sha256_text(F.col("body")).alias("sha256")))


@reg.query("merge_decisions", "WITH s AS (SELECT id, body, min(id) OVER (PARTITION BY body) AS target_id FROM {v_article}) SELECT id AS alias_id, 'duplicate_of' AS type, target_id FROM s WHERE id <> target_id")
def merge_decisions(v):
    return B.merge_decisions(exact_duplicates(v))


@reg.query("dedup_savings", "SELECT cast(sum(n) AS bigint) AS items, count(*) AS distinct_items, cast(sum(a) AS bigint) AS bytes, cast(sum(a - m) AS bigint) AS bytes_saved FROM (SELECT sha256, count(*) AS n, sum(size_bytes) AS a, max(size_bytes) AS m FROM {v_asset} GROUP BY sha256)")
def dedup_savings(v):
    return B.dedup_savings(v.v_asset)
