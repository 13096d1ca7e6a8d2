"""Publish plan, bundle and audit queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import audit as A
from ..operators import bundle as U
from ..operators import reconcile as R
from . import sql as S
from .registry import Registry

reg = Registry()
QUERIES, ORACLES = reg.queries, reg.oracles


def articles(v):
    return v.v_article.select(
        "id", F.concat(F.lit("kb-"), "external_id").alias("slug"), "title", T.sha256_text(F.col("body")).alias("html_sha256"),
        F.concat(F.lit("articles/"), "id", F.lit(".html")).alias("path"), F.concat(F.lit("https://src.example.com/"), "external_id").alias("source_url"),
    )


def remotes(v):
    return v.v_remote


# Saved id, else permalink, else folded title; the last listed remote wins.
RESOLVE_SQL = f"""by_title AS (SELECT {S.fold(S.strip('remote_title'))} AS t, max_by(remote_id, seq) AS rid, max_by(portal_url, seq) AS url FROM {{v_remote}} WHERE remote_title <> '' GROUP BY 1),
 resolved AS (SELECT a.*, coalesce(r1.remote_id, r2.remote_id, r3.rid) AS rid, CASE WHEN r2.remote_id IS NOT NULL THEN r2.portal_url ELSE r3.url END AS remote_portal, s.html_sha256, s.portal_url AS state_portal, s.id AS sid
   FROM {{v_article}} a LEFT JOIN {{v_state}} s ON s.id = a.id LEFT JOIN {{v_remote}} r1 ON r1.remote_id = s.remote_id LEFT JOIN {{v_remote}} r2 ON r2.permalink = 'kb-' || a.external_id
   LEFT JOIN by_title r3 ON r3.t = {S.fold(S.strip('a.title'))}),
 plan AS (SELECT *, CASE WHEN rid IS NULL THEN 'created' WHEN html_sha256 = sha256(body) THEN 'skipped' ELSE 'updated' END AS action FROM resolved)"""


def plan(v):
    return R.import_plan(R.resolve_remote(articles(v), v.v_state, remotes(v)), v.v_state)


@reg.query("resolve_remote", f"WITH {RESOLVE_SQL} SELECT id, rid AS remote_id FROM resolved")
def resolve_remote(v):
    return R.resolve_remote(articles(v), v.v_state, remotes(v)).select("id", "remote_id")


@reg.query("import_plan", f"WITH {RESOLVE_SQL} SELECT id, rid AS remote_id, action FROM plan")
def import_plan(v):
    return plan(v).select("id", "remote_id", "action")


ORACLES_IMPORT = f"WITH {RESOLVE_SQL} SELECT count(*) AS article_count, count(*) FILTER (action = 'created') AS created, count(*) FILTER (action = 'updated') AS updated, count(*) FILTER (action = 'skipped') AS skipped FROM plan"


@reg.query("import_totals", ORACLES_IMPORT)
def import_totals(v):
    return R.import_totals(plan(v))


@reg.query(
    "publish_ledger",
    f"""WITH {RESOLVE_SQL}, o AS (SELECT CASE WHEN space = 'src13' THEN 'failed' ELSE action END AS outcome FROM plan)
        SELECT outcome, count(*) AS articles FROM o GROUP BY 1 UNION ALL SELECT 'attempted', count(*) FROM o""",
)
def publish_ledger(v):
    return R.publish_ledger(plan(v), v.v_article.filter("space = 'src13'"))


@reg.query("article_url_map", f"WITH {RESOLVE_SQL} SELECT id, id || '.html' AS filename, coalesce(nullif(state_portal, ''), nullif(remote_portal, ''), 'https://src.example.com/' || external_id) AS url FROM resolved")
def article_url_map(v):
    return R.article_url_map(articles(v), v.v_state, remotes(v))


@reg.query("article_payload", """SELECT id, title, 'cat-1' AS category, 'Draft' AS status, 'ALL' AS permission, 'kb-' || external_id AS permalink, CASE WHEN lang = 'en' THEN 'en-us' END AS locale, 2 AS tags FROM {v_article}""")
def article_payload(v):
    rows = v.v_article.select("id", "lang", "title", F.col("body").alias("answer"), F.concat(F.lit("kb-"), "external_id").alias("slug"), F.array("lang", "space").alias("tags"))
    category = F.lit("cat-1")
    payload = F.when(F.col("lang") == "en", R.article_payload(category, "Draft", "ALL", "en-us")).otherwise(R.article_payload(category, "Draft", "ALL"))
    p = rows.select("id", payload.alias("p"))
    get = lambda k: F.get_json_object("p", f"$.{k}")
    return p.select(
        "id", get("title").alias("title"), get("categoryId").alias("category"), get("status").alias("status"), get("permission").alias("permission"),
        get("permalink").alias("permalink"), get("locale").alias("locale"), F.json_array_length(get("tags")).alias("tags"),
    )


# ---- bundle ---------------------------------------------------------------
BODY_SQL = """'<p><a class="k" href="knowledge://doc-' || cast(seq + 1 AS string) || '#s">next</a><img src="asset://asset-' || cast(seq AS string) || '"/>' || replace(body, '<', '&lt;') || '<a href="https://x.example.com/a.html">x</a></p>'"""
OUT_SQL = """'<p><a class="k" href="' || CASE WHEN k.id IS NULL THEN 'knowledge://doc-' || cast(a.seq + 1 AS varchar) ELSE 'kb-' || cast(a.seq + 1 AS varchar) || '--doc-' || cast(a.seq + 1 AS varchar) || '.html' END || '#s">next</a><img src="'
  || CASE WHEN s.id IS NULL THEN 'asset://asset-' || cast(a.seq AS varchar) ELSE '../assets/' || s.id || regexp_extract(s.filename, '^[^.]*(\\..*)$', 1) END || '"/>' || replace(a.body, '<', '&lt;') || '<a href="https://x.example.com/a.html">x</a></p>'"""
BUNDLE_SQL = f"""out AS (SELECT a.id, a.external_id, a.title, a.seq, {OUT_SQL} AS body, k.id AS kid, s.id AS sid FROM {{v_article}} a LEFT JOIN {{v_article}} k ON k.seq = a.seq + 1 LEFT JOIN {{v_asset}} s ON s.seq = a.seq)"""


def bundle(v):
    body = v.v_article.withColumn("body", F.expr(BODY_SQL))
    paths = articles(v).select(F.col("id").alias("target_id"), T.article_path(F.col("slug"), F.col("id")).alias("path"))
    assets = v.v_asset.select(F.col("id").alias("target_id"), T.published_asset_name(F.col("id"), F.col("filename")).alias("path"))
    return R.rewrite_bundle_links(body, paths, assets)


@reg.query("rewrite_bundle_links", f"WITH {BUNDLE_SQL} SELECT id, body FROM out")
def rewrite_bundle_links(v):
    return bundle(v)[0].select("id", "body")


DOC_SQL = f"""docs AS (SELECT id, title, 'articles/kb-' || external_id || '--' || id || '.html' AS path, '<!doctype html>' || chr(10) || '<html lang="en">' || chr(10) || '<head>' || chr(10) || '  <meta charset="utf-8">' || chr(10) || '  <meta name="article-id" content="' || id
  || '">' || chr(10) || '  <title>' || {S.escape('title')} || '</title>' || chr(10) || '</head>' || chr(10) || '<body>' || chr(10) || '  <h1>' || {S.escape('title')} || '</h1>' || chr(10) || '  ' || body || chr(10)
  || '  <p class="source"><a href="https://src.example.com/' || external_id || '">Original page</a></p>' || chr(10) || '</body>' || chr(10) || '</html>' || chr(10) AS html FROM out)"""


def documents(v):
    rows = bundle(v)[0].select("id", "title", "body").join(articles(v).select("id", "slug", "source_url"), "id")
    return U.bundle_documents(rows)


@reg.query("bundle_documents", f"WITH {BUNDLE_SQL}, {DOC_SQL} SELECT id, path, html, sha256(html) AS sha256 FROM docs")
def bundle_documents(v):
    return documents(v).select("id", "path", "html", "sha256")


@reg.query(
    "publisher_manifest",
    f"""WITH {BUNDLE_SQL}, {DOC_SQL} SELECT 'article' AS section, id, title, path, sha256(html) AS sha256, NULL AS size_bytes, NULL AS issue FROM docs
        UNION ALL SELECT 'asset', id, NULL, 'assets/' || id || regexp_extract(filename, '^[^.]*(\\..*)$', 1), sha256, size_bytes, NULL FROM {{v_asset}}
        UNION ALL SELECT 'issue', id, NULL, NULL, NULL, NULL, 'unresolved knowledge link doc-' || cast(seq + 1 AS varchar) FROM out WHERE kid IS NULL
        UNION ALL SELECT 'issue', id, NULL, NULL, NULL, NULL, 'unresolved asset link asset-' || cast(seq AS varchar) FROM out WHERE sid IS NULL""",
)
def publisher_manifest(v):
    assets = v.v_asset.select("id", F.concat(F.lit("assets/"), T.published_asset_name(F.col("id"), F.col("filename"))).alias("path"), "sha256", "size_bytes")
    return U.publisher_manifest(documents(v), assets, bundle(v)[1])


ANSWER_SQL = """'<p><a href="kb/doc-' || cast(seq + 1 AS string) || '.html#s">next</a><img src="../assets/asset-' || cast(seq AS string) || '.png"/><a href="https://o.example.com/doc-1.html">o</a>' || replace(body, '<', '&lt;') || '</p>'"""


def answers(v):
    return v.v_article.select("id", "seq", "lang", F.expr(ANSWER_SQL).alias("body"))


@reg.query(
    "rewrite_answer_links",
    """SELECT a.id, '<p><a href="' || coalesce(u.portal_url, 'kb/doc-' || cast(a.seq + 1 AS varchar) || '.html') || '#s">next</a><img src="' || CASE WHEN a.lang = 'en' THEN 'https://cdn.example.com/' || a.id ELSE '../assets/asset-' || cast(a.seq AS varchar) || '.png' END
         || '"/><a href="https://o.example.com/doc-1.html">o</a>' || replace(a.body, '<', '&lt;') || '</p>' AS body,
         CASE WHEN u.portal_url IS NULL THEN 1 ELSE 0 END + CASE WHEN a.lang = 'en' THEN 0 ELSE 1 END AS unresolved
       FROM {v_article} a LEFT JOIN {v_state} u ON u.seq = a.seq + 1 AND u.portal_url <> ''""",
)
def rewrite_answer_links(v):
    urls = v.v_state.select(F.concat("id", F.lit(".html")).alias("filename"), F.col("portal_url").alias("url"))
    files = v.v_article.filter("lang = 'en'").select(
        "id", F.concat(F.lit("asset-"), F.col("seq").cast("string"), F.lit(".png")).alias("filename"), F.concat(F.lit("https://cdn.example.com/"), "id").alias("asset_url")
    )
    done, missed = R.rewrite_answer_links(answers(v), urls, files)
    counts = missed.groupBy("id").agg(F.count("*").alias("_n"))
    return done.join(counts, "id", "left").select("id", "body", F.coalesce("_n", F.lit(0)).alias("unresolved"))


@reg.query("required_assets", "SELECT a.id, 'asset-' || cast(a.seq AS varchar) || '.png' AS filename, s.id AS asset_id FROM {v_article} a LEFT JOIN {v_asset} s ON s.seq = a.seq")
def required_assets(v):
    assets = v.v_asset.select(F.concat("id", F.lit(".png")).alias("filename"), F.col("id").alias("asset_id"), "size_bytes")
    found, lost = R.required_assets(answers(v), assets)
    return found.select("id", "filename", "asset_id").unionByName(lost.select("id", "filename", F.lit(None).cast("string").alias("asset_id")))


REQUIRED_SQL = "req AS (SELECT r.article_id, r.asset_id, s.filename, s.size_bytes, r.kind FROM {v_ref} r JOIN {v_asset} s ON s.id = r.asset_id)"


def required(v):
    return v.v_ref.join(v.v_asset.select(F.col("id").alias("asset_id"), "filename", "size_bytes", "sha256"), "asset_id")


@reg.query(
    "inline_topk",
    f"""WITH {REQUIRED_SQL}, n AS (SELECT article_id, greatest(count(*) - 50, 0) AS k, count(*) FILTER (kind = 'img') AS images FROM req GROUP BY 1),
        r AS (SELECT req.*, n.k, n.images, row_number() OVER (PARTITION BY req.article_id, kind ORDER BY size_bytes, filename, asset_id) AS rn FROM req JOIN n ON n.article_id = req.article_id)
        SELECT article_id, asset_id, CASE WHEN images < k THEN 'failed' WHEN kind = 'img' AND rn <= k THEN 'inlined' ELSE 'attached' END AS placed FROM r""",
)
def inline_topk(v):
    return R.inline_smallest(required(v)).select("article_id", "asset_id", "placed")


@reg.query("stale_attachments", "SELECT DISTINCT r.article_id, r.asset_id AS name FROM {v_ref} r JOIN {v_asset} s ON s.id = r.asset_id WHERE r.kind = 'img' AND s.size_bytes > 10485760 AND s.container <> 'Brand#4'")
def stale_attachments(v):
    # The destination holds every image; documents, small files and one brand are still needed.
    remote = v.v_ref.filter("kind = 'img'").select("article_id", F.col("asset_id").alias("name"))
    rows = v.v_ref.join(v.v_asset.select(F.col("id").alias("asset_id"), "size_bytes", "container"), "asset_id").select("article_id", F.col("asset_id").alias("name"), "size_bytes", "container")
    return R.stale_attachments(remote, v.v_asset.select(F.col("id").alias("name")), rows.filter("size_bytes <= 10485760"), rows.filter("container = 'Brand#4'"))


@reg.query(
    "attachment_plan",
    f"""WITH {REQUIRED_SQL} SELECT q.article_id, q.asset_id, CASE WHEN a.container = 'Brand#1' AND q.kind = 'a' THEN 'reused' WHEN q.kind = 'img' THEN 'adopted' ELSE 'uploaded' END AS action,
        CASE WHEN a.container = 'Brand#1' AND q.kind = 'a' THEN 'saved:' || q.asset_id WHEN q.kind = 'img' THEN 'remote:' || q.asset_id END AS url FROM req q JOIN {{v_asset}} a ON a.id = q.asset_id""",
)
def attachment_plan(v):
    need = required(v).withColumn("upload_name", T.upload_name(F.concat("asset_id", F.lit("-"), "filename"), F.col("size_bytes")))
    with_brand = need.join(v.v_asset.select(F.col("id").alias("asset_id"), "container"), "asset_id")
    # Saved uploads of two brands, one with a stale checksum and only for plain links.
    saved = with_brand.filter("container IN ('Brand#1', 'Brand#2') AND kind = 'a'").select(
        "article_id", "asset_id", F.when(F.col("container") == "Brand#1", F.col("sha256")).otherwise("old").alias("sha256"), F.concat(F.lit("saved:"), "asset_id").alias("url")
    )
    remote = need.filter("kind = 'img'").select("article_id", F.col("upload_name").alias("name"), F.concat(F.lit("remote:"), "asset_id").alias("url"))
    return R.attachment_plan(need, saved, remote).select("article_id", "asset_id", "action", "url")


@reg.query(
    "attachment_normalize",
    """SELECT p_partkey AS id, CASE p_type WHEN 'PROMO' THEN NULL ELSE 'r' || cast(p_partkey AS varchar) END AS resource_id, CASE p_type WHEN 'PROMO' THEN NULL WHEN 'SMALL' THEN 'v' WHEN 'LARGE' THEN 'd' ELSE 'u' END AS url,
       CASE WHEN p_type = 'PROMO' THEN NULL ELSE p_name END AS name FROM {part}""",
)
def attachment_normalize(v):
    key = F.concat(F.lit("r"), F.col("p_partkey").cast("string"))
    url = F.when(F.col("p_type") == "SMALL", F.lit('"viewUrl":"v"')).when(F.col("p_type") == "LARGE", F.lit('"url":"","downloadUrl":"d"')).otherwise(F.lit('"url":"u"'))
    item = F.concat(F.lit('{"resourceId":"'), key, F.lit('","name":"'), "p_name", F.lit('",'), url, F.lit("}"))
    payload = (
        F.when(F.col("p_type") == "PROMO", F.lit('{"data":[]}')).when(F.col("p_type") == "SMALL", F.concat(F.lit('{"data":['), item, F.lit("]}")))
        .when(F.col("p_type") == "LARGE", F.concat(F.lit('{"attachments":'), item, F.lit("}"))).otherwise(item)
    )
    rows = v.part.select(F.col("p_partkey").alias("id"), R.normalize_attachment(F.parse_json(payload)).alias("x"))
    return rows.select("id", "x.resource_id", "x.url", "x.name")


@reg.query("bundle_check", "SELECT id FROM {v_article} WHERE space = 'src3'")
def bundle_check(v):
    return R.bundle_check(v.v_article, v.v_article.filter("space <> 'src3'"))


@reg.query("manifest_reconcile", "SELECT id, CASE WHEN space = 'src3' THEN 'left_only' WHEN space = 'src4' THEN 'right_only' ELSE 'both' END AS side FROM {v_article}")
def manifest_reconcile(v):
    return R.manifest_reconcile(v.v_article.filter("space <> 'src4'"), v.v_article.filter("space <> 'src3'"))


@reg.query("state_guard", "SELECT id, category_id FROM {v_state} WHERE category_id <> 'cat-1'")
def state_guard(v):
    return R.state_guard(v.v_state, "cat-1").select("id", "category_id")


@reg.query("excluded_ids", "SELECT id FROM {v_article} WHERE id NOT IN (SELECT id FROM {v_state})")
def excluded_ids(v):
    return v.v_article.select("id").join(v.v_state.select("id"), "id", "left_anti").orderBy("id")


@reg.query("id_map", "SELECT a.id, 'wiki' AS connector, a.external_id, s.remote_id AS destination_id, s.category_id FROM {v_article} a LEFT JOIN {v_state} s ON s.id = a.id")
def id_map(v):
    return R.id_map(v.v_article.select("id", F.lit("wiki").alias("connector"), "external_id"), v.v_state)


# ---- audit ----------------------------------------------------------------
FIELDS_SQL = """fields AS (SELECT s.id, unnest([CASE WHEN s.pending THEN 'import state is pending' END,
   CASE WHEN r.status IS DISTINCT FROM 'Draft' THEN 'status is ' || coalesce('''' || r.status || '''', 'None') || ', expected ''Draft''' END,
   CASE WHEN r.category_id IS DISTINCT FROM s.category_id THEN 'category does not match import state' END,
   CASE WHEN r.remote_title IS DISTINCT FROM a.title THEN 'title does not match canonical object' END]) AS issue
   FROM {v_state} s LEFT JOIN {v_remote} r ON r.remote_id = s.remote_id LEFT JOIN {v_article} a ON a.id = s.id)"""


def field_issues(v):
    there = v.v_remote.select("remote_id", "status", "category_id", F.col("remote_title").alias("title"))
    # The destination's titles are upper case, so most differ; keep what it returns.
    return A.field_issues(v.v_state, there, v.v_article)


@reg.query("audit_fields", f"WITH {FIELDS_SQL} SELECT id, issue FROM fields WHERE issue IS NOT NULL")
def audit_fields(v):
    return field_issues(v)


# Remote bodies: a portal link to the next article, leftovers in some spaces.
REMOTE_BODY = """'<p><a href="' || CASE WHEN space = 'src1' THEN 'https://src.example.com/' || cast(seq + 1 AS string) WHEN space = 'src2' THEN 'doc-9.html' ELSE 'https://help.example.com/kb/' || cast(seq + 1 AS string) END || '#top">n</a><img src="'
  || CASE WHEN space = 'src3' THEN '../assets/a.png' WHEN space = 'src4' THEN 'https://h/translations/1/attachments/2' ELSE 'data:image/png;base64,x' END || '"/>' || replace(body, '<', '&lt;') || '</p>'"""


def remote_answers(v):
    return v.v_article.select("id", F.expr(REMOTE_BODY).alias("answer"))


LINKS_SQL = """links AS (SELECT id, 'unresolved article link: doc-9.html#top' AS issue FROM {v_article} WHERE space = 'src2' UNION ALL SELECT id, 'unresolved asset link: ../assets/a.png' FROM {v_article} WHERE space = 'src3'
   UNION ALL SELECT id, 'unexpected image host: ../assets/a.png' FROM {v_article} WHERE space = 'src3')"""


@reg.query("audit_links", f"WITH {LINKS_SQL} SELECT id, issue FROM links")
def audit_links(v):
    return A.link_issues(remote_answers(v))


FALLBACK_SQL = "fallbacks AS (SELECT a.id, 'source fallback remains for ' || s.id AS issue FROM {v_article} a JOIN {v_state} s ON s.seq = a.seq + 1 WHERE a.space = 'src1')"


def fallbacks(v):
    return A.fallback_issues(remote_answers(v), articles(v).select("id", F.col("source_url").alias("url")), v.v_state)


@reg.query("audit_fallbacks", f"WITH {FALLBACK_SQL} SELECT id, issue FROM fallbacks")
def audit_fallbacks(v):
    return fallbacks(v)


MISSING_SQL = "missing AS (SELECT a.id, 'missing link to ' || s.id AS issue FROM {v_article} a JOIN {v_state} s ON s.seq = a.seq + 1 WHERE s.portal_url = '' OR a.space IN ('src1', 'src2'))"


def missing_links(v):
    local = v.v_article.select("id", F.concat(F.lit("doc-"), (F.col("seq") + 1).cast("string")).alias("target_id"))
    return A.missing_link_issues(local, v.v_state, remote_answers(v))


@reg.query("audit_missing_links", f"WITH {MISSING_SQL} SELECT id, issue FROM missing")
def audit_missing_links(v):
    return missing_links(v)


@reg.query(
    "audit_summary",
    f"""WITH {FIELDS_SQL}, {LINKS_SQL}, {FALLBACK_SQL}, {MISSING_SQL}, issues AS (SELECT * FROM fields WHERE issue IS NOT NULL UNION SELECT * FROM (SELECT * FROM links UNION SELECT * FROM fallbacks UNION SELECT * FROM missing) WHERE id IN (SELECT id FROM {{v_state}}))
        SELECT (SELECT count(*) FROM {{v_article}}) AS canonical_article_count, (SELECT count(*) FROM {{v_state}}) AS draft_count, (SELECT count(*) FROM issues) AS issue_count,
               (SELECT count(*) FROM {{v_article}} WHERE id NOT IN (SELECT id FROM {{v_state}})) AS excluded_count, (SELECT count(*) FROM issues) = 0 AS passed""",
)
def audit_summary(v):
    from ..plans.publish import audit

    bodies = v.v_state.select("id").join(remote_answers(v), "id")
    local = v.v_state.select("id", F.concat(F.lit("doc-"), (F.col("seq") + 1).cast("string")).alias("target_id"))
    there = v.v_remote.select("remote_id", "status", "category_id", F.col("remote_title").alias("title"))
    return audit(v.v_state, there, v.v_article, bodies, local, articles(v).select("id", F.col("source_url").alias("url")))


@reg.query(
    "verify_articles",
    """SELECT id, problem FROM (SELECT a.id, unnest(CASE WHEN r.remote_id IS NULL THEN ['remote missing'] ELSE
         [CASE WHEN a.space = 'src14' THEN 'ID' END, CASE WHEN r.category_id <> 'cat-1' THEN 'category' END, CASE WHEN r.remote_title <> a.title THEN 'title' END,
         CASE WHEN r.status <> 'Draft' THEN 'status' END, CASE WHEN a.space IN ('src2', 'src3') THEN 'local links' END] END) AS problem
       FROM {v_article} a LEFT JOIN {v_remote} r ON r.remote_id = 'r-' || a.external_id) WHERE problem IS NOT NULL""",
)
def verify_articles(v):
    rows = v.v_article.select("id", F.concat(F.lit("r-"), "external_id").alias("remote_id"), "title", "space")
    there = v.v_remote.join(rows.select("remote_id", "space", "id"), "remote_id").join(remote_answers(v), "id").select(
        "remote_id", F.when(F.col("space") == "src14", F.lit("?")).otherwise(F.col("remote_id")).alias("fetched_id"), "category_id", "remote_title", "status", "answer"
    )
    return A.verify_problems(rows.drop("space"), there, "cat-1", "Draft")
