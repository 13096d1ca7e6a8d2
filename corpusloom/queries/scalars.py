"""Scalar text, name, URL and date functions over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import text as T
from . import sql as S
from .registry import Registry

reg = Registry()
QUERIES, ORACLES = reg.queries, reg.oracles


@reg.query("content_checksums", "SELECT id, sha256(body) AS sha256, length(body) AS characters, strlen(body) AS bytes FROM {v_article}")
def content_checksums(v):
    return v.v_article.select(
        "id",
        T.sha256_text(F.col("body")).alias("sha256"),
        F.char_length("body").cast("bigint").alias("characters"),
        F.octet_length("body").cast("bigint").alias("bytes"),
    )


@reg.query("slugs", f"SELECT id, {S.slug('title', 'external_id')} AS slug FROM {{v_article}}")
def slugs(v):
    return v.v_article.select("id", T.slug(F.col("title"), F.col("external_id")).alias("slug"))


@reg.query("legacy_slugs", f"SELECT id, trim(regexp_replace({S.strip('title')}, '[^a-zA-Z0-9]+', '-', 'g'), '-') AS slug FROM {{v_article}}")
def legacy_slugs(v):
    return v.v_article.select("id", T.legacy_slug(F.col("title")).alias("slug"))


@reg.query("fold_titles", f"SELECT id, {S.fold('title')} AS folded FROM {{v_article}}")
def fold_titles(v):
    return v.v_article.select("id", T.fold(F.col("title")).alias("folded"))


@reg.query("clean_text", f"SELECT id, {S.clean('body')} AS cleaned FROM {{v_article}}")
def clean_text(v):
    return v.v_article.select("id", T.clean_text(F.col("body")).alias("cleaned"))


# Part descriptions with path separators, forbidden marks, controls and dots.
RAW_NAME = "concat(' .', p_brand, '/', p_name, ' : <', p_type, '>*?', chr(9), '.v', cast(p_size AS string), '.tar.gz', CASE WHEN p_size < 10 THEN '/' WHEN p_size > 40 THEN ' -.' ELSE '' END)"
RAW_NAME_SQL = RAW_NAME
SAFE = "trim(regexp_replace(regexp_extract(regexp_replace({x}, '(?:/\\.?)+\\z', ''), '([^/]*)\\z', 1), '[\\x00-\\x1f<>:\"/\\\\|?*]+', '-', 'g'), ' .-')"


@reg.query("safe_names", f"SELECT p_partkey AS id, coalesce(nullif({SAFE.format(x=RAW_NAME_SQL)}, ''), 'attachment') AS name FROM {{part}}")
def safe_names(v):
    return v.part.select(F.col("p_partkey").alias("id"), T.safe_name(F.expr(RAW_NAME)).alias("name"))


# Encoded names: spaces as %20, a literal plus, an accent, a slash.
CODED = "concat(replace(p_name, ' ', '%20'), '+', p_type, '%2Fcaf%C3%A9%20%20', CASE WHEN p_size > 25 THEN '%3F%2A' ELSE '' END, '.png')"


@reg.query(
    "safe_names_decoded",
    f"""SELECT p_partkey AS id, coalesce(nullif(trim(regexp_replace(regexp_replace(url_decode({CODED}), '[\\\\/:*?"<>|]+', '-', 'g'), '{S.WS}+', ' ', 'g'), ' .-'), ''), 'unnamed-asset') AS name FROM {{part}}""",
)
def safe_names_decoded(v):
    return v.part.select(F.col("p_partkey").alias("id"), T.safe_name_decoded(F.expr(CODED)).alias("name"))


@reg.query(
    "safe_names_deleted",
    f"""SELECT p_partkey AS id, {S.clean("regexp_replace(" + RAW_NAME_SQL + ", '[" + chr(92) * 2 + "/:*?" + chr(34) + "<>|]+', '', 'g')")} AS name FROM {{part}}""",
)
def safe_names_deleted(v):
    return v.part.select(F.col("p_partkey").alias("id"), T.safe_name_deleted(F.expr(RAW_NAME)).alias("name"))


@reg.query("asset_paths", "SELECT id, id || regexp_extract(filename, '^[^.]*(\\..*)$', 1) AS path FROM {v_asset}")
def asset_paths(v):
    return v.v_asset.select("id", T.published_asset_name(F.col("id"), F.col("filename")).alias("path"))


@reg.query("article_paths", f"SELECT id, {S.slug('title', 'external_id')} || '--' || id || '.html' AS path FROM {{v_article}}")
def article_paths(v):
    return v.v_article.select(
        "id", T.article_path(T.slug(F.col("title"), F.col("external_id")), F.col("id")).alias("path")
    )


@reg.query("status_map", "SELECT id, CASE lower(status) WHEN 'current' THEN 'published' WHEN 'draft' THEN 'draft' WHEN 'archived' THEN 'archived' ELSE 'review' END AS status FROM {v_tree}")
def status_map(v):
    return v.v_tree.select("id", T.published_status(F.col("status")).alias("status"))


@reg.query(
    "iso_dates",
    """SELECT event_id AS id, CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'view' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' END AS iso FROM {events}""",
)
def iso_dates(v):
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    raw = (
        F.when(F.col("event_type") == "error", F.lit(""))
        .when(F.col("event_type") == "view", stamp)
        .otherwise(F.concat(stamp, F.lit("Z")))
    )
    return v.events.select(F.col("event_id").alias("id"), T.iso_text(raw).alias("iso"))


@reg.query(
    "absolute_urls",
    f"""WITH {S.ANCHORS} SELECT page_id, pos, CASE WHEN pos % 2 = 1 AND contains(url, '/en/') THEN 'https://wiki.example.com/wiki/pages' || href
          WHEN href LIKE 'http://%' OR href LIKE 'https://%' THEN href ELSE 'https://wiki.example.com' || CASE WHEN href LIKE '/%' THEN href ELSE '/' || href END END AS absolute FROM anchors""",
)
def absolute_urls(v):
    from ..operators.links import link_inventory

    links = link_inventory(v.pages, "page_id", "html", carry=["url"])
    href = F.when(
        (F.col("pos") % 2 == 1) & F.col("url").contains("/en/"), F.concat(F.lit("/pages"), F.col("href"))
    ).otherwise(F.col("href"))
    return links.select(
        "page_id", "pos", T.absolute_url(href, F.lit("https://wiki.example.com")).alias("absolute")
    )


@reg.query(
    "source_urls",
    """SELECT page_id, CASE WHEN contains(url, '/en/') THEN url
          WHEN contains(url, '/de/') THEN '' ELSE 'https://wiki.example.com/download/' || cast(page_id AS varchar) END AS source_url FROM {pages}""",
)
def source_urls(v):
    url, key = F.col("url"), F.col("page_id").cast("string")
    webui_link = F.when(url.contains("/en/"), url).otherwise(F.lit(""))
    download = F.when(url.contains("/de/"), F.lit(None)).otherwise(F.concat(F.lit("/download/"), key))
    return v.pages.select(
        "page_id",
        T.source_url(
            webui_link, F.lit(None).cast("string"), F.lit(""), download, F.lit("https://wiki.example.com/")
        ).alias("source_url"),
    )


@reg.query(
    "response_names",
    """SELECT page_id, CASE
        WHEN event_type = 'click' THEN 'report-' || cast(page_id AS varchar) || ' final.pdf'
        WHEN event_type = 'view' THEN 'é-' || cast(page_id AS varchar) || '.zip'
        WHEN event_type = 'error' THEN coalesce(nullif(trim(regexp_extract(regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/+$', ''), '([^/]*)$', 1), ' .-'), ''), 'x')
        ELSE 'unnamed-asset' || CASE WHEN event_type = 'signup' THEN '.pdf' ELSE '' END END AS name FROM {v_fetch}""",
)
def response_names(v):
    kind, key = F.col("event_type"), F.col("page_id").cast("string")
    disposition = (
        F.when(kind == "click", F.concat(F.lit('attachment; filename="report-'), key, F.lit('%20final.pdf"; size=1')))
        .when(kind == "view", F.concat(F.lit("attachment; filename*=UTF-8''%C3%A9-"), key, F.lit(".zip")))
        .otherwise(F.lit(None))
    )
    final_url = F.when(kind == "error", F.col("url")).otherwise(F.lit("https://host.example.com/"))
    content_type = F.when(kind == "signup", F.lit("application/pdf; charset=x")).otherwise(F.lit("what/ever"))
    return v.v_fetch.select(
        "page_id",
        T.response_name(disposition, final_url, F.lit("https://host.example.com"), content_type).alias("name"),
    )


@reg.query(
    "media_types",
    """SELECT id, CASE regexp_extract(filename, '\\.([^.]+)$', 1) WHEN 'png' THEN 'image/png' WHEN 'jpg' THEN 'image/jpeg' WHEN 'webp' THEN 'image/webp'
         WHEN 'pdf' THEN 'application/pdf' WHEN 'zip' THEN 'application/zip' ELSE 'application/octet-stream' END AS media_type FROM {v_asset}""",
)
def media_types(v):
    return v.v_asset.select("id", T.media_type(F.col("filename")).alias("media_type"))


@reg.query("upload_names", "SELECT id, filename || CASE WHEN size_bytes > 20971520 THEN '.zip' ELSE '' END AS upload_name FROM {v_asset}")
def upload_names(v):
    return v.v_asset.select("id", T.upload_name(F.col("filename"), F.col("size_bytes")).alias("upload_name"))


@reg.query("query_param", "SELECT page_id, regexp_extract(url, '[?&]ref=([^&#]+)', 1) AS ref, regexp_extract(url, '[?&]utm_source=([^&#]+)', 1) AS feed FROM {pages}")
def query_param(v):
    return v.pages.select(
        "page_id",
        T.query_param(F.col("url"), "ref").alias("ref"),
        T.query_param(F.col("url"), "utm_source").alias("feed"),
    )


@reg.query("stable_ids", "SELECT id, 'wiki-' || id AS stable_id, 'wiki-attachment-' || id AS asset_id FROM {v_tree}")
def stable_ids(v):
    return v.v_tree.select(
        "id",
        T.stable_id("wiki", F.col("id")).alias("stable_id"),
        T.stable_id("wiki-attachment", F.col("id")).alias("asset_id"),
    )


@reg.query(
    "redact_text",
    """SELECT id, regexp_replace(regexp_replace(body, 'token = "[0-9a-f]+"', '<redacted>', 'g'), '\\b\\d{1,3}\\.\\d{1,3}\\.\\d{1,3}\\.\\d{1,3}\\b', '<redacted>', 'g') AS redacted,
         replace(title, space, '<redacted>') AS title FROM {v_article}""",
)
def redact_text(v):
    patterns = [r'token = "[0-9a-f]+"', r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b"]
    return v.v_article.select(
        "id",
        T.redact_patterns(F.col("body"), patterns).alias("redacted"),
        T.redact(F.col("title"), [F.col("space")]).alias("title"),
    )


@reg.query(
    "public_urls",
    """SELECT id, 'https://cdn.example.com/kb/assets/' || replace(replace(replace(replace(container, '#', '%23') || '/' || filename, ' ', '%20'), 'é', '%C3%A9'), '+', '%2B') AS public_url FROM {v_asset}""",
)
def public_urls(v):
    key = T.object_key("/kb/assets/", F.concat_ws("/", "container", "filename"))
    return v.v_asset.select("id", T.public_url("https://cdn.example.com/", key).alias("public_url"))


@reg.query("normalize_newlines", f"SELECT id, CASE WHEN t = '' THEN '' ELSE t || chr(10) END AS body FROM (SELECT id, {S.strip('regexp_replace(replace(body, chr(10), chr(10) || chr(10) || chr(10)), chr(10) || chr(123) || chr(51) || chr(44) || chr(125), chr(10) || chr(10), ' + chr(39) + 'g' + chr(39) + ')')} AS t FROM {{v_article}})")
def normalize_newlines(v):
    # Every line break is tripled first, so each one is a run to collapse.
    body = F.replace(F.col("body"), F.lit("\n"), F.lit("\n\n\n"))
    return v.v_article.select("id", H.normalize_newlines(body).alias("body"))


@reg.query(
    "clean_markup",
    r"""SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '<html [^>]*>', '<html>', 'g'), '<meta [^>]*>', '<meta>', 'g'),
         '<div [^>]*>', '<div>', 'g'), '</?span[^>]*>', '', 'g') AS html FROM {pages}""",
)
def clean_markup(v):
    return v.pages.select("page_id", H.clean_markup(F.col("html")).alias("html"))


# Cut at every angle bracket, not by a pattern of elements: runs are numbered by the block tags before them.
RUNS_SQL = f"""
cut AS (SELECT page_id, string_split({S.no_noise("coalesce(nullif(regexp_extract(html, '(?is)<body[^>]*>(.*?)(?:</body\\s*>|\\z)', 1), ''), html)")}, '<') AS c FROM pages),
part AS (SELECT page_id, unnest(c) AS c, unnest(range(1, len(c) + 1)) AS i FROM cut),
mark AS (SELECT page_id, i, CASE WHEN i > 1 AND contains(c, '>') THEN split_part(c, '>', 1) ELSE '' END AS tag,
    CASE WHEN i = 1 THEN c WHEN contains(c, '>') THEN substr(c, strpos(c, '>') + 1) ELSE '<' || c END AS t FROM part),
named AS (SELECT *, lower(regexp_extract(tag, '^/?([a-zA-Z0-9]+)', 1)) AS name, starts_with(tag, '/') AS close FROM mark),
bordered AS (SELECT *, name IN ({", ".join(f"'{x}'" for x in ["hr", *H.CONTAINERS, *H.LEAVES])}) AS border FROM named),
numbered AS (SELECT *, sum(CASE WHEN border THEN 1 ELSE 0 END) OVER (PARTITION BY page_id ORDER BY i) AS run FROM bordered),
runs AS (SELECT page_id, run, max(name) FILTER (border) AS name, bool_or(close) FILTER (border) AS close,
    {S.clean(S.unescape(f"string_agg({S.strip('t')}, ' ' ORDER BY i) FILTER ({S.strip('t')} <> '')"))} AS text FROM numbered GROUP BY page_id, run)"""
HOLDS_SQL = ", ".join(f"'{x}'" for x in H.CONTAINERS)
LEAF_SQL = ", ".join(f"'{x}'" for x in H.LEAVES)


@reg.query(
    "page_blocks",
    f"""WITH {RUNS_SQL},
    deep AS (SELECT *, name IN ({HOLDS_SQL}) AS holds, name IN ({LEAF_SQL}) AS leaf,
        sum(CASE WHEN name IN ({HOLDS_SQL}) THEN CASE WHEN close THEN -1 ELSE 1 END ELSE 0 END) OVER (PARTITION BY page_id ORDER BY run) AS depth FROM runs),
    inner_tag AS (SELECT *,
        last_value(CASE WHEN holds AND NOT close THEN name END IGNORE NULLS) OVER w AS container,
        last_value(CASE WHEN holds AND NOT close THEN '' WHEN leaf AND name <> 'p' THEN CASE WHEN close THEN '' ELSE name END END IGNORE NULLS) OVER w AS open_leaf
        FROM deep WINDOW w AS (PARTITION BY page_id, depth ORDER BY run))
    SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY run) AS pos,
        CASE WHEN leaf AND NOT close THEN name ELSE coalesce(nullif(open_leaf, ''), container, 'body') END AS tag, text
    FROM inner_tag WHERE text <> ''""",
)
def page_blocks(v):
    from ..operators.links import block_table

    return block_table(v.pages, "page_id", "html")


@reg.query(
    "plain_text",
    f"""WITH {RUNS_SQL}
        SELECT p.page_id, coalesce(string_agg(r.text, chr(10) ORDER BY r.run), '') AS text FROM pages p LEFT JOIN runs r ON r.page_id = p.page_id AND r.text <> '' GROUP BY p.page_id""",
)
def plain_text(v):
    return v.pages.select("page_id", H.plain_text(F.col("html")).alias("text"))


BODY_SQL = r"regexp_extract(html, '(?is)<body[^>]*>(.*?)(?:</body\s*>|\z)', 1)"


@reg.query(
    "strip_heading",
    f"""WITH b AS (SELECT page_id, {BODY_SQL} AS body, {S.unescape("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title', 1)")} AS title FROM pages),
        h AS (SELECT *, regexp_extract(body, '(?is)<h1[^>]*>.*?</h1\\s*>') AS h FROM b)
        SELECT page_id, {S.strip(f"CASE WHEN h <> '' AND {S.tag_text('h')} = title THEN replace(body, h, '') ELSE body END")} AS answer FROM h""",
)
def strip_heading(v):
    return v.pages.select("page_id", H.answer_body(F.col("html")).alias("answer"))


@reg.query(
    "unwrap_code_images",
    """SELECT id, '<p>' || lang || '</p>' || CASE WHEN lang = 'en' THEN '<img alt="' || space || '" src="asset://' || id || '"/>'
         ELSE '<pre><code>' || space || '</code></pre>' END || body AS body FROM {v_article}""",
)
def unwrap_code_images(v):
    code = F.when(
        F.col("lang") == "en", F.concat(F.lit("\n  !["), "space", F.lit("](asset://"), "id", F.lit(")\n"))
    ).otherwise(F.col("space"))
    markup = F.concat(
        F.lit("<p>"), F.col("lang"), F.lit("</p><pre><code>"), code, F.lit("</code></pre>"), "body"
    )
    return v.v_article.select("id", H.unwrap_code_images(markup).alias("body"))


FIRST_VALUE_SQL = (
    f"SELECT p_partkey AS id, coalesce(nullif({S.clean('CASE WHEN p_size > 30 THEN p_brand END')}, ''), "
    f"nullif({S.clean(chr(39) + '  ' + chr(39) + ' || CASE WHEN p_size < 20 THEN p_type ELSE ' + chr(39) * 2 + ' END')}, ''), p_name) AS value FROM {{part}}"
)


@reg.query("first_value", FIRST_VALUE_SQL)
def first_value(v):
    from ..operators.catalog import first_value as pick

    size = F.col("p_size")
    return v.part.select(
        F.col("p_partkey").alias("id"),
        pick(
            F.when(size > 30, F.col("p_brand")),
            F.concat(F.lit("  "), F.when(size < 20, F.col("p_type")).otherwise(F.lit(""))),
            F.col("p_name"),
        ).alias("value"),
    )


VALUE = "CASE p_type WHEN 'PROMO' THEN 'https://dl.example.com/' || p_brand || '.ZIP?x=1' WHEN 'LARGE' THEN '/files/' || p_name || '.exe' WHEN 'SMALL' THEN p_name || '.pdf' WHEN 'MEDIUM' THEN p_name || '.png' ELSE ' http://dl.example.com/a.json ' END"


@reg.query("file_like", "SELECT p_partkey AS id, p_type IN ('PROMO', 'LARGE', 'SMALL') AS file_like FROM {part}")
def file_like(v):
    return v.part.select(F.col("p_partkey").alias("id"), T.is_file_like(F.expr(VALUE)).alias("file_like"))


@reg.query(
    "resolve_file_value",
    """SELECT p_partkey AS id, CASE p_type WHEN 'PROMO' THEN 'https://dl.example.com/' || p_brand || '.ZIP?x=1' WHEN 'LARGE' THEN 'https://site.example.com/files/' || p_name || '.exe'
         WHEN 'SMALL' THEN '' WHEN 'MEDIUM' THEN '' ELSE 'http://dl.example.com/a.json' END AS url,
         CASE WHEN p_type IN ('SMALL', 'MEDIUM') THEN 'filename_only_unresolved' WHEN p_type = 'LARGE' THEN 'relative_url' ELSE 'direct_url' END AS status FROM {part}""",
)
def resolve_file_value(v):
    from ..operators.catalog import resolve_file_value as resolve

    url, status = resolve(F.expr(VALUE), F.lit("https://site.example.com/admin/"))
    return v.part.select(F.col("p_partkey").alias("id"), url.alias("url"), status.alias("status"))
