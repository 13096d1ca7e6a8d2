"""Links, references and storage markup over pages and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import catalog as C
from ..operators import links as L
from ..operators import markup as M
from . import sql as S
from .registry import Registry

reg = Registry()
QUERIES, ORACLES = reg.queries, reg.oracles

WIKI = "https://wiki.example.com"


@reg.query("link_inventory", f"WITH {S.ANCHORS} SELECT page_id, pos, href, label FROM anchors")
def link_inventory(v):
    return L.link_inventory(v.pages, "page_id", "html")


# Every page's own address and its links; link targets vary over all classes.
SPREAD = """CASE WHEN {h} LIKE '/d%' THEN 'https://www.dropbox.com/s' || {h} WHEN {h} LIKE '/a%' THEN '//x.atlassian.net/wiki' || {h}
 WHEN {h} LIKE '/t%' THEN 'https://youtu.be' || {h} WHEN {h} LIKE '/w%' THEN 'https://help.example.com/s/article' || {h}
 WHEN {h} LIKE '/l%' THEN 'https://help.example.com/s/topic' || {h} WHEN {h} LIKE '/e%' THEN 'https://www.example.com' || {h}
 WHEN {h} LIKE '/o%' THEN {h} || '.PDF?dl=1' WHEN {h} LIKE '/s%' THEN 'http://other.org' || {h} WHEN {h} LIKE '/p%' THEN '' ELSE {h} END"""
CLASSES_SQL = f"""classed AS (SELECT page_id, pos, CASE WHEN href LIKE '/d%' THEN 'dropbox' WHEN href LIKE '/a%' THEN 'confluence'
  WHEN href LIKE '/t%' THEN 'video' WHEN href LIKE '/w%' THEN 'article' WHEN href LIKE '/l%' THEN 'topic' WHEN href LIKE '/e%' THEN 'site'
  WHEN href LIKE '/o%' THEN CASE WHEN contains(href, '#') OR contains(href, '?') THEN 'relative_or_internal' ELSE 'download' END
  WHEN href LIKE '/s%' THEN 'external' WHEN href LIKE '/p%' THEN 'empty' ELSE 'relative_or_internal' END AS type FROM anchors)"""


def _classed(v):
    links = L.link_inventory(v.pages, "page_id", "html")
    return links.select("page_id", "pos", L.link_classes(F.expr(SPREAD.format(h="href"))).alias("type"))


@reg.query("link_classes", f"WITH {S.ANCHORS}, {CLASSES_SQL} SELECT page_id, pos, type FROM classed")
def link_classes(v):
    return _classed(v)


@reg.query("link_type_counts", f"WITH {S.ANCHORS}, {CLASSES_SQL} SELECT type, count(*) AS links FROM classed GROUP BY type")
def link_type_counts(v):
    return L.link_type_counts(_classed(v))


@reg.query(
    "article_url_list",
    f"""WITH {S.ANCHORS} SELECT DISTINCT regexp_extract(full_url, '^([^?#]*)', 1) || '?language=en_US' AS url
        FROM (SELECT regexp_extract(url, '^([a-z]+://[^/]+)', 1) || href AS full_url FROM anchors) WHERE contains(full_url, '.example.net/')""",
)
def article_url_list(v):
    links = L.link_inventory(v.pages, "page_id", "html", carry=["url"])
    origin = F.regexp_extract("url", r"\A([a-z]+://[^/]+)", 1)
    return L.article_urls(links, F.col("href"), ".example.net/", origin)


@reg.query(
    "catalogue_listing",
    f"""WITH {S.ANCHORS}, m AS (SELECT page_id, pos, 'https://site.example.com/wp-admin/post.php?post=' || href[2:] || '&action=edit' AS edit_url, {S.clean('label')} AS title FROM anchors)
        SELECT coalesce(nullif(regexp_extract(edit_url, '^[^?#]*\\?(?:[^&#]*&)*?post=([^&#]+)', 1), ''), '') AS post_id, max_by(title, page_id * 100000 + pos) AS post_title, edit_url,
               min(page_id * 100000 + pos) // 100000 AS listing_page, min(page_id * 100000 + pos) % 100000 AS position FROM m GROUP BY edit_url""",
)
def catalogue_listing(v):
    listing = F.regexp_replace(
        "html", r'<a href="/([^"]*)">', '<a class="row-title" href="post.php?post=$1&amp;action=edit">'
    )
    pages = v.pages.select("page_id", listing.alias("html"))
    links = L.link_inventory(pages, "page_id", "html")
    return C.listing(links, "https://site.example.com/wp-admin/")


LABEL_SQL = """CASE WHEN regexp_matches(word, '^[a-h]') THEN clean WHEN regexp_matches(word, '^[i-p]') THEN clean || ' file'
  WHEN regexp_matches(word, '^[q-z]') THEN 'get ' || clean || ' here' ELSE 'Download ' || cast(pos AS varchar) END"""


@reg.query(
    "download_labels",
    f"""WITH {S.ANCHORS}, w AS (SELECT page_id, pos, href, regexp_extract(url, '^([a-z]+://[^/]+)', 1) || href || '?dl=1' AS url, href[2:] AS word, {S.clean('href[2:]')} AS clean FROM anchors)
        SELECT page_id, pos - 1 AS index, label, url FROM (SELECT page_id, pos, url, {LABEL_SQL} AS label, row_number() OVER (PARTITION BY page_id, url ORDER BY pos) AS rn FROM w) WHERE rn = 1""",
)
def download_labels(v):
    html = F.col("html")
    for letters, shape in (
        ("[a-h]", '<a href="/$1?dl=1">$1</a>'),
        ("[i-p]", '<a href="/$1?dl=1" title="$1 file"> </a>'),
        ("[q-z]", 'get <a href="/$1?dl=1"></a> $1 here'),
        ("[^a-z]", '<a href="/$1?dl=1"></a>'),
    ):
        html = F.regexp_replace(html, rf'<a href="/({letters}[^"?]*)">[^<]*</a>', shape)
    pages = v.pages.select("page_id", "url", html.alias("html"))
    origin = F.regexp_extract("url", r"\A([a-z]+://[^/]+)", 1)
    return C.download_labels(pages, "page_id", "html", origin, "dl=1").select(
        "page_id", F.col("index").cast("bigint").alias("index"), "label", "url"
    )


def _images(v):
    html = F.regexp_replace("html", r'<a href="/([^"]*)">', '<img alt="none"><img src="/$1.png"/>')
    pages = v.pages.select("page_id", "url", html.alias("html"))
    origin = F.regexp_extract("url", r"\A([a-z]+://[^/]+)", 1)
    return C.images(pages, "page_id", "html", origin)


@reg.query("image_names", f"WITH {S.ANCHORS} SELECT page_id, pos AS ordinal, href || '.png' AS src, 'image_' || lpad(cast(pos AS varchar), 3, '0') || '.png' AS image_name FROM anchors")
def image_names(v):
    return _images(v).select("page_id", "ordinal", "src", "image_name")


TOTALS_SQL = f"""{S.ANCHORS}, imgs AS (SELECT a.page_id, a.pos, regexp_extract(a.url, '^([a-z]+://[^/]+)', 1) || a.href || '.png' AS image_url, coalesce(f.http_status = 200, false) AS ok
   FROM anchors a LEFT JOIN (SELECT page_id, max_by(coalesce(http_status, 0), event_id) AS http_status FROM {{v_fetch}} GROUP BY page_id) f ON a.page_id = f.page_id),
 totals AS (SELECT p.page_id, p.url, p.html, count(i.page_id) AS image_count, coalesce(string_agg(i.image_url, ' | ' ORDER BY i.pos) FILTER (WHERE NOT i.ok), '') AS failed_images
   FROM pages p LEFT JOIN imgs i ON i.page_id = p.page_id GROUP BY p.page_id, p.url, p.html)"""


def _totals(v, *columns):
    # The last response for a page counts.
    last = F.max_by(F.coalesce(F.col("http_status"), F.lit(0)), "event_id")
    ok = v.v_fetch.groupBy("page_id").agg((last == 200).alias("ok"))
    found = _images(v).join(ok, "page_id", "left").withColumn("ok", F.coalesce("ok", F.lit(False)))
    return C.image_totals(v.pages.select("page_id", *columns), found, "page_id")


@reg.query("image_totals", f"WITH {TOTALS_SQL} SELECT page_id, image_count, failed_images FROM totals")
def image_totals(v):
    return _totals(v).withColumn("failed_images", T.list_text(F.col("failed_images")))


@reg.query(
    "package_metadata",
    f"""WITH {TOTALS_SQL}, t AS (SELECT *, {S.unescape("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title', 1)")} AS title FROM totals)
        SELECT 'knowledge base' AS source_system, title, {S.clean(S.tag_text("regexp_extract(html, '(?is)<div class=.ad.>.*?</div>')"))} AS summary, url AS source_url,
          trim(regexp_replace({S.strip('title')}, '[^a-zA-Z0-9]+', '-', 'g'), '-') AS slug, 'packages/' || trim(regexp_replace({S.strip('title')}, '[^a-zA-Z0-9]+', '-', 'g'), '-') AS package_folder,
          image_count, failed_images, 'packaged' AS status FROM t""",
)
def package_metadata(v):
    from ..functions import html as H

    summary = T.clean_text(H.tag_text(F.regexp_extract("html", r'(?is)<div class="ad">.*?</div>', 0)))
    articles = _totals(v, "url", "html").select(
        H.document_title(F.col("html")).alias("title"), summary.alias("summary"),
        F.col("url").alias("source_url"), "image_count", T.list_text(F.col("failed_images")).alias("failed_images"),
    )
    return C.package_metadata(articles, "knowledge base")


@reg.query(
    "original_url",
    f"""WITH {S.ANCHORS}, first_link AS (SELECT page_id, min_by(href, pos) AS href FROM anchors WHERE NOT regexp_matches(href, '^/[t-z]') GROUP BY page_id)
        SELECT p.page_id, CASE WHEN contains(p.url, '/en/') AND p.url LIKE 'https%' THEN 'https://x.example.com/uploads/a.png' WHEN contains(p.url, '/en/') THEN 'http://y.example.com/b.png'
          ELSE coalesce('/uploads' || l.href || '.png', '') END AS original_url FROM pages p LEFT JOIN first_link l ON l.page_id = p.page_id""",
)
def original_url(v):
    hrefs = F.transform(
        F.regexp_extract_all(F.col("html"), F.lit(r'<a href="([^"]*)">'), F.lit(1)),
        lambda h: F.concat(F.lit("/uploads"), h, F.when(h.rlike("^/[t-z]"), F.lit("-150x150.png")).otherwise(F.lit(".png"))),
    )
    english = F.col("url").contains("/en/")
    field = F.when(english & F.col("url").startswith("https"), F.lit("  https://x.example.com/uploads/a.png ")).otherwise("a.png")
    attribute = F.when(english, F.lit("http://y.example.com/b.png"))
    return v.pages.select("page_id", C.original_url(field, attribute, hrefs).alias("original_url"))


# ---- storage markup -------------------------------------------------------

# Title targets: nations of the root region are packaged, all nations are listed.
TITLES_SQL = """title_map AS (SELECT n_name AS title, CASE WHEN n_regionkey = 1 THEN 'knowledge://wiki-nation-' || cast(n_nationkey AS varchar)
   ELSE 'https://wiki.example.com/wiki/spaces/NATION/pages/nation-' || cast(n_nationkey AS varchar) END AS address FROM nation)"""


def titles(v):
    packaged = v.nation.filter("n_regionkey = 1").select(
        F.col("n_name").alias("title"),
        F.concat(F.lit("wiki-nation-"), F.col("n_nationkey").cast("string")).alias("uri_id"),
        F.col("n_nationkey").cast("string").alias("id"),
    )
    listed = v.nation.select(
        F.col("n_name").alias("title"),
        F.concat(F.lit(f"{WIKI}/wiki/spaces/NATION/pages/nation-"), F.col("n_nationkey").cast("string")).alias("url"),
    )
    return M.title_map(packaged, listed)


def attachments(v):
    return v.v_doc_attachment.withColumn("asset_id", T.stable_id("wiki-attachment", F.col("id")))


def bodies(v, *parts):
    return v.v_markup.select("id", "title", F.concat(F.lit("wiki-"), "id").alias("uri_id"), F.concat(*parts).alias("body"))


# What each piece of markup must become, told from the document's own columns.
LINK_OUT = f"""CASE m.link_kind
  WHEN 'page' THEN '<a href="' || coalesce(t.address || '#top', '') || '">see &lt;' || m.space || '&gt;</a>'
  WHEN 'missing' THEN '<a href="">' || m.link_title || '</a>'
  WHEN 'url' THEN '<a href="https://ext.example.com/?a=1&amp;d=' || m.external_id || '">go there</a>'
  WHEN 'attachment' THEN '<a href="' || CASE WHEN m.lang IN ('en', 'fr') THEN 'asset://wiki-attachment-' || m.external_id || '-a' ELSE '' END || '">file-' || m.external_id || '.pdf</a>'
  WHEN 'space' THEN '<a href="https://wiki.example.com/wiki/spaces/' || upper(m.space) || '">' || upper(m.space) || '</a>'
  WHEN 'self' THEN '<a href="' || CASE WHEN {S.strip('m.title')} <> '' AND ends_with({S.fold('m.title')}, {S.fold(S.strip('lower(m.title)'))}) THEN 'knowledge://wiki-' || m.id ELSE '' END || '">' || replace(replace(replace({S.strip('lower(m.title)')}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</a>'
  ELSE '<a href="">nowhere</a>' END"""
IMAGE_ASSET = "CASE WHEN m.lang = 'fr' THEN 'asset://wiki-attachment-' || m.external_id || '-e' WHEN m.lang = 'de' THEN '' ELSE 'asset://wiki-attachment-' || m.external_id || '-b' END"
IMAGE_OUT = f"""'<img alt="img ' || m.space || '.png" src="' || {IMAGE_ASSET} || '"/>'"""
ANCHOR_OUT = f"""CASE WHEN m.lang = 'de' THEN m.anchor_html ELSE '<a class="x" href="' || {IMAGE_ASSET} || '">img</a>' END"""
FILE_OK = "m.lang IN ('en', 'fr')"
MACRO_OUT = """CASE m.macro_kind
  WHEN 'code' THEN '<pre><code>if x &lt; 1 &amp;&amp; y: ' || m.lang || '</code></pre>'
  WHEN 'info' THEN '<blockquote>INFO: Note' || chr(10) || 'bold' || chr(10) || m.lang || '</blockquote>'
  WHEN 'status' THEN '<span>[Status: DONE ' || m.lang || ']</span>'
  WHEN 'view-file' THEN CASE WHEN m.lang IN ('en', 'fr') THEN '<a href="asset://wiki-attachment-' || m.external_id || '-a">file-' || m.external_id || '.pdf</a>' ELSE '<div>[Confluence macro: view-file]</div>' END
  WHEN 'drawio' THEN '<div>' || CASE WHEN m.lang IN ('en', 'es') THEN '<img alt="diagram ' || m.space || '" src="asset://wiki-attachment-' || m.external_id || '-d"/>' ELSE '' END
     || CASE WHEN m.lang <> 'es' THEN '<a href="asset://wiki-attachment-' || m.external_id || '-c">Download diagram ' || m.space || '</a>' ELSE '' END || '</div>'
  WHEN 'toc' THEN '<div>[Confluence macro: toc]</div>'
  WHEN 'nested' THEN '<blockquote>PANEL: before' || chr(10) || upper(m.lang) || '-1' || chr(10) || 'after</blockquote>'
  ELSE '' END"""
FROM_MARKUP = "FROM {v_markup} m LEFT JOIN title_map t ON t.title = m.link_title AND m.link_kind = 'page'"


@reg.query(
    "page_references",
    """SELECT link_title AS title, space_key FROM (SELECT link_title, CASE WHEN link_kind = 'page' THEN upper(lang) END AS space_key,
         row_number() OVER (PARTITION BY link_title ORDER BY id DESC) AS rn FROM {v_markup} WHERE link_kind IN ('page', 'missing')) WHERE rn = 1""",
)
def page_references(v):
    return M.page_references(bodies(v, "text_html", "link_html"))


@reg.query("resolve_page_links", f"WITH {TITLES_SQL} SELECT m.id, m.text_html || {LINK_OUT} AS body {FROM_MARKUP}")
def resolve_page_links(v):
    return M.convert(bodies(v, "text_html", "link_html"), attachments(v), titles(v), kinds=["link"], base_url=WIKI).select("id", "body")


@reg.query("confluence_links", f"WITH {TITLES_SQL} SELECT m.id, m.text_html || {LINK_OUT} || m.image_html AS body {FROM_MARKUP}")
def confluence_links(v):
    source = bodies(v, "text_html", "link_html", "image_html")
    return M.convert(source, attachments(v), titles(v), kinds=["link"], base_url=WIKI).select("id", "body")


@reg.query("resolve_images", f"SELECT m.id, m.text_html || {IMAGE_OUT} || m.link_html AS body FROM {{v_markup}} m")
def resolve_images(v):
    source = bodies(v, "text_html", "image_html", "link_html")
    return M.convert(source, attachments(v), titles(v), kinds=["image"]).select("id", "body")


@reg.query("resolve_asset_links", f"SELECT m.id, {ANCHOR_OUT} || m.text_html || {ANCHOR_OUT} AS body FROM {{v_markup}} m")
def resolve_asset_links(v):
    source = bodies(v, "anchor_html", "text_html", "anchor_html")
    return M.convert(source, attachments(v), titles(v), kinds=["anchor"]).select("id", "body")


@reg.query("macro_rewrite", f"SELECT m.id, m.text_html || {MACRO_OUT} || m.text_html || {MACRO_OUT} AS body FROM {{v_markup}} m")
def macro_rewrite(v):
    source = bodies(v, "text_html", "macro_html", "text_html", "macro_html")
    return M.convert(source, attachments(v), titles(v), kinds=["macro"]).select("id", "body")


CONVERTED_SQL = f"m.text_html || {LINK_OUT} || {IMAGE_OUT} || {ANCHOR_OUT} || {MACRO_OUT}"
WARN_SQL = f"""warned AS (
  SELECT m.id, 0 AS stage, 'Unsupported Confluence macro preserved as text: ' || CASE m.macro_kind WHEN 'nested' THEN 'jira' ELSE m.macro_kind END AS warning FROM {{v_markup}} m
    WHERE m.macro_kind IN ('toc', 'nested') OR (m.macro_kind = 'view-file' AND NOT {FILE_OK})
  UNION ALL SELECT m.id, 1, CASE m.link_kind WHEN 'page' THEN 'Unresolved Confluence page link: ' || m.link_title WHEN 'missing' THEN 'Unresolved Confluence page link: ' || m.link_title
      WHEN 'attachment' THEN 'Unresolved Confluence attachment link: file-' || m.external_id || '.pdf' ELSE 'Unresolved Confluence link without page or URL target' END {FROM_MARKUP}
    WHERE (m.link_kind = 'page' AND t.address IS NULL) OR m.link_kind IN ('missing', 'none') OR (m.link_kind = 'attachment' AND NOT {FILE_OK})
       OR (m.link_kind = 'self' AND NOT ({S.strip('m.title')} <> '' AND ends_with({S.fold('m.title')}, {S.fold(S.strip('lower(m.title)'))})))
  UNION ALL SELECT m.id, 2, 'Embedded image was not mirrored: img ' || m.space || '.png' FROM {{v_markup}} m WHERE m.lang = 'de')"""


def converted(v):
    source = bodies(v, "text_html", "link_html", "image_html", "anchor_html", "macro_html")
    return M.convert(source, attachments(v), titles(v), base_url=WIKI)


@reg.query("link_warnings", f"WITH {TITLES_SQL}, {WARN_SQL} SELECT b.id, coalesce(string_agg(w.warning, ' | ' ORDER BY w.stage), '') AS warnings, count(w.id) AS warning_count FROM {{v_markup}} b LEFT JOIN warned w ON w.id = b.id GROUP BY b.id")
def link_warnings(v):
    return converted(v).select("id", T.list_text(F.col("warnings")).alias("warnings"), F.size("warnings").cast("bigint").alias("warning_count"))


# Cross-space candidates: every customer, most of them in a second space too.
CANDIDATES_SQL = """candidates AS (SELECT c_name AS title, 'c-' || cast(c_custkey AS varchar) AS page_id, '/spaces/' || c_mktsegment || '/pages/' || cast(c_custkey AS varchar) AS webui, c_custkey AS seq FROM customer
   UNION ALL SELECT upper(c_name), 'o-' || cast(c_custkey AS varchar), CASE WHEN c_acctbal < 0 THEN '' ELSE '/spaces/EN/pages/' || cast(c_custkey AS varchar) END, c_custkey + 100000000 FROM customer WHERE c_nationkey >= 10)"""
CROSS_SQL = f"""WITH {CANDIDATES_SQL}, refs AS (SELECT link_title AS title, max(upper(lang)) AS space_key FROM {{v_markup}} WHERE link_kind = 'missing' GROUP BY link_title),
 m AS (SELECT r.title, r.space_key, c.page_id, c.webui, c.seq, coalesce(contains(c.webui, '/spaces/' || r.space_key || '/'), false) AS inside FROM refs r LEFT JOIN candidates c ON lower(c.title) = lower(r.title)),
 p AS (SELECT title, space_key, count(page_id) AS n, max(inside) AS any_inside, min_by(page_id, CASE WHEN inside THEN 0 ELSE 1000000000000 END + seq) AS page_id, min_by(webui, CASE WHEN inside THEN 0 ELSE 1000000000000 END + seq) AS webui FROM m GROUP BY ALL)
 SELECT title, space_key, CASE WHEN (any_inside OR n = 1) AND webui <> '' THEN page_id END AS page_id, CASE WHEN (any_inside OR n = 1) AND webui <> '' THEN 'https://wiki.example.com/wiki' || webui END AS url FROM p"""


def _cross(v):
    name, key = F.col("c_name"), F.col("c_custkey").cast("string")
    first = v.customer.select(
        name.alias("title"), F.concat(F.lit("c-"), key).alias("id"),
        F.concat(F.lit("/spaces/"), "c_mktsegment", F.lit("/pages/"), key).alias("webui"), F.col("c_custkey").alias("seq"),
    )
    second = v.customer.filter("c_nationkey >= 10").select(
        F.upper(name).alias("title"), F.concat(F.lit("o-"), key).alias("id"),
        F.when(F.col("c_acctbal") < 0, F.lit("")).otherwise(F.concat(F.lit("/spaces/EN/pages/"), key)).alias("webui"),
        (F.col("c_custkey") + 100000000).alias("seq"),
    )
    # Ask by the language that sorts last per title.
    refs = v.v_markup.filter("link_kind = 'missing'").groupBy(F.col("link_title").alias("title")).agg(
        F.max(F.upper("lang")).alias("space_key")
    )
    return M.cross_space(refs, titles(v), first.unionByName(second), WIKI)


@reg.query("resolve_cross_space", CROSS_SQL)
def resolve_cross_space(v):
    return _cross(v)


UNRESOLVED_SQL = CROSS_SQL.replace(" SELECT title, space_key, CASE", ", resolved AS (SELECT title, space_key, CASE") + ") SELECT title FROM resolved WHERE url IS NULL"


@reg.query("unresolved_titles", UNRESOLVED_SQL)
def unresolved_titles(v):
    return _cross(v).filter("url IS NULL").select("title").orderBy("title")
