"""Corpus-shaped views over the given tables.

Each view is one SQL text that both Spark and the check database understand;
``SHA256<<x>>`` is the only spot where the two dialects are spelled differently.
Placeholders in braces name a table or another view.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

EXTENSION_OF_PART = """CASE p_type WHEN 'MEDIUM' THEN '.png' WHEN 'ECONOMY' THEN '.jpg'
  WHEN 'LARGE' THEN '.pdf' WHEN 'STANDARD' THEN '.tar.zip' WHEN 'SMALL' THEN '.webp' ELSE '.drawio' END"""

# Spaces (sources) whose records are absent from one side of a comparison, so
# that joins meet misses on both sides.
VIEWS = {
    # One article per document; the title is the first line.
    "v_article": """
SELECT 'doc-' || cast(doc_id AS string) AS id, cast(doc_id AS string) AS external_id,
       split_part(text, chr(10), 1) AS title, text AS body, lang, source AS space, doc_id AS seq
FROM {documents}""",
    # Page hierarchy over the star schema's foreign keys.
    "v_tree": """
SELECT 'region-' || cast(r_regionkey AS string) AS id, cast(NULL AS string) AS parent_id, r_name AS title,
       cast(r_regionkey AS bigint) AS position, cast(r_regionkey AS bigint) AS seq, 'region' AS kind, 'current' AS status FROM {region}
UNION ALL SELECT 'nation-' || cast(n_nationkey AS string), 'region-' || cast(n_regionkey AS string), n_name,
       cast(n_nationkey AS bigint), cast(n_nationkey AS bigint), 'nation', 'current' FROM {nation}
UNION ALL SELECT 'supplier-' || cast(s_suppkey AS string), 'nation-' || cast(s_nationkey AS string), s_name,
       cast(floor(s_acctbal) AS bigint), s_suppkey, 'supplier', 'archived' FROM {supplier}
UNION ALL SELECT 'customer-' || cast(c_custkey AS string), 'nation-' || cast(c_nationkey AS string), c_name,
       cast(floor(c_acctbal) AS bigint), c_custkey, 'customer', lower(c_mktsegment) FROM {customer}
UNION ALL SELECT 'order-' || cast(o_orderkey AS string), 'customer-' || cast(o_custkey AS string), o_orderpriority,
       cast(floor(o_totalprice) AS bigint), o_orderkey, 'order',
       CASE o_orderstatus WHEN 'F' THEN 'Current' WHEN 'O' THEN 'draft' ELSE 'trashed' END FROM {orders}""",
    # Attachments of the order pages.
    "v_attachment": f"""
SELECT 'order-' || cast(l_orderkey AS string) AS page_id,
       cast(l_orderkey AS string) || '-' || cast(l_linenumber AS string) || '-' || cast(l_partkey AS string) || '-' || cast(l_suppkey AS string) AS id,
       p_name || {EXTENSION_OF_PART} AS title, cast(l_quantity * 1048576 AS bigint) AS size_bytes,
       CASE l_returnflag WHEN 'N' THEN 'available' WHEN 'R' THEN 'failed' ELSE 'unavailable' END AS status,
       cast(l_linenumber AS bigint) AS version, SHA256<<p_brand || ':' || p_type || ':' || cast(l_linenumber AS string)>> AS sha256,
       cast(l_partkey AS bigint) AS part
FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey""",
    # Canonical assets; one part size has no asset record.
    "v_asset": f"""
SELECT 'asset-' || cast(p_partkey AS string) AS id, p_name || {EXTENSION_OF_PART} AS filename,
       cast(p_size AS bigint) * 1048576 AS size_bytes, SHA256<<p_brand || ':' || p_type>> AS sha256,
       p_brand AS container, p_partkey AS seq
FROM {{part}} WHERE p_size <> 7""",
    # Which article (supplier) refers to which asset, and by which element.
    "v_ref": """
SELECT DISTINCT 'supplier-' || cast(l_suppkey AS string) AS article_id, 'asset-' || cast(l_partkey AS string) AS asset_id,
       CASE WHEN p_type IN ('MEDIUM', 'ECONOMY', 'SMALL') THEN 'img' ELSE 'a' END AS kind
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey""",
    # Crawl log: one row per attempt.
    "v_snapshot": """
SELECT 'user-' || cast(user_id AS string) AS page_id, cast(regexp_extract(props, '([0-9]+)', 1) AS bigint) AS version,
       ts, event_type, event_id AS seq, value,
       CASE event_type WHEN 'view' THEN 'mirrored' WHEN 'click' THEN 'resumed' WHEN 'signup' THEN 'mirrored'
            WHEN 'purchase' THEN 'resumed' ELSE 'failed' END AS status
FROM {events}""",
    # Wiki storage markup of every document: text, one link, one image, one
    # download address and one macro, each kind chosen by the document's space.
    "v_markup": """
SELECT id, external_id, title, lang, space, seq, link_kind, macro_kind, link_title,
  '<p>' || replace(replace(replace(body, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</p>' AS text_html,
  CASE link_kind
    WHEN 'page' THEN '<ac:link ac:anchor="top"><ri:page ri:space-key="' || upper(lang) || '" ri:content-title="' || link_title || '" /><ac:plain-text-link-body><![CDATA[see <' || space || '>]]></ac:plain-text-link-body></ac:link>'
    WHEN 'missing' THEN '<ac:link><ri:page ri:content-title="' || link_title || '"/></ac:link>'
    WHEN 'url' THEN '<ac:link><ri:url ri:value="https://ext.example.com/?a=1&amp;d=' || external_id || '" /><ac:link-body>go <b>there</b></ac:link-body></ac:link>'
    WHEN 'attachment' THEN '<ac:link><ri:attachment ri:filename="file-' || external_id || '.pdf" /></ac:link>'
    WHEN 'space' THEN '<ac:link><ri:space ri:space-key="' || upper(space) || '" /></ac:link>'
    WHEN 'self' THEN '<ac:link><ac:link-body>' || lower(replace(replace(replace(title, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')) || '</ac:link-body></ac:link>'
    ELSE '<ac:link><ac:link-body>nowhere</ac:link-body></ac:link>' END AS link_html,
  '<ac:image ac:width="10"><ri:attachment ri:filename="img ' || space || '.png" /></ac:image>' AS image_html,
  '<a class="x" href="https://wiki.example.com/download/attachments/9/img%20' || space || '.png?version=1&amp;api=v2">img</a>' AS anchor_html,
  CASE macro_kind
    WHEN 'code' THEN '<ac:structured-macro ac:name="code"><ac:parameter ac:name="language">py</ac:parameter><ac:plain-text-body><![CDATA[if x < 1 && y: ' || lang || ']]></ac:plain-text-body></ac:structured-macro>'
    WHEN 'info' THEN '<ac:structured-macro ac:name="info"><ac:rich-text-body><p>Note <b>bold</b> ' || lang || '</p></ac:rich-text-body></ac:structured-macro>'
    WHEN 'status' THEN '<ac:structured-macro ac:name="status"><ac:parameter ac:name="colour">Green</ac:parameter><ac:parameter ac:name="title">DONE ' || lang || '</ac:parameter></ac:structured-macro>'
    WHEN 'view-file' THEN '<ac:structured-macro ac:name="view-file"><ac:parameter ac:name="name"><ri:attachment ri:filename="file-' || external_id || '.pdf" /></ac:parameter></ac:structured-macro>'
    WHEN 'drawio' THEN '<ac:structured-macro ac:name="drawio"><ac:parameter ac:name="diagramName">diagram ' || space || '</ac:parameter></ac:structured-macro>'
    WHEN 'toc' THEN '<ac:structured-macro ac:name="toc" ac:schema-version="1" />'
    WHEN 'nested' THEN '<ac:structured-macro ac:name="panel"><ac:rich-text-body><p>before</p><ac:structured-macro ac:name="jira"><ac:parameter ac:name="key">' || upper(lang) || '-1</ac:parameter></ac:structured-macro><p>after</p></ac:rich-text-body></ac:structured-macro>'
    ELSE '' END AS macro_html
FROM (SELECT *,
  CASE WHEN space IN ('src17', 'src18', 'src19') THEN 'missing' WHEN space = 'src12' THEN 'url' WHEN space = 'src13' THEN 'attachment'
       WHEN space = 'src14' THEN 'space' WHEN space = 'src15' AND title <> '' THEN 'self' WHEN space IN ('src15', 'src16') THEN 'none' ELSE 'page' END AS link_kind,
  CASE WHEN space IN ('src17', 'src18') THEN 'CUSTOMER#' || lpad(external_id, 9, '0') WHEN space = 'src19' THEN 'Missing page'
       ELSE 'NATION_' || replace(space, 'src', '') END AS link_title,
  CASE WHEN space IN ('src0', 'src1') THEN 'code' WHEN space IN ('src2', 'src3') THEN 'info' WHEN space IN ('src4', 'src5') THEN 'status'
       WHEN space IN ('src6', 'src7') THEN 'view-file' WHEN space IN ('src8', 'src9') THEN 'drawio' WHEN space IN ('src10', 'src11') THEN 'toc'
       WHEN space IN ('src12', 'src13', 'src14') THEN 'nested' ELSE '' END AS macro_kind
  FROM {v_article}) AS kinds""",
    # Attachments of the documents; for one language the image exists twice.
    "v_doc_attachment": """
SELECT id AS page_id, external_id || '-a' AS id, 'file-' || external_id || '.pdf' AS title, 'x' || external_id AS filename, cast(1 AS bigint) AS seq,
       CASE WHEN lang IN ('en', 'fr') THEN 'available' ELSE 'failed' END AS status FROM {v_article}
UNION ALL SELECT id, external_id || '-b', 'img ' || space || '.png', '', 2, CASE WHEN lang = 'de' THEN 'missing' ELSE 'available' END FROM {v_article}
UNION ALL SELECT id, external_id || '-c', 'diagram ' || space, '', 3, CASE WHEN lang = 'es' THEN 'failed' ELSE 'available' END FROM {v_article}
UNION ALL SELECT id, external_id || '-d', 'diagram ' || space || '.png', '', 4, CASE WHEN lang IN ('en', 'es') THEN 'available' ELSE 'failed' END FROM {v_article}
UNION ALL SELECT id, external_id || '-e', 'other', 'img ' || space || '.png', 5, 'available' FROM {v_article} WHERE lang = 'fr'""",
    # Import state of two destinations; three spaces were never imported.
    "v_state": """
SELECT id, 'r-' || external_id AS remote_id,
       SHA256<<CASE WHEN lang = 'fr' THEN body || '!' ELSE body END>> AS html_sha256,
       CASE WHEN space = 'src5' THEN '' ELSE 'https://help.example.com/kb/' || external_id END AS portal_url,
       space = 'src6' AS pending, CASE WHEN lang = 'en' THEN 'cat-1' ELSE 'cat-2' END AS category_id, seq
FROM {v_article} WHERE space NOT IN ('src3', 'src4', 'src8')""",
    # Articles the destination lists; two spaces were deleted there.
    "v_remote": """
SELECT 'r-' || external_id AS remote_id, CASE WHEN space = 'src4' THEN 'moved-' || external_id ELSE 'kb-' || external_id END AS permalink,
       CASE WHEN space = 'src10' THEN title || ' (old)' ELSE upper(title) END AS remote_title,
       CASE WHEN space = 'src11' THEN 'cat-9' WHEN lang = 'en' THEN 'cat-1' ELSE 'cat-2' END AS category_id,
       CASE WHEN space = 'src12' THEN 'Published' ELSE 'Draft' END AS status,
       CASE WHEN space = 'src13' THEN '' ELSE 'https://desk.example.com/a/' || external_id END AS portal_url, seq
FROM {v_article} WHERE space NOT IN ('src4', 'src9')""",
    # Responses seen while fetching: every event is the outcome of a request for one of the pages.
    "v_fetch": """
SELECT page_id, event_id, url, html,
       CASE event_type WHEN 'purchase' THEN 404 WHEN 'error' THEN 503 WHEN 'signup' THEN cast(NULL AS int) ELSE 200 END AS http_status,
       CASE WHEN event_type = 'view' AND value >= 10 THEN 'Text/HTML; charset=utf-8' WHEN event_type IN ('view', 'click') THEN 'image/png' ELSE '' END AS content_type,
       CASE WHEN event_type = 'signup' THEN CASE WHEN value >= 10 THEN 'timeout' ELSE 'request' END ELSE '' END AS error_class,
       CASE WHEN value >= 20 THEN 'File does not exist' ELSE html END AS body_text,
       cast(floor(value) AS bigint) AS content_length, cast(floor(value * 2) AS bigint) AS existing_size, event_type, ts, value
FROM {pages} JOIN (SELECT *, event_id % (SELECT count(*) FROM {pages}) AS asked FROM {events}) AS e ON page_id = asked""",
}


def _dialect(sql: str, engine: str) -> str:
    shape = r"sha2(\1, 256)" if engine == "spark" else r"sha256(\1)"
    return re.sub(r"SHA256<<(.*?)>>", shape, sql, flags=re.S)


class Views:
    """The given tables and the derived views of one data folder, as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.get(name)

    def get(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self.sql(VIEWS[name])

    def sql(self, text: str) -> DataFrame:
        names = set(re.findall(r"\{([a-z_]\w*)\}", text))
        return self.spark.sql(_dialect(text, "spark"), **{n: self.get(n) for n in names})


def oracle(body: str) -> str:
    """Turn ``{view}`` placeholders of a check query into common table expressions."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\{([a-z_]\w*)\}", text):
            if name in VIEWS and name not in needed:
                visit(VIEWS[name])
                needed.append(name)

    visit(body)

    def plain(text: str) -> str:
        return re.sub(r"\{([a-z_]\w*)\}", r"\1", _dialect(text, "duckdb"))

    ctes = ",\n".join(f"{n} AS ({plain(VIEWS[n])})" for n in needed)
    text = plain(body).strip()
    if not ctes:
        return text
    # A body may bring its own common table expressions.
    own = re.match(r"(?is)WITH\s+(RECURSIVE\s+)?", text)
    if own:
        return f"WITH {own.group(1) or ''}{ctes},\n{text[own.end():]}"
    return f"WITH {ctes}\n{text}"
