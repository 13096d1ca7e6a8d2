"""Catalogue, media library, run report and similarity queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import catalog as C
from ..operators import dedupe as D
from ..operators import reports as R
from ..operators import similar as N
from .registry import Registry

reg = Registry()
QUERIES, ORACLES = reg.queries, reg.oracles

# Form rows: entries are brands; the file value depends on the part type.
ROWS_SQL = """rows AS (SELECT p_brand AS entry_id, min(p_partkey) AS seq, p_name || '.zip' AS raw_file_value, p_type AS display_name, CASE WHEN p_type IN ('LARGE', 'PROMO') THEN 'Yes' ELSE '0' END AS display_status
  FROM {part} WHERE p_type <> 'SMALL' GROUP BY ALL),
 entries AS (SELECT entry_id, row_number() OVER (PARTITION BY entry_id ORDER BY seq) AS row_number, display_name, CASE WHEN display_name = 'MEDIUM' THEN 'https://dl.example.com/' || raw_file_value WHEN display_name = 'LARGE' THEN '/f/' || raw_file_value ELSE raw_file_value END AS raw_file_value,
   display_status FROM rows)"""
RESOLVED = "CASE WHEN raw_file_value LIKE 'https://%' THEN raw_file_value WHEN raw_file_value LIKE '/%' THEN 'https://site.example.com' || raw_file_value ELSE '' END"
STATUS = "CASE WHEN raw_file_value LIKE 'https://%' THEN 'direct_url' WHEN raw_file_value LIKE '/%' THEN 'relative_url' ELSE 'filename_only_unresolved' END"


def catalogue(v):
    kind = F.col("p_type")
    file = F.concat(
        F.when(kind == "MEDIUM", F.lit(" https://dl.example.com/")).when(kind == "LARGE", F.lit("/f/")).otherwise(F.lit("")), "p_name",
        F.when(kind == "SMALL", F.lit(".png")).otherwise(F.lit(".zip")),
    )
    shown = F.when(kind.isin("LARGE", "PROMO"), F.lit("Yes")).otherwise(F.lit("0"))
    forms = v.part.select(F.col("p_brand").alias("entry_id"), F.col("p_partkey").alias("seq"), F.array(F.lit(" "), shown, kind, file).alias("values"))
    return C.catalogue_rows(forms, F.lit("https://site.example.com/wp-admin/x"))


@reg.query("catalogue_rows", f"WITH {ROWS_SQL} SELECT entry_id, row_number, display_name, raw_file_value, display_status, {RESOLVED} AS resolved_url, {STATUS} AS resolution_status FROM entries")
def catalogue_rows(v):
    return catalogue(v).select("entry_id", "row_number", "display_name", "raw_file_value", "display_status", "resolved_url", "resolution_status")


@reg.query(
    "catalogue_csv",
    f"""WITH {ROWS_SQL} SELECT entry_id AS post_id, '' AS post_title, '' AS edit_url, cast(row_number AS varchar) AS row_number, display_name, raw_file_value, {RESOLVED} AS resolved_url, {STATUS} AS resolution_status,
        display_status, '' AS download_section, entry_id || ' | ' || display_name AS related_software FROM entries""",
)
def catalogue_csv(v):
    rows = catalogue(v).withColumnRenamed("entry_id", "post_id").withColumn("related_software", F.array("post_id", "display_name"))
    return C.flat(rows, C.CATALOGUE_FIELDS)


@reg.query("catalogue_totals", f"WITH {ROWS_SQL} SELECT count(*) FILTER (s = 'filename_only_unresolved') AS filename_only, count(*) FILTER (s <> 'filename_only_unresolved') AS resolved FROM (SELECT {STATUS} AS s FROM entries)")
def catalogue_totals(v):
    return R.split_totals(catalogue(v), "resolution_status = 'filename_only_unresolved'", "filename_only", "resolved")


@reg.query("related_values", "SELECT p_partkey AS id, CASE WHEN p_type = 'PROMO' THEN p_brand WHEN p_type = 'LARGE' THEN p_name ELSE p_name || ' | ' || p_brand END AS related FROM {part}")
def related_values(v):
    kind, name, brand = F.col("p_type"), F.col("p_name"), F.col("p_brand")
    pair = lambda a, b: F.struct(a.alias("label"), b.alias("value"))
    pairs = F.array(
        pair(F.when(kind != "PROMO", name), F.lit("1")), pair(F.lit(""), F.lit("on")), pair(F.lit(None).cast("string"), F.lit("yes")),
        pair(F.lit(" "), F.when(kind == "LARGE", name).otherwise(brand)), pair(F.when(kind == "LARGE", name).otherwise(brand), F.lit("9")),
    )
    return v.part.select(F.col("p_partkey").alias("id"), T.list_text(C.related_values(pairs)).alias("related"))


FETCH_SQL = """CASE WHEN error_class = 'timeout' THEN 'timeout' WHEN error_class <> '' THEN 'failed' WHEN http_status = 404 THEN 'missing_server_file' WHEN http_status >= 400 THEN 'failed'
  WHEN content_type LIKE 'Text/HTML%' THEN CASE WHEN value >= 20 THEN 'missing_server_file' ELSE 'failed' END WHEN content_length = 0 OR content_length = existing_size THEN 'skipped_existing' ELSE 'downloaded' END"""


def fetched(v):
    f = {c: F.col(c) for c in "http_status content_type body_text error_class content_length existing_size".split()}
    return v.v_fetch.withColumn("status", C.classify_fetch(*f.values()))


@reg.query("classify_fetch", f"SELECT page_id, {FETCH_SQL} AS status FROM {{v_fetch}}")
def classify_fetch(v):
    return fetched(v).select("page_id", "status")


@reg.query("download_totals", f"SELECT count(*) FILTER (s = 'downloaded') AS downloaded, count(*) FILTER (s <> 'downloaded') AS failed FROM (SELECT {FETCH_SQL} AS s FROM {{v_fetch}})")
def download_totals(v):
    return R.split_totals(fetched(v), "status = 'downloaded'", "downloaded", "failed")


@reg.query("media_resume", f"SELECT page_id FROM {{pages}} WHERE page_id NOT IN (SELECT page_id FROM (SELECT page_id, max_by({FETCH_SQL}, event_id) AS s FROM {{v_fetch}} GROUP BY page_id) WHERE s IN ('downloaded', 'skipped_existing'))")
def media_resume(v):
    last = D.last_wins(fetched(v).select("page_id", "event_id", "status"), "page_id", "event_id")
    return C.open_items(v.pages.select("page_id"), last, "page_id")


@reg.query(
    "media_inventory_csv",
    f"""SELECT cast(row_number() OVER (ORDER BY ts, event_id) AS varchar) AS sequence, cast(page_id AS varchar) AS attachment_id, {', '.join("'' AS " + c for c in ("title", "listed_filename", "saved_filename", "saved_path", "size_bytes", "sha256", "listed_date", "author", "caption", "alt_text", "description", "edit_url", "downloaded_at_utc"))},
        url AS original_url, {FETCH_SQL} AS status, lower(content_type) AS content_type, coalesce(cast(http_status AS varchar), '') AS http_status, error_class AS error FROM {{v_fetch}}""",
)
def media_inventory_csv(v):
    rows = D.numbered(fetched(v).select("page_id", "event_id", "url", "ts", "status", "content_type", "http_status", "error_class"), ["ts", "event_id"])
    named = rows.select(
        "sequence", F.col("page_id").alias("attachment_id"), F.col("url").alias("original_url"), "status", F.lower("content_type").alias("content_type"), "http_status", F.col("error_class").alias("error")
    )
    return C.flat(named, C.MEDIA_FIELDS)


@reg.query("expected_counts", "SELECT count(*) AS found, 1397 AS expected, count(*) <> 1397 AS alert FROM {pages}")
def expected_counts(v):
    return R.expected_counts(v.pages, 1397)


# Attempts: the turns of a conversation; the assistant's turns with a break succeed.
ATTEMPT_SQL = "attempts AS (SELECT 'c-' || cast(conv_id AS varchar) AS url, turn + 1 AS attempt, role = 'assistant' AND contains(text, chr(10)) AS ok, text AS error FROM {conversations}), results AS (SELECT url, bool_or(ok) AS ok, max_by(error, attempt) AS error FROM attempts GROUP BY url)"


@reg.query("migration_report", f"WITH {ATTEMPT_SQL} SELECT url, CASE WHEN ok THEN 'success' ELSE 'failed' END AS status, CASE WHEN NOT ok THEN error END AS error FROM results")
def migration_report(v):
    ok = (F.col("role") == "assistant") & F.col("text").contains("\n")
    attempts = v.conversations.select(F.concat(F.lit("c-"), F.col("conv_id").cast("string")).alias("url"), (F.col("turn") + 1).alias("attempt"), ok.alias("ok"), F.col("text").alias("error"))
    return R.migration_results(attempts)


@reg.query("state_upsert", "SELECT page_id, version, seq FROM (SELECT page_id, version, seq, row_number() OVER (PARTITION BY page_id ORDER BY version DESC, seq) AS rn FROM {v_snapshot}) WHERE rn = 1")
def state_upsert(v):
    return R.newest_versions(v.v_snapshot)


@reg.query("snapshot_dedup", "SELECT page_id, version, status, seq FROM (SELECT *, row_number() OVER (PARTITION BY page_id, version ORDER BY seq) AS rn FROM {v_snapshot}) WHERE rn = 1")
def snapshot_dedup(v):
    return R.snapshot_dedup(v.v_snapshot.select("page_id", "version", "status", "seq"))


@reg.query("outcome_windows", "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, status, count(*) AS outcomes FROM {v_snapshot} GROUP BY ALL")
def outcome_windows(v):
    return R.outcome_windows(v.v_snapshot)


@reg.query("near_duplicates")
def near_duplicates(v):
    return N.near_duplicates(v.documents.select(F.col("doc_id").alias("id"), "text"))


@reg.query("similar_vectors")
def similar_vectors(v):
    return N.similar_vectors(v.embeddings.select(F.col("vec_id").alias("id"), F.col("embedding").alias("feature")), 64, 0.4)
