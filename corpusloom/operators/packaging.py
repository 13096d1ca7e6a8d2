"""Mirror plans, inventory, canonical records and package manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..schemas import SCHEMA_VERSION
from .dedupe import numbered

# Column order of the page inventory.
INVENTORY_FIELDS = [
    "Page ID", "Title", "Parent ID", "Status", "Created", "Updated", "Version", "Author ID",
    "Space ID", "Source URL", "Body Path", "Attachment Count", "Mirror Status", "Content SHA256",
]


def blank(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def inventory(pages: DataFrame, attachments: DataFrame) -> DataFrame:
    """Flat inventory of mirrored pages (:func:`inventory_rows`), by folded title and id."""
    return inventory_rows(pages, attachments).orderBy(T.fold(F.col("Title")), "Page ID")


def inventory_rows(pages: DataFrame, attachments: DataFrame) -> DataFrame:
    """One row per mirrored page in no order, for what does not write it out.

    ``pages``: id, title, parent_id, status, created_at, updated_at, version,
    author_id, space_id, base, webui, body; with ``body_sha256`` the body need not be there. ``attachments``: page_id.
    """
    checksum = F.col("body_sha256") if "body_sha256" in pages.columns else T.sha256_text(F.coalesce("body", F.lit("")))
    counts = attachments.groupBy(F.col("page_id").alias("id")).agg(F.count("*").alias("_n"))
    rows = pages.join(counts, "id", "left")
    values = [
        blank(F.col("id")), blank(F.col("title")), blank(F.col("parent_id")), blank(F.col("status")),
        blank(F.col("created_at")), blank(F.col("updated_at")), blank(F.col("version")), blank(F.col("author_id")),
        blank(F.col("space_id")), T.inventory_url(F.col("base"), F.col("webui")),
        F.concat(F.lit("pages/"), "id", F.lit("/body.storage.html")), F.coalesce("_n", F.lit(0)).cast("bigint"),
        F.lit("mirrored"), checksum,
    ]
    return rows.select(*[v.alias(n) for v, n in zip(values, INVENTORY_FIELDS)])


def mirror_plan(listing: DataFrame, mirrored: DataFrame, dry_run: bool = False) -> DataFrame:
    """Per listed page: resumed when the stored version equals the listed one, else mirrored.

    ``mirrored``: page_id, version, has_body. An empty version never matches.
    """
    held = mirrored.select("page_id", F.col("version").alias("_held"), "has_body")
    same = (blank(F.col("version")) != "") & (blank(F.col("_held")) == blank(F.col("version"))) & F.col("has_body")
    status = F.lit("planned") if dry_run else F.when(F.coalesce(same, F.lit(False)), "resumed").otherwise("mirrored")
    return listing.join(held, "page_id", "left").withColumn("action", status).drop("_held", "has_body")


def attachment_plan(attachments: DataFrame, local_files: DataFrame) -> DataFrame:
    """Per attachment: reuse the local file, download, or report it as unavailable.

    ``attachments``: page_id, id, title, expected_size, link; ``local_files``:
    local_path, local_size.
    """
    path = F.concat(
        F.lit("attachments/"), "id", F.lit("-"), T.safe_name(T.first_filled(F.col("title"), F.col("id")))
    )
    rows = attachments.withColumn("local_path", path).join(
        local_files.select("local_path", "local_size"), "local_path", "left"
    )
    reuse = F.col("local_size").isNotNull() & (
        F.col("expected_size").isNull() | (F.col("local_size") == F.col("expected_size"))
    )
    action = F.when(reuse, "available").when(F.coalesce("link", F.lit("")) == "", "unavailable").otherwise("download")
    return rows.withColumn("action", action)


def mirror_failures(attachments: DataFrame, page_errors: DataFrame) -> DataFrame:
    """One row per failed or unavailable attachment and per page that could not be processed."""
    from_files = attachments.filter(F.col("status").isin("failed", "unavailable")).select(
        "page_id", F.col("id").alias("attachment_id"),
        T.first_filled(F.col("error"), default="Attachment unavailable").alias("message"),
        F.lit("AttachmentDownloadError").alias("type"),
    )
    from_pages = page_errors.select("page_id", F.lit(None).cast("string").alias("attachment_id"), "message", "type")
    return from_files.unionByName(from_pages)


def mirror_metadata(pages: DataFrame, attachments: DataFrame) -> DataFrame:
    counts = attachments.groupBy("page_id").agg(F.count("*").alias("_n"))
    return pages.join(counts, "page_id", "left").select(
        "page_id", "mirrored_at", T.sha256_text(F.col("body")).alias("source_checksum"),
        F.coalesce("_n", F.lit(0)).cast("bigint").alias("attachment_count"),
    )


def crawl_report(results: DataFrame) -> DataFrame:
    """Counters over per-page results (status, downloaded, resumed_files, failures)."""
    return results.agg(
        F.count("*").alias("requested_pages"),
        F.count_if(F.col("status") == "mirrored").alias("mirrored_pages"),
        F.count_if(F.col("status") == "resumed").alias("resumed_pages"),
        F.coalesce(F.sum("downloaded"), F.lit(0)).cast("bigint").alias("attachments_downloaded"),
        F.coalesce(F.sum("resumed_files"), F.lit(0)).cast("bigint").alias("attachments_resumed"),
        F.coalesce(F.sum("failures"), F.lit(0)).cast("bigint").alias("failure_count"),
    ).withColumn("successful", F.col("failure_count") == 0)


def optional(df: DataFrame, name: str, kind: str = "string") -> Column:
    """A column, or null where the source does not deliver it."""
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def package_assets(attachments: DataFrame, connector: str) -> DataFrame:
    """Canonical asset records of the available attachments, with fallbacks; version and comment are extensions."""
    more = F.struct(optional(attachments, "version", "bigint").alias("version"), optional(attachments, "comment").alias("comment"))
    usable = attachments.filter("status = 'available'")
    local = F.col("local_path")
    return usable.select(
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        T.stable_id(f"{connector}-attachment", F.col("id")).alias("id"),
        T.first_filled(F.col("title"), T.base_name(local)).alias("filename"),
        T.first_filled(F.col("media_type"), default=T.DEFAULT_MEDIA_TYPE).alias("media_type"),
        F.coalesce(F.nullif("size_bytes", F.lit(0)), "file_size", F.lit(0)).cast("bigint").alias("size_bytes"),
        "sha256",
        F.concat(F.lit("pages/"), "page_id", F.lit("/"), local).alias("local_path"),
        F.struct(
            F.lit(connector).alias("connector"), F.col("id").alias("external_id"),
            F.col("page_id").alias("container_external_id"), F.coalesce("url", F.lit("")).alias("url"),
        ).alias("source"),
        F.lit("available").alias("status"),
        F.struct(more.alias(connector)).alias("extensions"),
    )


def package_knowledge(pages: DataFrame, connector: str, ingested_at: str) -> DataFrame:
    """Canonical article records of mirrored pages.

    ``pages``: id, title, status, body (converted), source_body, warnings, url,
    space, parent_id, revision, created_at, updated_at; author_id, owner_id and position if known. Assets and relationships
    stay in their edge tables, because one page may own a large share of them;
    :func:`member_rows` puts them in order for export.
    """
    title = F.coalesce("title", F.lit(""))
    kept = F.struct(
        optional(pages, "author_id").alias("author_id"), optional(pages, "owner_id").alias("owner_id"),
        optional(pages, "position", "bigint").alias("position"), F.col("status").alias("source_status"),
        F.lit("storage").alias("body_representation"), F.col("warnings").alias("transform_warnings"),
    )
    return pages.select(
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        T.stable_id(connector, F.col("id")).alias("id"),
        T.first_filled(F.col("title"), F.concat(F.lit("Page "), "id")).alias("title"),
        T.slug(title, F.col("id")).alias("slug"),
        T.published_status(F.coalesce("status", F.lit(""))).alias("status"),
        F.struct(F.lit("html").alias("format"), F.col("body"), F.lit("en").alias("language")).alias("content"),
        F.struct(
            F.lit(connector).alias("connector"), F.col("id").alias("external_id"), F.coalesce("url", F.lit("")).alias("url"),
            F.coalesce("space", F.lit("")).alias("space"), T.empty_to_null(F.col("parent_id")).alias("parent_external_id"),
            F.col("revision"),
        ).alias("source"),
        F.struct(
            T.iso_text(F.col("created_at")).alias("created_at"), T.iso_text(F.col("updated_at")).alias("updated_at"),
            F.lit(ingested_at).alias("ingested_at"),
        ).alias("timestamps"),
        F.struct(
            T.sha256_text(F.col("source_body")).alias("source"), T.sha256_text(F.col("body")).alias("content")
        ).alias("checksums"),
        no_taxonomy().alias("taxonomy"),
        F.struct(kept.alias(connector)).alias("extensions"),
    )


def no_taxonomy() -> Column:
    """Tags, products and audiences: the source knows none."""
    return F.struct(*(F.array().cast("array<string>").alias(n) for n in ("tags", "products", "audiences")))


def package_inventory(rows: DataFrame, connector: str, ingested_at: str) -> DataFrame:
    """Canonical records from the inventory alone: empty body, no checksums, url or space."""
    key, title = T.strip(F.col("Page ID")), T.strip(F.col("Title"))
    trimmed = lambda n: T.empty_to_null(T.strip(F.col(n)))
    return rows.select(
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        T.stable_id(connector, key).alias("id"),
        title.alias("title"),
        T.slug(title, key).alias("slug"),
        T.published_status(F.coalesce("Status", F.lit(""))).alias("status"),
        F.struct(F.lit("html").alias("format"), F.lit("").alias("body"), F.lit("en").alias("language")).alias("content"),
        F.struct(
            F.lit(connector).alias("connector"), key.alias("external_id"),
            trimmed("Parent ID").alias("parent_external_id"), trimmed("Version").alias("revision"),
        ).alias("source"),
        F.struct(
            T.iso_text(F.col("Created")).alias("created_at"), T.iso_text(F.col("Updated")).alias("updated_at"),
            F.lit(ingested_at).alias("ingested_at"),
        ).alias("timestamps"),
        no_taxonomy().alias("taxonomy"),
        F.struct(F.struct(F.col("Status").alias("source_status")).alias(connector)).alias("extensions"),
    )


def with_fallback(primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """The primary records when there is at least one, else the fallback ones.

    Decided inside the plan: the fallback is filtered by a one-row count.
    """
    none = primary.limit(1).agg(F.count("*").alias("_n")).filter("_n = 0").select(F.lit(True).alias("_use"))
    chosen = fallback.withColumn("_use", F.lit(True)).join(none, "_use", "left_semi").drop("_use")
    return primary.unionByName(chosen, allowMissingColumns=True)


def member_rows(assets: DataFrame, relations: DataFrame) -> DataFrame:
    """(id, kind, position, target_id): the assets and relationships of every article, in order.

    ``assets``: id, asset_id; ``relations``: id, type, target_id. Parents come before other relationships.
    One form for every article, however many members it has.
    """
    edges = assets.select("id", F.lit("asset").alias("kind"), F.col("asset_id").alias("target_id")).unionByName(
        relations.select("id", F.col("type").alias("kind"), "target_id")
    )
    rank = F.when(F.col("kind") == "asset", 0).when(F.col("kind") == "parent", 1).otherwise(2)
    ranked = edges.withColumn("rank", rank)
    return numbered(ranked, ["rank", "kind", "target_id"], ["id"], "position").select("id", "kind", "position", "target_id")


def tally(**tables: DataFrame) -> DataFrame:
    """One row with the number of rows of each table, under the given names."""
    marks = None
    for name, table in tables.items():
        mark = table.select(F.lit(name).alias("_of"))
        marks = mark if marks is None else marks.unionByName(mark)
    return marks.agg(*[F.count_if(F.col("_of") == name).alias(name) for name in tables])


def package_manifest(articles: DataFrame, assets: DataFrame, failures: DataFrame, connector: str, root_id: str) -> DataFrame:
    """One-row manifest header; the id lists are :func:`manifest_entries`."""
    header = tally(object_count=articles, asset_count=assets, failure_count=failures)
    return header.select(
        F.lit(SCHEMA_VERSION).alias("schema_version"), F.lit(connector).alias("connector"), F.lit(root_id).alias("root_page_id"),
        "object_count", "asset_count", "failure_count", (F.col("failure_count") == 0).alias("crawl_successful"),
    )


def manifest_entries(articles: DataFrame, assets: DataFrame) -> DataFrame:
    """Ids of the package, one row each: the manifest's lists as a table."""
    return articles.select(F.lit("object").alias("kind"), "id").unionByName(
        assets.select(F.lit("asset").alias("kind"), "id")
    )


def manifest_parts(entries: DataFrame, failures: DataFrame, header: dict, size: int = 10_000) -> DataFrame:
    """The manifest as records of at most ``size`` ids or failures each: part, json.

    Every part repeats the header, with the counts of the whole, and meets the manifest's own rules; a manifest that
    fits has one part. ``entries``: kind, id (:func:`manifest_entries`); ``failures``: page_id, attachment_id, message, type.
    """
    failed = F.struct("page_id", "attachment_id", "message", "type").alias("failure")
    rows = entries.select("kind", "id", F.lit(None).cast("struct<page_id:string,attachment_id:string,message:string,type:string>").alias("failure"))
    rows = rows.unionByName(failures.select(F.lit("zfailure").alias("kind"), F.concat_ws(" ", "page_id", "attachment_id", "message").alias("id"), failed))
    part = F.floor((F.col("number") - 1) / size).cast("bigint").alias("part")
    lists = numbered(rows, ["kind", "id"], out="number").groupBy(part).agg(
        F.array_sort(F.collect_list(F.when(F.col("kind") == "object", F.col("id")))).alias("objects"),
        F.array_sort(F.collect_list(F.when(F.col("kind") == "asset", F.col("id")))).alias("assets"),
        F.collect_list("failure").alias("failures"),
    )
    fixed = [F.lit(value).alias(name) for name, value in header.items()]
    return lists.select("part", F.to_json(F.struct(*fixed, "objects", "assets", "failures")).alias("json"))


def embed_images(refs: DataFrame, files: DataFrame) -> DataFrame:
    """Image references (id, src) become data addresses; data: is kept, a missing file gives null."""
    blobs = files.select("src", "content")
    embedded = T.data_url(F.col("src"), F.col("content"), "image/png")
    kept = F.col("src").startswith("data:")
    return refs.join(blobs, "src", "left").select("id", F.when(kept, F.col("src")).otherwise(embedded).alias("src"))
