"""Crawl to canonical package: scope, validate, package, summarize."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import hierarchy as H
from ..operators import markup as M
from ..operators import packaging as P
from ..operators import validate as V
from ..schemas import SCHEMA_VERSION
from ..session import dropped, materialize, scratch_path, shuffles_dropped
from ..sources.sinks import write_inventory, write_json, write_objects

INGESTED_AT = "2026-01-02T00:00:00+00:00"


def crawl_to_manifest(tree: DataFrame, pages: DataFrame, attachments: DataFrame, root_id: str, connector: str) -> DataFrame:
    """Manifest header of the pages below a root; invalid records count as failures, next to failed attachments."""
    scope = H.tree_scope(tree, root_id).select("id")
    inside = H.select_ids(pages, scope)
    files = H.select_ids(attachments.withColumnRenamed("id", "attachment_id").withColumn("id", F.col("page_id")), scope)
    rows = P.inventory_rows(inside, files.select("page_id"))
    records = P.package_inventory(rows, connector, INGESTED_AT)
    as_json = records.select("id", F.to_json(F.struct(*records.columns)).alias("json"))
    checked = materialize(V.flagged(as_json, "knowledge").select("id", "is_valid"))  # checked once, counted twice
    valid, invalid = checked.filter("is_valid"), checked.filter("NOT is_valid")
    usable = files.filter("status = 'available'").select(F.col("attachment_id").alias("id"))
    errors = invalid.select(F.col("id").alias("page_id"), F.lit("record breaks its rules").alias("message"), F.lit("InvalidRecord").alias("type"))
    named = files.select("page_id", F.col("attachment_id").alias("id"), "status", F.lit("").alias("error"))
    return P.package_manifest(valid, usable, P.mirror_failures(named, errors), connector, root_id)


def crawl(
    pages: DataFrame, attachments: DataFrame, mirrored: DataFrame, listed: DataFrame, out: str, *, root_id: str, space_id: str,
    connector: str, base_url: str, generated_at: str, page_errors: DataFrame | None = None, max_pages: int | None = None,
) -> DataFrame:
    """Crawl to canonical package in the folder ``out``; returns the one-row report and manifest header.

    Scope below the root in tree order (the first ``max_pages``), resume plan against the mirror, title map, conversion
    of the bodies, canonical records, validation, and writes: ``objects`` and ``assets`` by id (older ones stay),
    ``members`` (assets and relationships of every article, in order), ``failures``, ``plan``, ``inventory`` and
    ``manifest`` (in parts). All counts are observed while the tables are written, none by a second pass.

    ``pages``: id, parent_id, title, position, status, body (storage markup), version, url, space, webui, base, created_at,
    updated_at, author_id; ``attachments``: page_id, id, title, filename, seq, status, error, local_path, media_type,
    size_bytes, file_size, sha256, url; ``mirrored``: page_id, version, has_body; ``listed``: title, url of pages elsewhere;
    ``page_errors``: page_id, message, type. A page with an error and a record that breaks a rule give a failure, no object.
    """
    with shuffles_dropped(pages.sparkSession):
        return _crawl(pages, attachments, mirrored, listed, out, root_id, space_id, connector, base_url, generated_at, page_errors, max_pages)


def _crawl(pages, attachments, mirrored, listed, out, root_id, space_id, connector, base_url, generated_at, page_errors, max_pages) -> DataFrame:
    spark = pages.sparkSession
    chosen = materialize(H.head(H.scoped_pages(pages, root_id), H.TREE_ORDER, max_pages).select("id"))
    inside = H.select_ids(pages, chosen)
    files = attachments.join(chosen.select(F.col("id").alias("page_id")), "page_id", "left_semi")
    files = files.withColumn("asset_id", T.stable_id(f"{connector}-attachment", F.col("id")))
    empty = spark.createDataFrame([], "page_id string, message string, type string")
    errors = empty if page_errors is None else page_errors.join(chosen.select(F.col("id").alias("page_id")), "page_id", "left_semi")
    good = inside.join(errors.select(F.col("page_id").alias("id")), "id", "left_anti").withColumn("uri_id", T.stable_id(connector, F.col("id")))

    seen = {name: Observation(name) for name in ("plan", "objects", "assets", "failures")}
    plan = P.mirror_plan(inside.select(F.col("id").alias("page_id"), "version"), mirrored)
    counted = [F.count(F.lit(1)).alias("requested"), *(F.count_if(F.col("action") == a).alias(a) for a in ("mirrored", "resumed"))]
    plan.observe(seen["plan"], *counted).write.mode("overwrite").parquet(f"{out}/plan")

    titles = M.title_map(good.select("id", "title", "uri_id"), listed)
    source = good.withColumns({"source_body": F.col("body"), "revision": F.col("version")})
    # Tokens are resolved before bodies come along, so that the disk holds the shuffle of one or the other.
    resolved, staged, verdicts = (scratch_path(spark, f"crawl-{name}") for name in ("tokens", "records", "verdicts"))
    M.replacements(source, files, titles, base_url=base_url).write.option("compression", "zstd").parquet(resolved)
    records = P.package_knowledge(M.rebuilt(source, spark.read.parquet(resolved)), connector, generated_at)
    as_json = records.select("id", "title", "status", F.to_json(F.struct(*records.columns)).alias("json"))
    checked = V.checked(as_json, "knowledge").select(*as_json.columns, F.size("_broken").alias("broken"), F.get("_broken", F.lit(0)).getField("message").alias("message"))
    valid = F.count_if(F.col("broken") == 0).alias("valid")
    checked.observe(seen["objects"], valid).write.option("compression", "zstd").parquet(staged)
    dropped(spark, resolved)
    checked = spark.read.parquet(staged)
    objects = checked.where("broken = 0").select("id", "title", "status", "json", F.lit(connector).alias("connector"))
    write_objects(objects, f"{out}/objects")
    # What follows asks for ids and messages alone.
    checked.select("id", "broken", "message").write.parquet(verdicts)
    dropped(spark, staged)
    checked = spark.read.parquet(verdicts)

    assets = P.package_assets(files, connector)
    stored = assets.select("id", F.to_json(F.struct(*assets.columns)).alias("json"), F.lit(connector).alias("connector"))
    write_objects(V.require_valid(stored, "asset").observe(seen["assets"], F.count(F.lit(1)).alias("n")), f"{out}/assets")

    broken = checked.where("broken > 0").select(F.substring("id", len(connector) + 2, 1 << 30).alias("page_id"), "message", F.lit("InvalidRecord").alias("type"))
    failures = P.mirror_failures(files, errors.unionByName(broken))
    failures.observe(seen["failures"], F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{out}/failures")
    failures = spark.read.parquet(f"{out}/failures")

    uri = lambda c: T.stable_id(connector, F.col(c))
    owned = files.where("status = 'available'").select(uri("page_id").alias("id"), "asset_id")
    related = H.relationships(good).select(uri("id").alias("id"), "type", uri("target_id").alias("target_id"))
    P.member_rows(owned, related).write.mode("overwrite").parquet(f"{out}/members")
    # Checksums of bodies are made before the joins, so that bodies stay behind.
    briefly = pages.withColumn("body_sha256", T.sha256_text(F.coalesce("body", F.lit("")))).drop("body").withColumn("space_id", F.col("space"))
    briefly = H.select_ids(briefly, chosen).join(errors.select(F.col("page_id").alias("id")), "id", "left_anti")
    write_inventory(P.inventory(briefly, files.select("page_id")), f"{out}/inventory")

    plan_counts, n_failed = seen["plan"].get, seen["failures"].get["n"]
    header = {
        "schema_version": SCHEMA_VERSION, "connector": connector, "generated_at": generated_at, "root_page_id": root_id, "space_id": space_id,
        "object_count": seen["objects"].get["valid"], "asset_count": seen["assets"].get["n"], "crawl_successful": n_failed == 0,
    }
    manifest = P.manifest_parts(P.manifest_entries(checked.where("broken = 0"), stored), failures, header)
    write_json(V.require_valid(materialize(manifest), "manifest"), f"{out}/manifest")
    report = {
        "requested_pages": plan_counts["requested"], "mirrored_pages": plan_counts["mirrored"], "resumed_pages": plan_counts["resumed"],
        "failure_count": n_failed,
    }
    return spark.createDataFrame([tuple((header | report).values())], list(header | report))
