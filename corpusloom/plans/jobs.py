"""Other end-to-end jobs, each a short composition of operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import audit as A
from ..operators import bundle as U
from ..operators import catalog as C
from ..operators import links as L
from ..operators import reconcile as R
from ..operators import storage as B
from ..operators import validate as V


def review(
    objects: DataFrame, articles: DataFrame, warnings: DataFrame, asset_refs: DataFrame, assets: DataFrame, relations: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(totals, counts by type, details) of canonical articles; ``objects`` (json) must be valid first."""
    V.require_valid(objects, "knowledge")
    found = A.review_findings(articles, warnings, asset_refs, assets, relations)
    return A.review_totals(articles, found), A.review_summary(found), A.review_details(articles, asset_refs, relations, found)


def publish_bundle(articles: DataFrame, article_paths: DataFrame, assets: DataFrame, asset_paths: DataFrame, asset_refs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, manifest entries); a reference to a missing asset is an error."""
    lost = A.missing_targets(asset_refs, assets, "asset_id").limit(1).collect()
    if lost:
        raise ValueError(f"canonical asset is missing: {lost[0]['asset_id']}")
    bodies, issues = R.rewrite_bundle_links(articles, article_paths, asset_paths)
    documents = U.bundle_documents(bodies)
    used = assets.join(asset_refs.select(F.col("asset_id").alias("id")).distinct(), "id", "left_semi")
    return documents, U.publisher_manifest(documents, used, issues)


def import_dry_run(articles: DataFrame, state: DataFrame, remotes: DataFrame, canonical: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """(plan, totals); a manifest entry without a canonical object is an error."""
    lost = R.bundle_check(articles, canonical).limit(1).collect()
    if lost:
        raise ValueError(f"canonical article is missing: {lost[0]['id']}")
    adopt = options.get("adopt_existing", True)
    plan = R.import_plan(R.resolve_remote(articles, state, remotes, adopt), state, options.get("force", False))
    return plan, R.import_totals(plan)


def link_census(packages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(link rows, counts by class) of article packages (folder, html, title, source_url)."""
    rows = L.link_inventory(packages, "folder", "html", carry=["title", "source_url"])
    rows = rows.withColumn("type", L.link_classes(F.col("href")))
    return rows, L.link_type_counts(rows)


def bucket_sync(files: DataFrame, remote: DataFrame, categories: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(manifest, upload plan, totals) of a local folder against a bucket."""
    plan = B.diff_by_size(B.without_ignored(files).withColumnRenamed("path", "key"), remote)
    return B.bucket_manifest(files, categories), plan, B.status_totals(plan)


def media_run(listing: DataFrame, inventory: DataFrame, responses: DataFrame) -> DataFrame:
    """Open items joined with their classified responses."""
    fields = ["http_status", "content_type", "body_text", "error_class", "content_length", "existing_size"]
    outcome = C.classify_fetch(*[F.col(c) for c in fields])
    return C.open_items(listing, inventory, "attachment_id").join(responses, "attachment_id", "left").withColumn("status", outcome)
