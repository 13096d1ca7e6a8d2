"""Bucket manifests, object-store diffs, checksums and duplicate storage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

# File names that never enter a bucket; the manifest leaves itself out too.
UPLOAD_IGNORED = [".DS_Store", "Thumbs.db"]
MANIFEST_IGNORED = [*UPLOAD_IGNORED, "manifest.json"]


def without_ignored(files: DataFrame, ignored: list[str] = UPLOAD_IGNORED) -> DataFrame:
    return files.filter(~T.base_name(F.col("path")).isin(ignored))


def bucket_manifest(files: DataFrame, categories: DataFrame) -> DataFrame:
    """Files of each category in path order, one row per file.

    ``files``: path, size_bytes, sha256. A category without files keeps one row
    with nulls. Rows, not nested lists: a category may hold any share of the bucket.
    """
    kept = without_ignored(files, MANIFEST_IGNORED).select(
        F.split_part("path", F.lit("/"), F.lit(1)).alias("category"),
        T.base_name(F.col("path")).alias("filename"), "path", "size_bytes", "sha256",
    )
    return categories.join(kept, "category", "left").orderBy("category", "path")


def diff_by_size(local: DataFrame, remote: DataFrame) -> DataFrame:
    """skipped when the remote object exists with the same size, else uploaded."""
    there = remote.select("key", F.col("size_bytes").alias("_size"))
    status = F.when(F.col("_size") == F.col("size_bytes"), "skipped").otherwise("uploaded")
    return local.join(there, "key", "left").withColumn("status", status).drop("_size")


def diff_by_checksum(local: DataFrame, remote: DataFrame) -> DataFrame:
    """skipped when the remote object has the same size and recorded checksum."""
    there = remote.select("key", F.col("size_bytes").alias("_size"), F.col("sha256").alias("_sha"))
    same = (F.col("_size") == F.col("size_bytes")) & (F.col("_sha") == F.col("sha256"))
    status = F.when(F.coalesce(same, F.lit(False)), "skipped").otherwise("uploaded")
    return local.join(there, "key", "left").withColumn("status", status).drop("_size", "_sha")


def status_totals(df: DataFrame, status: str = "status") -> DataFrame:
    return df.groupBy(status).agg(F.count("*").alias("items"))


def verify_checksums(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """ok / missing / mismatch per manifest entry (path, sha256) against real files."""
    real = files.select("path", F.col("sha256").alias("_sha"))
    result = F.when(F.col("_sha").isNull(), "missing").when(F.col("_sha") == F.col("sha256"), "ok").otherwise("mismatch")
    return manifest.join(real, "path", "left").withColumn("result", result).drop("_sha")


def exact_duplicates(items: DataFrame, key: str = "id", checksum: str = "sha256") -> DataFrame:
    """Members of groups with one checksum and the proposed canonical id; nothing is dropped.

    Group facts come from a map-side combined aggregate joined back on the
    checksum, so a group of any size is never gathered.
    """
    groups = items.groupBy(checksum).agg(F.min(key).alias("canonical_id"), F.count("*").alias("copies"))
    return items.join(groups.filter("copies > 1"), checksum).select(key, checksum, "canonical_id", "copies")


def merge_decisions(duplicates: DataFrame, key: str = "id") -> DataFrame:
    """Reversible decision rows: each alias is a duplicate_of its canonical id."""
    return duplicates.filter(F.col(key) != F.col("canonical_id")).select(
        F.col(key).alias("alias_id"), F.lit("duplicate_of").alias("type"), F.col("canonical_id").alias("target_id")
    )


def dedup_savings(items: DataFrame, checksum: str = "sha256", size: str = "size_bytes") -> DataFrame:
    """Bytes saved by keeping one binary per checksum."""
    per = items.groupBy(checksum).agg(F.count("*").alias("_n"), F.sum(size).alias("_all"), F.max(size).alias("_one"))
    return per.agg(
        F.sum("_n").cast("bigint").alias("items"), F.count("*").alias("distinct_items"),
        F.sum("_all").cast("bigint").alias("bytes"), F.sum(F.col("_all") - F.col("_one")).cast("bigint").alias("bytes_saved"),
    )
