"""Run reports and the batch forms of the incremental jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedupe import first_wins, last_wins

def migration_results(attempts: DataFrame) -> DataFrame:
    """Per address: success when any attempt worked, else the last error.

    ``attempts``: url, attempt (1-based), ok, error; how often to try is the fetcher's matter.
    """
    per = attempts.groupBy("url").agg(F.bool_or("ok").alias("_ok"), F.max_by("error", "attempt").alias("_error"))
    return per.select(
        "url", F.when(F.col("_ok"), "success").otherwise("failed").alias("status"),
        F.when(~F.col("_ok"), F.col("_error")).alias("error"),
    )


def migration_totals(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count("*").alias("articles_requested"), F.count_if(F.col("status") == "success").alias("articles_packaged"),
        F.count_if(F.col("status") == "failed").alias("articles_failed"),
    )


def expected_counts(df: DataFrame, expected: int) -> DataFrame:
    """Found against expected number of rows, with an alert flag."""
    return df.agg(F.count("*").alias("found")).select(
        "found", F.lit(expected).cast("bigint").alias("expected"), (F.col("found") != expected).alias("alert")
    )


def split_totals(df: DataFrame, hit: str, hit_name: str, rest_name: str) -> DataFrame:
    """How many rows meet a condition and how many do not."""
    test = F.coalesce(F.expr(hit), F.lit(False))
    return df.agg(F.count_if(test).alias(hit_name), F.count_if(~test).alias(rest_name))


def newest_versions(snapshots: DataFrame) -> DataFrame:
    """Newest version per page; of equal versions the first arrival stays (replays change nothing)."""
    arrivals = first_wins(snapshots.select("page_id", "version", "seq"), ["page_id", "version"], "seq")
    return last_wins(arrivals, "page_id", "version")


def snapshot_dedup(snapshots: DataFrame) -> DataFrame:
    """First arrival of every (page, version)."""
    return first_wins(snapshots, ["page_id", "version"], "seq")


def outcome_windows(snapshots: DataFrame, width: str = "1 hour") -> DataFrame:
    """Outcome counts per time window."""
    return snapshots.groupBy(F.window("ts", width).alias("_w"), "status").agg(F.count("*").alias("outcomes")).select(
        F.date_format("_w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "status", "outcomes"
    )
