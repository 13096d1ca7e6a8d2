"""Publish, import and audit jobs composed from operators."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import audit as A


def audit(records: DataFrame, remotes: DataFrame, canonical: DataFrame, answers: DataFrame, bundle_links: DataFrame, sources: DataFrame) -> DataFrame:
    """Audit totals over field, link, fallback and missing-link issues."""
    issues = A.field_issues(records, remotes, canonical)
    for part in (
        A.link_issues(answers),
        A.fallback_issues(answers, sources, records),
        A.missing_link_issues(bundle_links, records, answers),
    ):
        issues = issues.unionByName(part)
    return A.summary(records, issues, canonical)
