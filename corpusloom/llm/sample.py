"""Bounded, repeatable samples of labelled rows for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def first_ids(rows: DataFrame, label: str, count: int) -> DataFrame:
    """doc_id of the ``count`` ids of each label that come first in hash order.

    One pass, whatever the number of labels: each task keeps its own first ids before any are shuffled.
    """
    order = Window.partitionBy(label).orderBy(F.xxhash64("doc_id"), "doc_id")
    ranked = rows.select("doc_id", label).withColumn("_rank", F.dense_rank().over(order))
    return ranked.where(F.col("_rank") <= count).select("doc_id").distinct()


def labelled_sample(docs: DataFrame, label: str, rows: int, chars: int) -> DataFrame:
    """(doc_id, text, label): of each label the ``rows`` ids first in hash order, out of texts up to ``chars`` characters.

    The rows are picked on ids alone, so no text is shuffled to choose them; what is picked is bounded by
    ``rows`` x ``chars`` for each label.
    """
    short = docs.where((F.length("text") <= chars) & F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    return short.join(F.broadcast(first_ids(short, label, rows)), "doc_id").select("doc_id", "text", label)
