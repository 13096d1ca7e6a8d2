"""Incremental, reversible line deduplication: cuckoo filters in front of exact reference counts.

State in the shared folder, cut into shards by key:

* ``postings``: one row per (line key, document) - what makes deletions exact;
* ``counts``: the reference counts - per key the number of documents and the smallest one;
* ``filters``: per shard a cuckoo filter over the keys of ``counts``.

Inserting a batch asks the filters first. A key that its filter does not know is new: it is
counted without a look at ``counts``. Only the others are joined with the exact table, so a
filter's false positives cost a lookup and never a wrong result. Deleting documents takes
their postings back, recounts the keys they held, and removes keys without documents from
table and filter.

A key is a line without blanks (U+0020, U+0009-U+000D) at both ends and with A-Z lower-cased;
keys under ``MIN_CHARS`` code points are never counted. Keys are held as 128-bit hashes. A
null or empty text is one empty line. Rows without doc_id keep all their lines and are not
counted; rows that share a doc_id are one document.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from . import text as tx
from .columns import free_name
from .cuckoo import CuckooFilter

MIN_CHARS = 10
INSERTS = 2
KEYS_PER_SHARD = 250_000
BLANKS = " \t\n\x0b\x0c\r"
KEY = ["low", "high"]
FLAGGED = "shard int, low long, high long, refs long, first_doc long, segment int, filter binary"


def line_keys(text: str | None, min_chars: int = MIN_CHARS):
    """Lines of a text, and for each its key or None."""
    lines = (text or "").split("\n")
    keys = []
    for line in lines:
        line = line.strip(BLANKS)
        keys.append(
            hashlib.blake2b(line.encode().lower(), digest_size=16).digest() if len(line) >= min_chars else None
        )
    return lines, keys


def postings_of(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(low, high, doc_id): the distinct keys of every document."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids, blobs = [], []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    own = set(line_keys(text, min_chars)[1]) - {None}
                    blobs.extend(own)
                    ids.extend([doc] * len(own))
                halves = np.frombuffer(b"".join(blobs), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()), pa.array(ids, pa.int64())],
                    names=[*KEY, "doc_id"],
                )

    source = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), "text")
    return source.mapInArrow(tx.frugal(run), "low long, high long, doc_id long")


def counted(postings: DataFrame) -> DataFrame:
    return postings.groupBy(*KEY).agg(F.count("*").alias("refs"), F.min("doc_id").alias("first_doc"))


@dataclass(frozen=True)
class LineIndex:
    """One version of the state: folders of Parquet files; changes give a new version."""

    spark: SparkSession
    shards: int
    postings_paths: tuple[str, ...]
    counts_path: str
    filters_path: str

    @property
    def postings(self) -> DataFrame:
        return self.spark.read.parquet(*self.postings_paths)

    @property
    def counts(self) -> DataFrame:
        return self.spark.read.parquet(self.counts_path)

    @property
    def filters(self) -> DataFrame:
        return self.spark.read.parquet(self.filters_path)


def shard_of(shards: int):
    return F.pmod("high", F.lit(shards)).cast("int").alias("shard")


def frame_of(columns: dict) -> pd.DataFrame:
    return pd.DataFrame(columns).astype({c: "Int64" for c in ("low", "high", "refs", "first_doc", "segment")})


def ask_filters(keys: DataFrame, filters: DataFrame, trust: bool = True) -> DataFrame:
    """Per key the segment that took it as new, or null if its filter may know it already.

    One more row per shard carries the new filter. Without ``trust`` every key is added unasked.
    """

    def run(new: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
        held = CuckooFilter.from_bytes(old["filter"].iloc[0] if len(old) else None)
        low, high = new["low"].to_numpy(np.int64), new["high"].to_numpy(np.int64)
        maybe = held.contains(low, high) if trust else np.zeros(len(new), bool)
        segment = np.full(len(new), -1)
        segment[~maybe] = held.insert(low[~maybe], high[~maybe])
        shard = int((new if len(new) else old)["shard"].iloc[0])
        keys = frame_of({c: new[c] for c in ("shard", "low", "high", "refs", "first_doc")} | {"segment": segment, "filter": None})
        keys["segment"] = keys["segment"].mask(maybe)
        none = [None]
        row = frame_of({"shard": [shard], "low": none, "high": none, "refs": none, "first_doc": none, "segment": none, "filter": [held.to_bytes()]})
        return pd.concat([keys, row]) if len(keys) else row

    return keys.groupBy("shard").cogroup(filters.groupBy("shard")).applyInPandas(run, FLAGGED)


def insert(docs: DataFrame, index: LineIndex | None = None, min_chars: int = MIN_CHARS) -> LineIndex:
    """A version of ``index`` (or a first one) that also holds ``docs`` (doc_id, text).

    A document that the index holds already adds only the keys that are new to it.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "line-index")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{path}/{name}")
        return spark.read.parquet(f"{path}/{name}")

    fresh = postings_of(docs, min_chars).dropDuplicates()
    if index:
        fresh = fresh.join(index.postings, [*KEY, "doc_id"], "left_anti")
    fresh = stored(fresh, "postings")
    shards = index.shards if index else max(1, -(-fresh.count() // KEYS_PER_SHARD))
    filters = index.filters if index else spark.createDataFrame([], "shard int, filter binary")
    flagged = stored(ask_filters(counted(fresh).select(shard_of(shards), "*"), filters), "flagged")
    counts = flagged.where("segment is not null").select(*KEY, "refs", "first_doc", "segment")
    filters_path = f"{path}/filters"
    made = flagged.where("filter is not null").select("shard", "filter")
    if index:
        # Exact look-up of the keys that the filters could not rule out.
        maybe = flagged.where("segment is null and filter is null").select(
            *KEY, F.col("refs").alias("more"), F.col("first_doc").alias("other")
        )
        known = index.counts.join(maybe, KEY, "left").select(
            *KEY, (F.col("refs") + F.coalesce("more", F.lit(0))).alias("refs"),
            F.least("first_doc", "other").alias("first_doc"), "segment",
        )
        # A false positive gets a fingerprint of its own, so that later deletions stay exact.
        wrong = maybe.join(index.counts, KEY, "left_anti").select(
            shard_of(shards), *KEY, F.col("more").alias("refs"), F.col("other").alias("first_doc")
        )
        added = stored(ask_filters(wrong, made, trust=False), "added")
        counts = counts.unionByName(known).unionByName(
            added.where("segment is not null").select(*KEY, "refs", "first_doc", "segment")
        )
        made = added.where("filter is not null").select("shard", "filter")
    stored(counts, "counts")
    stored(made, "filters")
    before = index.postings_paths if index else ()
    return LineIndex(spark, shards, (*before, f"{path}/postings"), f"{path}/counts", filters_path)


def delete(index: LineIndex, doc_ids: DataFrame) -> LineIndex:
    """A version of ``index`` without the documents named in ``doc_ids``; later copies become first again."""
    path = scratch_path(index.spark, "line-index")
    ids = doc_ids.select(F.col("doc_id").cast("long")).where("doc_id is not null").distinct()
    touched = index.postings.join(ids, "doc_id", "left_semi").select(*KEY).distinct()
    touched.write.parquet(f"{path}/touched")
    touched = index.spark.read.parquet(f"{path}/touched")
    index.postings.join(ids, "doc_id", "left_anti").select(*KEY, "doc_id").write.parquet(f"{path}/postings")
    rest = index.spark.read.parquet(f"{path}/postings")
    recount = counted(rest.join(touched, KEY, "left_semi"))
    held = index.counts.join(touched, KEY, "left_semi").select(*KEY, "segment").join(recount, KEY, "left")
    alive = held.where("refs is not null").select(*KEY, "refs", "first_doc", "segment")
    index.counts.join(touched, KEY, "left_anti").unionByName(alive).write.parquet(f"{path}/counts")

    def run(dead: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
        filters = CuckooFilter.from_bytes(old["filter"].iloc[0] if len(old) else None)
        filters.delete(dead["low"].to_numpy(np.int64), dead["high"].to_numpy(np.int64), dead["segment"].to_numpy(np.int32))
        return pd.DataFrame({"shard": [int((old if len(old) else dead)["shard"].iloc[0])], "filter": [filters.to_bytes()]})

    dead = held.where("refs is null").select(shard_of(index.shards), *KEY, "segment")
    made = dead.groupBy("shard").cogroup(index.filters.groupBy("shard")).applyInPandas(run, "shard int, filter binary")
    made.write.parquet(f"{path}/filters")
    return LineIndex(index.spark, index.shards, (f"{path}/postings",), f"{path}/counts", f"{path}/filters")


def drop_repeated(docs: DataFrame, index: LineIndex, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` (all held by ``index``) with repeated lines left only in the smallest document holding them.

    Keeps the columns of ``docs``, with the new ``text``, and adds n_lines (before) and n_dropped, which replace
    columns of those names.
    """
    repeated = index.counts.where("refs > 1").select(*KEY, "first_doc")
    docs = docs.drop("n_lines", "n_dropped")
    keep = docs.columns
    drop_id, low_name, high_name = (free_name(keep, name) for name in ("_drop_id", "_low", "_high"))
    drops = (
        index.postings.join(repeated, KEY)
        .where("doc_id <> first_doc")
        .groupBy(F.col("doc_id").alias(drop_id))
        .agg(F.collect_list("low").alias(low_name), F.collect_list("high").alias(high_name))
    )
    at = keep.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])

    def run(batches):
        for batch in batches:
            low, high = batch.column(len(keep)), batch.column(len(keep) + 1)
            texts, n_lines, n_dropped = [], [], []
            for row, text in enumerate(batch.column(at).to_pylist()):
                if not low[row].is_valid:
                    texts.append(text or "")
                    n_lines.append((text or "").count("\n") + 1)
                    n_dropped.append(0)
                    continue
                halves = np.stack([x[row].values.to_numpy() for x in (low, high)], axis=1).tobytes()
                gone = {halves[i : i + 16] for i in range(0, len(halves), 16)}
                lines, keys = line_keys(text, min_chars)
                left = [line for line, key in zip(lines, keys) if key not in gone]
                texts.append("\n".join(left))
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(left))
            columns = [batch.column(i) if i != at else pa.array(texts, batch.schema.field(at).type) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_lines), pa.array(n_dropped)], names=schema.names)

    joined = docs.join(drops, F.col("doc_id").cast("long") == F.col(drop_id), "left")
    return joined.select(*keep, low_name, high_name).mapInArrow(tx.frugal(run), schema)


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, inserts: int = INSERTS) -> DataFrame:
    """Index all ``docs`` in several inserts and drop their repeated lines; see :func:`drop_repeated`.

    From the second insert on the filters rule out the look-up of every key that is new.
    """
    index = None
    for turn in range(inserts):
        index = insert(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(inserts)) == turn), index, min_chars)
    return drop_repeated(docs, index, min_chars)
