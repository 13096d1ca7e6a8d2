"""Token ids in ORC: run-length encoded stripes, row indexes, and Bloom filters on document ids.

Documents are dealt to ranges of doc_id, sorted, encoded where they lie and written, one file for a
range: the concatenation of the files in range order is the token stream of the corpus. A file holds
doc_id, n_tokens, its part number, the row's start inside the part, and the ids as an integer list,
which ORC writes in run-length encoding. Stripes are read in parallel; a filter on doc_id is pushed to
the file's statistics, row indexes and Bloom filters, so a look-up of a few documents reads a few row
groups. Only text is shuffled, never ids, and a lost task writes its file again.

Null and empty texts have only the end id. Rows without doc_id come first; rows that share a doc_id
are ordered by a hash of their text, and each keeps a place of its own.
"""

from __future__ import annotations

import functools
import json
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .bpe import byte_alphabet, library, text_parts

END = 0
LONG_BLANK = 50_000
BLANKS = re.compile(r"\s{%d}" % LONG_BLANK)
SCHEMA = "doc_id long, n_tokens long, part int, part_start long, ids array<int>"
ORC = {
    "compression": "zstd",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.stripe.size": str(16 << 20),
}


class LibraryEncoder:
    """Ids as the tokenizers library gives them for a byte-level vocabulary file.

    When the ids of the file are in merge order, as in public files, the same merges are run by tiktoken,
    which is several times faster; otherwise by the tokenizers library itself. So are texts with a run of
    ``LONG_BLANK`` blanks or more, for which tiktoken's pattern engine runs out of stack.
    """

    def __init__(self, blob: bytes, pattern: str):
        spec = json.loads(blob)
        level, model = spec["pre_tokenizer"], spec["model"]
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        order = [model["vocab"][a + b] for a, b in pairs]
        plain = (
            level["type"] == "ByteLevel" and level["use_regex"] and not level["add_prefix_space"] and not spec["normalizer"]
            and not model.get("end_of_word_suffix") and not model.get("continuing_subword_prefix") and not model.get("ignore_merges")
            and len(order) + 256 == len(model["vocab"]) and order == sorted(set(order))
        )
        if plain:
            import tiktoken

            back = {c: b for b, c in enumerate(byte_alphabet())}
            ranks = {bytes(back[c] for c in token): i for token, i in model["vocab"].items()}
            self.encoding = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens=self.added)
        self.encode = self._fast if plain else self._library
        self.blob, self.tokenizer = blob, None

    def _fast(self, text: str) -> np.ndarray:
        if len(text) >= LONG_BLANK and BLANKS.search(text):
            return self._library(text)
        return self.encoding.encode_to_numpy(text, allowed_special="all")

    def _library(self, text: str) -> np.ndarray:
        if self.tokenizer is None:
            self.tokenizer = library(self.blob)
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)


@functools.lru_cache(2)
def encoder(blob: bytes, pattern: str) -> LibraryEncoder:
    return LibraryEncoder(blob, pattern)


def write_tokens(docs: DataFrame, path: str, vocabulary: bytes, pattern: str, end: int = END, parts: int | None = None) -> None:
    """Encode ``docs`` (doc_id, text) and write the token stream below ``path``, in ascending doc_id order."""

    def run(batches):
        own = encoder(vocabulary, pattern)
        part = TaskContext.get().partitionId()
        start = 0
        for batch in batches:
            for first, texts in text_parts(batch.column(1)):
                found = [np.append(own.encode(t) if t else np.zeros(0, np.uint32), np.uint32(end)) for t in texts]
                lengths = np.array([len(f) for f in found], np.int64)
                bounds = np.concatenate([[0], np.cumsum(lengths)])
                ids = np.concatenate(found).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(texts)),
                        pa.array(lengths),
                        pa.array(np.full(len(texts), part, np.int32)),
                        pa.array(start + bounds[:-1]),
                        pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids)),
                    ],
                    names=["doc_id", "n_tokens", "part", "part_start", "ids"],
                )
                start += int(bounds[-1])

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    ranged = rows.repartitionByRange(parts, *order) if parts else rows.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).mapInArrow(run, SCHEMA).write.options(**ORC).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, n_tokens, start (ids of all documents before it) and ids; stripes are read in parallel."""
    stored = spark.read.schema(SCHEMA).orc(path)
    sizes = stored.groupBy("part").agg(F.sum("n_tokens").alias("size"))  # a row for each file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    return stored.join(base, "part").select("doc_id", "n_tokens", (F.col("base") + F.col("part_start")).alias("start"), "ids")


def find_documents(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Stored rows of a few documents: row groups that cannot hold them are not read."""
    return spark.read.schema(SCHEMA).orc(path).where(F.col("doc_id").isin(doc_ids)).select("doc_id", "n_tokens", "ids")


def checksums(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of rows from :func:`read_tokens`."""

    def run(batches):
        for batch in batches:
            lists = batch.column(3)
            bounds = lists.offsets.to_numpy()
            values = lists.values.to_numpy().astype("<u4", copy=False)
            sums = [zlib.crc32(values[a:b].data) for a, b in zip(bounds[:-1], bounds[1:])]
            counts = pa.array(np.diff(bounds), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), counts, pa.array(sums, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
