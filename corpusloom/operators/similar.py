"""Near-duplicate candidates for review; sources are never merged or dropped.

Items that share a bucket are not all paired with each other. Each bucket elects its
lowest id as leader, which asks every other member. A member that matches joins the
leader's class and asks in turn those that all before it refused; when nobody in the
class is left to ask, the rest elect the next leader. So two members of a bucket were
either compared or are joined by links that hold: links have the same connected
components as all matching pairs of a bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types

from ..functions import text as T
from ..session import materialize, scratch_path, shuffles_dropped, staged
from . import buckets as B

# Workers need not have this package.
cloudpickle.register_pickle_by_value(B)

# Rows and elements of sets of a bucket whose turns one task takes: some 64 MB of elements, a few times that with their index.
TASK_MEMBERS = 1 << 14
TASK_ELEMENTS = 8 << 20
# Bytes of the blocks that one block of vectors meets in a task, and rows of it that meet a block at once.
MEETING_BYTES = 32 << 20
MEETING_ROWS = 256


def linked_candidates(
    members: DataFrame, features: DataFrame, score: Callable[[Column, Column], Column], threshold: float, small: int = 32
) -> DataFrame:
    """(id, candidate_of, score) with score >= threshold and candidate_of < id.

    ``members``: bucket, id; ``features``: id, feature (read every round). More members of a class ask each round, as
    the first ones leave few to ask. What is left of a bucket below ``small`` members is compared at once. Where nobody
    matched a leader, more of the lowest ids stand for election: those that match nobody all leave, the lowest one that
    matches somebody is the leader, and the others stay, their links unnoted.

    With :func:`jaccard` pairs whose bitmaps rule a match out are not scored, and after the first round a task takes all
    turns of a bucket, except for buckets so large that their members' sets might not fit it; these go on in rounds. The
    turns, and so the links, are the same either way.
    """
    spark, kind, bounded = members.sparkSession, members.schema["id"].dataType.simpleString(), score is jaccard
    # A member that is alone in its bucket has nobody to ask.
    start = members.select("bucket", "id").where("id IS NOT NULL").repartition("bucket").distinct()
    start = start.withColumn("_all", F.count(F.lit(1)).over(Window.partitionBy("bucket"))).where("_all > 1").drop("_all")
    one = F.lit(1).cast("long")
    left = staged(start.withColumns({"queued": F.lit(False), "width": one, "leaders": one}), "left")
    links = scratch_path(spark, "links")
    empty = features.select("id", F.col("id").alias("candidate_of"), F.lit(0.0).alias("score")).limit(0)
    empty.write.parquet(links)
    if bounded:
        sketches = staged(features.select("id", "feature").mapInArrow(B.sketch, f"id {kind}, n int, bits binary"), "sketches")
    open_ids, standing = features.count(), 1
    by_id = Window.partitionBy("bucket").orderBy("id")
    while not left.isEmpty():
        # Few members outlive the first rounds: only their features are read from then on.
        needed = left.select("id").distinct()
        if (n := needed.count()) * 4 < open_ids:
            features, open_ids = staged(features.join(needed, "id", "left_semi"), "features"), n
        if bounded and standing > 1:
            sizes = left.join(sketches, "id", "left").groupBy("bucket").agg(F.count(F.lit(1)).alias("_m"), F.sum("n").alias("_n"))
            fits = staged(sizes.where(f"_m <= {TASK_MEMBERS} AND coalesce(_n, 0) <= {TASK_ELEMENTS}").select("bucket"), "fits")
            _in_tasks(left.join(fits, "bucket", "left_semi"), sketches, features, threshold, small, standing).write.mode("append").parquet(links)
            left = staged(left.join(fits, "bucket", "left_anti"), "left")
            if left.isEmpty():
                break
        counts = left.groupBy("bucket").agg(
            F.count_if("queued").alias("_q"), F.count_if(~F.col("queued")).alias("_u"), F.min(F.when(F.col("queued"), F.col("id"))).alias("_next")
        )
        turn = F.when(F.expr(f"_q + _u <= {small}"), "all").when(F.col("_q") == 0, "elect").otherwise("ask")
        # A bucket without anybody to ask is done.
        counts = counts.filter("_u > 0 AND _q + _u > 1").withColumn("turn", turn)
        first = left.filter("NOT queued").select("bucket", "id", "leaders", F.row_number().over(by_id).alias("_at"))
        first = first.filter(f"_at <= {standing} AND _at <= leaders").select("bucket", "id", F.lit(True).alias("_stands"))
        asks = (
            F.when(F.col("turn") == "all", True)
            .when(F.col("turn") == "elect", F.coalesce("_stands", F.lit(False)))
            .otherwise(F.col("queued") & ((F.col("id") == F.col("_next")) | (F.pmod(F.xxhash64("id"), F.col("_q")) < F.col("width"))))
        )
        live = left.join(counts, "bucket").join(first, ["bucket", "id"], "left").withColumn("asks", asks)
        live = staged(live.drop("_q", "_u", "_stands", "_next"), "live")
        askers = live.filter("asks").select("bucket", F.col("id").alias("asker"), F.col("queued").alias("_matched"))
        once = (F.col("turn") != "all") | F.col("_matched") | (F.col("asker") < F.col("id"))
        pairs = live.filter("NOT queued").join(askers, "bucket").filter((F.col("id") != F.col("asker")) & once)
        pairs = staged(
            pairs.select("bucket", "turn", "asker", "id", F.least("id", "asker").alias("low"), F.greatest("id", "asker").alias("high")), "pairs"
        )
        apart, close = pairs.select("low", "high").distinct(), features
        if bounded:
            apart = staged(_possible(apart, sketches, threshold, kind), "possible")
            close = apart.select(F.col("low").alias("id")).unionAll(apart.select("high")).distinct()
            close = staged(features.join(close, "id", "left_semi"), "close")
        scored = apart.join(close.select(F.col("id").alias("low"), F.col("feature").alias("_low")), "low")
        scored = scored.join(close.select(F.col("id").alias("high"), F.col("feature").alias("_high")), "high")
        scored = scored.select("low", "high", score(F.col("_high"), F.col("_low")).alias("score")).where(F.col("score") >= threshold)
        matches = pairs.join(staged(scored, "scored"), ["low", "high"])
        matched = matches.filter(F.col("turn") == "elect").select("bucket", F.col("asker").alias("id")).distinct()
        leader = matched.groupBy("bucket").agg(F.min("id").alias("_leader"))
        heard = matches.join(leader, "bucket", "left").filter("turn <> 'elect' OR asker = _leader")
        heard = staged(heard, "heard")
        heard.select(F.col("high").alias("id"), F.col("low").alias("candidate_of"), "score").distinct().write.mode("append").parquet(links)
        met = heard.filter("turn <> 'all'").select("bucket", "id", F.lit(True).alias("_met")).distinct()
        elected = F.col("turn") == "elect"
        rest = live.filter("turn <> 'all'").join(met, ["bucket", "id"], "left").join(leader, "bucket", "left")
        rest = rest.join(matched.withColumn("_stays", F.lit(True)), ["bucket", "id"], "left")
        fewer, more = F.greatest(F.floor(F.col("leaders") / 2), one), F.least(F.col("leaders") * 4, F.lit(B.MOST_LEADERS).cast("long"))
        left = staged(
            rest.filter("NOT asks OR (_stays AND id <> _leader)").select(
                "bucket",
                "id",
                (F.col("queued") | F.coalesce("_met", F.lit(False))).alias("queued"),
                F.when(elected, one).otherwise(F.col("width") * 4).alias("width"),
                F.when(~elected, F.col("leaders")).when(F.col("_leader").isNull(), more).otherwise(fewer).cast("long").alias("leaders"),
            ),
            "left",
        )
        standing = min(standing * 4, B.MOST_LEADERS)
    return spark.read.parquet(links).distinct()


def _possible(pairs: DataFrame, sketches: DataFrame, threshold: float, kind: str) -> DataFrame:
    """The pairs (low, high) whose sizes and bitmaps allow a Jaccard similarity of the threshold."""
    side = lambda name: sketches.select(F.col("id").alias(name), F.col("n").alias(f"n_{name}"), F.col("bits").alias(f"bits_{name}"))
    both = pairs.join(side("low"), "low").join(side("high"), "high")
    both = both.where(F.least("n_low", "n_high") >= F.greatest("n_low", "n_high") * threshold - 1e-6)
    both = both.select("low", "high", "n_low", "bits_low", "n_high", "bits_high")
    return both.mapInArrow(lambda batches: B.possible(batches, threshold), f"low {kind}, high {kind}").distinct()


def _in_tasks(left: DataFrame, sketches: DataFrame, features: DataFrame, threshold: float, small: int, standing: int) -> DataFrame:
    """(id, candidate_of, score): the turns of whole buckets; only members whose bitmaps allow a match bring their sets."""
    kind = left.schema["id"].dataType.simpleString()
    known = left.select("bucket", "id", "queued").join(sketches, "id")
    may = known.groupBy("bucket").applyInArrow(lambda table: B.flagged(table, threshold), f"bucket bigint, id {kind}")
    may = staged(may, "may")
    close = may.join(features.join(may.select("id").distinct(), "id", "left_semi").select("id", "feature"), "id")
    rows = left.withColumn("mark", F.xxhash64("id")).join(close, ["bucket", "id"], "left")
    return rows.groupBy("bucket").applyInArrow(
        lambda table: B.settled(table, threshold, small, standing), f"id {kind}, candidate_of {kind}, score double"
    )


def shingles(text: Column, width: int = 3) -> Column:
    """Distinct word shingles of a whole text, hashed; short texts give one shingle."""
    words = F.split(T.clean_text(T.fold(text)), " ")

    def cut(w: Column) -> Column:
        # The last words begin shingles that are too short, cut off unless there is no other.
        rows = F.transform(w, lambda x, i: F.xxhash64(F.concat_ws(" ", x, *(F.get(w, i + k) for k in range(1, width)))))
        return F.slice(rows, 1, F.greatest(F.size(w) - (width - 1), F.lit(1)))

    # Binding the word list to a lambda variable splits a text once, not per shingle.
    return F.array_distinct(F.get(F.transform(F.array(words), cut), F.lit(0)))


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def near_duplicates(documents: DataFrame, threshold: float = 0.7, bands: int = 16, rows: int = 2) -> DataFrame:
    """Near-duplicate text candidates by shingle overlap.

    Exact copies are candidates of their lowest id, which alone goes on. One hash per shingle is
    spread over bins; the minimum per bin is the signature, two bins are a band.
    """
    with shuffles_dropped(documents.sparkSession):
        return _near_duplicates(documents, threshold, bands, rows)


def _near_duplicates(documents: DataFrame, threshold: float, bands: int, rows: int) -> DataFrame:
    documents = documents.withColumn("_sha", T.sha256_text(F.col("text")))
    distinct = documents.groupBy("_sha").agg(F.min_by(F.struct("id", "text"), "id").alias("_d")).select("_sha", "_d.*")
    first = distinct.select("_sha", F.col("id").alias("candidate_of"))
    copies = documents.select("_sha", "id").join(first, "_sha").filter("id <> candidate_of").select("id", "candidate_of", F.lit(1.0).alias("jaccard"))
    features = staged(distinct.select("id", shingles(F.col("text")).alias("feature")), "features")
    bins = bands * rows
    minima = (
        features.select("id", F.explode("feature").alias("h"))
        .groupBy("id", F.pmod("h", F.lit(bins)).alias("bin")).agg(F.min("h").alias("h"))
    )
    # A band needs all its bins; short texts that leave bins empty use what they have.
    buckets = minima.groupBy("id", F.floor(F.col("bin") / rows).alias("band")).agg(F.array_sort(F.collect_list("h")).alias("_key"))
    members = buckets.select(F.xxhash64("band", "_key").alias("bucket"), "id")
    links = linked_candidates(members, features, jaccard, threshold).withColumnRenamed("score", "jaccard")
    return links.unionByName(copies)


def similar_vectors(vectors: DataFrame, dimension: int, threshold: float = 0.9, k: int = 10, block: int = 2048) -> DataFrame:
    """(id, candidate_of, cosine, rank, n_similar): the ``k`` most similar vectors of each one, exactly.

    Vectors are packed into blocks and every block meets every block, so no pair at the threshold or above is
    missed; ``n_similar`` counts all of them, also those after the k-th. Products in single precision, whose error
    is bounded, leave out the pairs that lie below; the cosines of all others are made in double precision. Cosines are
    rounded to 12 digits, ties go to the smaller id. A task meets one block with many and hands on its best alone.
    ``id`` is unique (repeated rows count once); null and zero vectors and those with a
    component that is null or not finite have no cosine and take no part; another length is an error.
    """
    kind = vectors.schema["id"].dataType
    sized = F.when(F.size("feature") == dimension, F.col("feature").cast("array<double>")).otherwise(
        F.raise_error(F.concat(F.lit("vector of another length: "), F.col("id").cast("string")))
    )
    odd = F.exists("feature", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.filter("id IS NOT NULL AND feature IS NOT NULL").select("id", sized.alias("feature"))
    rows = rows.filter(~odd & F.exists("feature", lambda x: x != 0))
    count = max(1, -(-vectors.count() // block))
    packed = (
        rows.groupBy(F.pmod(F.xxhash64("id"), F.lit(count)).alias("block"))
        .agg(F.array_sort(F.collect_set(F.struct("id", "feature"))).alias("_r"))
        .select("block", F.col("_r.id").alias("ids"), F.flatten("_r.feature").alias("data"))
    )
    # A partition holds one block; the cross join reads blocks again instead of shuffling a copy for each pair.
    packed = materialize(packed.repartitionById(count, F.col("block").cast("int")))
    many = packed.coalesce(-(-count // max(1, MEETING_BYTES // (block * dimension * 8))))
    pairs = packed.select(*(F.col(c).alias(f"_{c}") for c in packed.columns)).crossJoin(many)
    hit = types.StructType([types.StructField("minus", types.DoubleType()), types.StructField("candidate_of", kind)])
    schema = types.StructType(
        [types.StructField("id", kind), types.StructField("hits", types.ArrayType(hit)), types.StructField("n", types.LongType())]
    )
    # A product of unit vectors errs by (dimension + 2) / 2 ** 24 at most in single precision; twice that and more is left.
    low = np.float32(threshold - (dimension + 8) * 2.0**-23)

    def unit(values: pa.ListScalar) -> np.ndarray:
        matrix = values.values.to_numpy().reshape(-1, dimension)
        matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
        return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)

    def first(at: np.ndarray, *order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of hits by row and order, and how many hits of the row stand before each."""
        by = np.lexsort((*reversed(order), at))
        return by, np.arange(len(at)) - np.searchsorted(at[by], at[by])

    def near(asking: np.ndarray, asked: np.ndarray, about: np.ndarray, own: int | None) -> tuple[np.ndarray, ...]:
        """Row, column and cosine of the hits of a few rows, the k best of a row, and the count of all by row."""
        at, column = np.divmod(np.flatnonzero(about >= low), len(asked))
        if len(at) * 16 < about.size:
            score = np.round(np.einsum("ij,ij->i", asking[at], asked[column]), 12)
            keep = score >= threshold
            if own is not None:
                keep &= at + own != column
            at, column, score = at[keep], column[keep], score[keep]
            n = np.bincount(at, minlength=len(asking))
            if n.max() > k:
                by, before = first(at, -score, column)
                by = by[before < k]
                at, column, score = at[by], column[by], score[by]
            return at, column, score, n
        score = np.round(asking @ asked.T, 12)
        if own is not None:
            score[np.arange(len(asking)), np.arange(len(asking)) + own] = -np.inf
        similar = score >= threshold
        n = similar.sum(axis=1)
        full = np.flatnonzero(n > k)
        if len(full):
            # Candidates stand in order of their ids: of those that tie for the last place the first stay.
            part = score[full]
            last = -np.partition(-part, k - 1, axis=1)[:, k - 1 : k]
            above, tie = part > last, part == last
            similar[full] = above | (tie & (np.cumsum(tie, axis=1) <= k - above.sum(axis=1, keepdims=True)))
        at, column = np.nonzero(similar)
        return at, column, score[at, column], n

    def best_of(ids: pa.Array, n: np.ndarray, hits: list[tuple[np.ndarray, np.ndarray, pa.Array]]) -> pa.RecordBatch:
        """The rows that have hits, with their k best over all blocks met and those that tie with the last of them."""
        at, minus = (np.concatenate([h[i] for h in hits]) for i in (0, 1))
        by, before = first(at, minus)
        at, minus = at[by], minus[by]
        last = minus[np.minimum(np.arange(len(at)) - before + k, np.searchsorted(at, at, side="right")) - 1]
        keep = minus <= last
        some = np.flatnonzero(n)
        bounds = np.concatenate([[0], np.cumsum(np.bincount(at[keep], minlength=len(n))[some])])
        candidates = pa.concat_arrays([h[2] for h in hits]).take(pa.array(by[keep]))
        found = pa.StructArray.from_arrays([pa.array(minus[keep]), candidates], names=["minus", "candidate_of"])
        lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), found)
        return pa.RecordBatch.from_arrays([ids.take(pa.array(some)), lists, pa.array(n[some], pa.int64())], names=["id", "hits", "n"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, ids, n, hits = None, None, None, []
        space = np.empty(0, np.float32)
        for batch in batches:
            for row in range(batch.num_rows):
                asking, asking_ids, asking_data, asked, asked_ids, asked_data = (c[row] for c in batch.columns)
                if asking.as_py() != current:
                    if hits:
                        yield best_of(ids, n, hits)
                    current, ids, hits = asking.as_py(), asking_ids.values, []
                    left = unit(asking_data)
                    left_single, n = left.astype(np.float32), np.zeros(len(left), np.int64)
                right = unit(asked_data)
                right_single = right.astype(np.float32).T
                if len(space) < MEETING_ROWS * len(right):
                    space = np.empty(MEETING_ROWS * len(right), np.float32)
                for start in range(0, len(left), MEETING_ROWS):
                    some = slice(start, min(start + MEETING_ROWS, len(left)))
                    about = space[: (some.stop - start) * len(right)].reshape(-1, len(right))
                    np.matmul(left_single[some], right_single, out=about)
                    at, column, score, found = near(left[some], right, about, start if asked.as_py() == current else None)
                    n[some] += found
                    if len(at):
                        hits.append((at + start, -score, asked_ids.values.take(pa.array(column))))
        if hits:
            yield best_of(ids, n, hits)

    best = F.slice(F.array_sort(F.flatten(F.collect_list("hits"))), 1, k)
    ranked = pairs.mapInArrow(meet, schema).groupBy("id").agg(best.alias("_h"), F.sum("n").alias("n_similar"))
    ranked = ranked.select("id", "n_similar", F.posexplode("_h").alias("_p", "_c"))
    return ranked.select(
        "id", "_c.candidate_of", (-F.col("_c.minus")).alias("cosine"), (F.col("_p") + 1).alias("rank"), "n_similar"
    )
