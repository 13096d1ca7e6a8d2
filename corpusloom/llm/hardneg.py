"""Hard negatives by anchor-clustered shared lists.

Anchors of a block are clustered by direction. A cluster has a centre and the largest angle of a member to
it, so for a row at angle ``a`` to the centre no member scores more than (member's norm) x (row's norm) x
cos(a - largest angle). For each cluster the rows of a slice are sorted by that bound once, and all members walk
this one list; a member stops as soon as the next bound is below what it still needs (its k-th best score, or the
lower end of its widest band). What a member needs is kept from slice to slice, so later slices are cut shorter.

Rows are read where they lie and never shuffled: each pass over them carries one bounded block of anchors (``BLOCK``),
and each task returns its winners per anchor, which a window merges. Two passes are made for a block: the
positives (best rows of the anchor's own label), then the negatives (best rows of other labels whose score lies
inside the band that each positive gives).

Rows with a null vec_id, label or vector, or with a null or non-finite component, take no part. Rows of another
length than the anchor's never meet it. Rows with the anchor's vec_id are the anchor itself; of a repeated anchor
the first in (vector, label) order asks. Repeated rows of a candidate count once each; ties go to the smaller
vec_id. Scores are exact integers (see :func:`topk.products`); a score beyond 64 bits raises an error. Empty tables
give no rows, and further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import scratch_path
from .topk import products

BLOCK = 4096  # anchors carried by a pass
SLICE = 8192  # rows sorted at a time
MEMBERS = 24  # wanted members of a cluster
ROUNDS = 6  # of clustering
PROBE = 2048  # rows looked at first for lower bounds
SLACK = 1e-9  # of rounding, relative to the product of the norms
VECTORS = "vec_id long, label long, vector array<double>"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def labelled_vectors(rows: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, label, vector of integral doubles) of the rows that take part."""
    parts = F.transform("embedding", lambda x: x.cast("double"))
    rows = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), parts.alias("vector"))
    rows = rows.where("vec_id is not null and label is not null and vector is not null")
    rows = rows.where(F.forall("vector", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))))
    # floor() gives a long; doubles from 2^50 on are whole already and may not fit one.
    whole = F.transform("vector", lambda x: F.when(F.abs(x) < 2.0**50, F.floor(x * scale).cast("double")).otherwise(x * scale))
    return rows.select("vec_id", "label", whole.alias("vector"))


@dataclass
class Cluster:
    members: np.ndarray  # rows of the block, all of one length
    centre: np.ndarray
    spread: float  # largest angle of a member to the centre


def unit(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(norms > 0, norms, 1)


def angle(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1, 1))


def clusters_of(vectors: np.ndarray, rows: np.ndarray) -> list[Cluster]:
    """Spherical k-means over a block's anchors of one length; starts are spread over the block."""
    count = max(1, len(rows) // MEMBERS)
    points = unit(vectors)
    centres = points[np.linspace(0, len(points) - 1, count).astype(int)]
    for _ in range(ROUNDS):
        owner = (points @ centres.T).argmax(axis=1) if points.shape[1] else np.zeros(len(points), int)
        sums = np.zeros_like(centres)
        np.add.at(sums, owner, points)
        moved = np.linalg.norm(sums, axis=1) > 1e-12
        centres = np.where(moved[:, None], unit(sums), centres)
    owner = (points @ centres.T).argmax(axis=1) if points.shape[1] else np.zeros(len(points), int)
    found = []
    for k in np.unique(owner).tolist():
        own = np.flatnonzero(owner == k)
        real = np.linalg.norm(vectors[own], axis=1) > 0  # a zero vector scores 0 with everything
        spread = float(angle(points[own][real] @ centres[k]).max(initial=0.0))
        found.append(Cluster(rows[own], centres[k], spread))
    return found


class Best:
    """The k best (score, vec_id) of each of several wants, best first; scores below a want's floor are of no use."""

    def __init__(self, floors: list, k: int):
        self.floors, self.k = floors, k
        self.scores: list[np.ndarray] = [np.zeros(0, np.int64)] * len(floors)
        self.ids: list[np.ndarray] = [np.zeros(0, np.int64)] * len(floors)

    def needs(self, want: int):
        """Scores below this cannot enter."""
        scores = self.scores[want]
        return self.floors[want] if len(scores) < self.k else max(self.floors[want], int(scores[-1]))

    def add(self, want: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores = np.concatenate([self.scores[want], scores])
        ids = np.concatenate([self.ids[want], ids])
        if scores.dtype == object:
            order = np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i])), np.int64)[: self.k]
        else:
            order = np.lexsort((ids, -scores))[: self.k]
        self.scores[want], self.ids[want] = scores[order], ids[order]


class Block:
    """Anchors of one pass, with the bands in which each looks for rows.

    ``bands`` holds, for each anchor, (lowest, highest) pairs of scores times 100; a search for positives has
    one band without ends. ``same`` tells whether rows of the anchor's own label or of other labels are wanted.
    """

    def __init__(self, ids, labels, vectors: list[np.ndarray], bands: list[list[tuple[float, float]]], same: bool, k: int):
        self.ids, self.labels, self.bands, self.same, self.k = ids, labels, bands, same, k
        self.vectors = vectors
        self.sizes = np.array([len(v) for v in vectors], np.int64)
        self.first = np.concatenate([[0], np.cumsum([len(b) for b in bands])])
        self.floors = [low if low == -np.inf else -(-low // 100) for own in bands for low, _ in own]
        self.groups: dict[int, list[Cluster]] = {}
        for size in np.unique(self.sizes).tolist():
            rows = np.flatnonzero((self.sizes == size) & (np.diff(self.first) > 0))
            if len(rows):
                self.groups[size] = clusters_of(np.stack([vectors[r] for r in rows]), rows)

    def search(self, slices: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[Best, int, int]:
        """The best rows of each band over slices of (ids, labels, matrix); scored and possible pairs."""
        best = Best(self.floors, self.k)
        scored = possible = 0
        for ids, labels, rows in slices:
            norms = np.linalg.norm(rows, axis=1)
            points = unit(rows)
            for cluster in self.groups.get(rows.shape[1], []):
                away = angle(points @ cluster.centre) - cluster.spread
                bound = norms * np.cos(np.clip(away, 0, np.pi))
                order = np.argsort(-bound, kind="stable")
                scored += self.walk(cluster, best, ids[order], labels[order], rows[order], norms[order], bound[order])
                possible += len(order) * len(cluster.members)
        return best, scored, possible

    def lowest(self, anchor: int, best: Best) -> float:
        """No row scoring less than this is of use to the anchor."""
        return min(best.needs(w) for w in range(self.first[anchor], self.first[anchor + 1]))

    def walk(self, cluster: Cluster, best: Best, ids, labels, rows, norms, bound) -> int:
        """All members walk one sorted list, in growing steps; each leaves when the next bound is too small."""
        members = cluster.members
        vectors = np.stack([self.vectors[m] for m in members])
        size = np.linalg.norm(vectors, axis=1)
        reach = float(size.max(initial=0.0) * norms.max(initial=0.0))
        slack = SLACK * (1 + size * norms.max(initial=0.0))
        active = np.ones(len(members), bool)
        at, step, scored = 0, 256, 0
        while at < len(ids):
            need = np.array([self.lowest(m, best) if a else np.inf for m, a in zip(members, active)], float)
            active &= size * bound[at] + slack >= need
            if not active.any():
                break
            part = slice(at, at + step)
            on = np.flatnonzero(active)
            scored += len(on) * len(ids[part])
            if reach < 2.0**52:  # by Cauchy-Schwarz every partial sum is exact
                found = (vectors[on] @ rows[part].T).astype(np.int64)
            else:
                found = [products(vectors[i], rows[part], size[i], norms[part]).astype(object) for i in on]
            for i, scores in zip(on, found):
                self.keep(members[i], best, scores, ids[part], labels[part])
            at, step = at + step, step * 2
        return scored

    def keep(self, anchor: int, best: Best, scores, ids, labels) -> None:
        use = (scores >= self.lowest(anchor, best)) & (ids != self.ids[anchor]) & ((labels == self.labels[anchor]) == self.same)
        if not use.any():
            return
        scores, ids = scores[use], ids[use]
        for want, (low, high) in zip(range(self.first[anchor], self.first[anchor + 1]), self.bands[anchor]):
            inside = scores >= best.needs(want)
            if high != np.inf:
                inside &= (100 * scores >= low) & (100 * scores <= high)
            if inside.any():
                best.add(want, scores[inside], ids[inside])


def slices_of(batches) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Matrices of at most ``SLICE`` rows of one vector length, over all batches of a task."""
    held: dict[int, list] = {}
    for batch in batches:
        lists = batch.column(2)
        ids, labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
        sizes = np.diff(offsets)
        for size in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == size)
            matrix = values[offsets[rows][:, None] + np.arange(size)] if size else np.zeros((len(rows), 0))
            held.setdefault(size, []).append((ids[rows], labels[rows], matrix))
            if sum(len(h[0]) for h in held[size]) >= SLICE:
                yield tuple(np.concatenate(x) for x in zip(*held.pop(size)))
    for parts in held.values():
        yield tuple(np.concatenate(x) for x in zip(*parts))


def search(rows: DataFrame, block: Block) -> DataFrame:
    """(want, vec_id, score, rank): the k best rows of each want of the block."""

    def run(batches):
        best, _, _ = block.search(slices_of(batches))
        wants = [np.full(len(s), w, np.int64) for w, s in enumerate(best.scores)]
        if wants:
            scores = np.array([int(s) for own in best.scores for s in own], np.int64)
            columns = [np.concatenate(wants), np.concatenate(best.ids), scores]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["want", "vec_id", "score"])

    found = rows.mapInArrow(run, "want long, vec_id long, score long")
    order = Window.partitionBy("want").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= block.k)


def best_rows(rows: DataFrame, probe: DataFrame, block: Block) -> DataFrame:
    """:func:`search`, with floors: the k-th best score among a few rows is a lower bound on that among all.

    So a task returns only rows that beat the probe, however many tasks there are.
    """
    for r in search(probe, block).where(F.col("rank") == block.k).select("want", "score").collect():  # a row a want
        block.floors[r.want] = max(block.floors[r.want], r.score)
    return search(rows, block)


def blocks_of(anchors: DataFrame, size: int) -> Iterator[list]:
    """The anchors in id order, ``size`` rows at a time."""
    last = None
    while True:
        left = anchors if last is None else anchors.where(F.col("vec_id") > last)
        rows = left.orderBy("vec_id").limit(size).collect()
        if rows:
            yield rows
        if len(rows) < size:
            return
        last = rows[-1]["vec_id"]


def hard_negatives(
    rows: DataFrame, is_anchor, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, block: int = BLOCK
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` has vec_id, embedding and label; ``is_anchor`` is a condition on vec_id. For each anchor and each
    of its ``positives`` best rows of the same label, the ``negatives`` best rows of other labels with
    low x positive_score <= 100 x score <= high x positive_score.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "hardneg")
    labelled_vectors(rows).write.parquet(f"{path}/rows")
    rows = spark.read.schema(VECTORS).parquet(f"{path}/rows")
    first = F.min(F.struct("vector", "label")).alias("first")
    anchors = rows.where(is_anchor).groupBy("vec_id").agg(first).select("vec_id", "first.label", "first.vector")
    anchors.write.parquet(f"{path}/anchors")
    anchors = spark.read.schema(VECTORS).parquet(f"{path}/anchors")
    rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PROBE).write.parquet(f"{path}/probe")
    probe = spark.read.schema(VECTORS).parquet(f"{path}/probe")
    spark.createDataFrame([], RESULT).write.parquet(f"{path}/found")
    for asked in blocks_of(anchors, block):
        ids, labels = (np.array([r[c] for r in asked], np.int64) for c in ("vec_id", "label"))
        vectors = [np.array(r["vector"], float) for r in asked]
        ends = [[(-np.inf, np.inf)]] * len(ids)
        near = best_rows(rows, probe, Block(ids, labels, vectors, ends, True, positives)).collect()  # positives x block
        bands: list[list[tuple[int, int]]] = [[] for _ in ids]
        pairs: list[list[tuple]] = [[] for _ in ids]
        for r in sorted(near, key=lambda r: (r.want, r.rank)):
            if low * r.score <= high * r.score:
                bands[r.want].append((low * r.score, high * r.score))
                pairs[r.want].append((int(ids[r.want]), r.vec_id, r.score))
        flat = [(n, *pair) for n, pair in enumerate(p for own in pairs for p in own)]
        if flat:
            wants = spark.createDataFrame(flat, "want long, anchor_id long, positive_id long, positive_score long")
            found = best_rows(rows, probe, Block(ids, labels, vectors, bands, False, negatives))
            found = found.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"}).join(wants, "want")
            found.select([c.split(" ")[0] for c in RESULT.split(", ")]).write.mode("append").parquet(f"{path}/found")
    return spark.read.schema(RESULT).parquet(f"{path}/found")
