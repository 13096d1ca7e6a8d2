"""Language-model scores from a subword lattice.

A text is a sequence of words and an end; a word is written with a leading word mark and cut into pieces
of an existing vocabulary in every possible way. Pieces follow one another independently, so the
probability of a word is the sum over all paths of its lattice, computed by the forward recursion in log
space, and the marginal probability of a text is the product over its words and its end (no piece
crosses a word mark). Characters may always be spelt in bytes, so no text has probability 0.

The vocabulary is given; only the weights of its pieces are fitted: they start from the vocabulary's own
scores and are refined by expectation-maximisation over the counts of all training words (forward-backward
on each distinct word, expected piece counts summed by Spark; only one number a piece reaches the driver).

Words of whole texts are counted over all training documents. Words with more than a ``FREQUENT`` share of
the tokens - there are at most 1 / FREQUENT of them - are sent to the tasks; all others are joined.

Words are runs of anything but U+0020 and U+0009-U+000D with A-Z lower-cased. Null and empty texts are just
an end. Rows without doc_id are scored but neither learned from nor held out; repeated rows count each time.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..session import scratch_path
from . import text as tx

MARK = "▁"
FREQUENT = 1e-6
ROUNDS = 2
SMOOTH = 0.1
CELLS = 200_000  # characters of words that are worked on at a time
LOG10 = math.log(10)


@dataclass
class Pieces:
    """Sorted piece hashes with their weights (natural logarithms); bytes and the end follow the pieces."""

    hashes: np.ndarray
    weights: np.ndarray
    longest: int

    @property
    def count(self) -> int:
        return len(self.hashes)

    @property
    def byte_weights(self) -> np.ndarray:
        return self.weights[self.count : self.count + 256]

    @property
    def end_weight(self) -> float:
        return float(self.weights[self.count + 256])


def piece_hash(points: np.ndarray) -> np.ndarray:
    """Hash of every row of code points."""
    h = np.zeros(len(points), np.uint64)
    for j in range(points.shape[1]):
        h = h * tx.MULTIPLIER + points[:, j].astype(np.uint64) + np.uint64(1)
    return h


def read_pieces(path: str) -> Pieces:
    """Pieces of a sentencepiece model. A score that is a negative rank, as in BPE models, becomes 1 / (rank + 10)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    normal = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    pieces = [model.id_to_piece(i) for i in normal]
    scores = np.array([model.get_score(i) for i in normal])
    if np.array_equal(scores, np.round(scores)):
        scores = -np.log(10.0 - scores)
    hashes = np.array([piece_hash(np.array([[ord(c) for c in p]], np.uint32))[0] for p in pieces])
    order = np.argsort(hashes)
    rare = scores.min() - 1
    weights = np.concatenate([scores[order], np.full(257, rare)])
    return Pieces(hashes[order], weights - np.logaddexp.reduce(weights), max(map(len, pieces)))


def chunks(words: list[str]):
    """(indexes, matrix of code points) of marked words of one length."""
    lengths = np.array([len(w) for w in words])
    order = np.argsort(lengths, kind="stable")
    at = 0
    while at < len(order):
        size = lengths[order[at]]
        end = min(int(np.searchsorted(lengths[order], size, "right")), at + max(1, CELLS // (size + 1)))
        rows = order[at:end]
        joined = "".join(MARK + words[r] for r in rows).encode("utf-32-le", "surrogatepass")
        yield rows, np.frombuffer(joined, np.uint32).reshape(len(rows), size + 1)
        at = end


class Lattice:
    """All edges of a block of words of one length, and the forward recursion over them."""

    def __init__(self, points: np.ndarray, pieces: Pieces):
        self.points, self.pieces = points, pieces
        n, size = points.shape
        self.size = size
        self.edges, self.scores = [], []
        h = np.zeros((n, size), np.uint64)
        for length in range(1, min(size, pieces.longest) + 1):
            h = h[:, : size - length + 1] * tx.MULTIPLIER + points[:, length - 1 :].astype(np.uint64) + np.uint64(1)
            at = np.minimum(np.searchsorted(pieces.hashes, h), pieces.count - 1)
            hit = pieces.hashes[at] == h
            self.edges.append(np.where(hit, at, -1))
            self.scores.append(np.where(hit, pieces.weights[at], -np.inf))
        self.spelt = spelling(points, pieces.byte_weights)
        self.scores[0] = np.logaddexp(self.scores[0], self.spelt)
        self.alpha = np.full((size + 1, n), -np.inf)
        self.alpha[0] = 0
        for j in range(1, size + 1):
            ways = [self.alpha[j - k] + self.scores[k - 1][:, j - k] for k in range(1, min(j, len(self.scores)) + 1)]
            self.alpha[j] = log_sum(np.stack(ways))

    @property
    def total(self) -> np.ndarray:
        return self.alpha[-1]

    def expected(self, counts: np.ndarray) -> np.ndarray:
        """Expected uses of every piece and byte when word i occurs ``counts[i]`` times."""
        size = self.size
        beta = np.full((size + 1, len(counts)), -np.inf)
        beta[size] = 0
        for i in range(size - 1, -1, -1):
            ways = [beta[i + k] + self.scores[k - 1][:, i] for k in range(1, min(size - i, len(self.scores)) + 1)]
            beta[i] = log_sum(np.stack(ways))
        uses = np.zeros(len(self.pieces.weights))
        for k, (edges, scores) in enumerate(zip(self.edges, self.scores), 1):
            flow = np.exp(self.alpha[: size - k + 1].T + scores + beta[k:].T - self.total[:, None]) * counts[:, None]
            if k == 1:  # one character: by its own piece or spelt in bytes
                share = np.exp(self.spelt - scores)
                self._spell(uses, flow * share)
                flow = flow * (1 - share)
            used = edges >= 0
            uses += np.bincount(edges[used], flow[used], len(uses))
        return uses

    def _spell(self, uses: np.ndarray, flow: np.ndarray) -> None:
        points, inverse = np.unique(self.points, return_inverse=True)
        for point, weight in zip(points.tolist(), np.bincount(inverse.ravel(), flow.ravel())):
            for byte in chr(point).encode("utf-8", "surrogatepass"):
                uses[self.pieces.count + byte] += weight


def log_sum(values: np.ndarray) -> np.ndarray:
    """Logarithm of the sum of exponentials over the first axis; every column has a finite entry."""
    most = values.max(axis=0)
    return most + np.log(np.exp(values - most).sum(axis=0))


def spelling(points: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weight of each character written in its UTF-8 bytes."""
    unique, inverse = np.unique(points, return_inverse=True)
    own = np.array([weights[list(chr(p).encode("utf-8", "surrogatepass"))].sum() for p in unique.tolist()])
    return own[inverse].reshape(points.shape)


def word_scores(words: list[str], pieces: Pieces) -> np.ndarray:
    """Natural log of the marginal probability of each word."""
    out = np.zeros(len(words))
    for rows, points in chunks(words):
        out[rows] = Lattice(points, pieces).total
    return out


def count_words(docs: DataFrame) -> DataFrame:
    """(hash, word, c): every word of every text, with its count in rows where ``learn`` holds."""

    def run(batches):
        for batch in batches:
            learn = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for first, stop, data, offsets in tx.slices(batch.column(0), 4 << 20):
                hashes, starts, ends, bounds = tx.word_hashes(data, offsets, tx.NOT_BLANK)
                own = np.repeat(learn[first:stop], np.diff(bounds))
                unique, where, inverse = np.unique(hashes, return_index=True, return_inverse=True)
                counts = np.bincount(inverse, own, len(unique)).astype(np.int64)
                low = tx.LOWER[data]
                lengths = ends[where] - starts[where]
                text = low[tx.ragged(starts[where], lengths)]
                edges = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                words = pa.StringArray.from_buffers(len(unique), pa.py_buffer(edges), pa.py_buffer(text.tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(unique.view(np.int64)), words, pa.array(counts)], names=["hash", "word", "c"])

    rows = docs.select("text", "learn").mapInArrow(run, "hash long, word string, c long")
    return rows.groupBy("hash", "word").agg(F.sum("c").alias("c"))


def fit(words: DataFrame, pieces: Pieces, ends: int, rounds: int = ROUNDS) -> Pieces:
    """Refine piece weights on the counted words (word, c) and the number of training texts."""
    for _ in range(rounds):

        def run(batches, pieces=pieces):
            uses = np.zeros(len(pieces.weights))
            for batch in batches:
                found, counts = batch.column(0).to_pylist(), batch.column(1).to_numpy()
                for rows, points in chunks(found):
                    uses += Lattice(points, pieces).expected(counts[rows])
            used = np.flatnonzero(uses)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(uses[used])], names=["piece", "uses"])

        known = words.where("c > 0").select("word", "c").mapInArrow(run, "piece long, uses double")
        found = known.groupBy("piece").agg(F.sum("uses").alias("uses")).toArrow()  # a row for each piece
        uses = np.full(len(pieces.weights), SMOOTH)
        uses[found["piece"].to_numpy()] += found["uses"].to_numpy()
        uses[-1] += ends
        pieces = Pieces(pieces.hashes, np.log(uses) - np.log(uses.sum()), pieces.longest)
    return pieces


def score(docs: DataFrame, pieces: Pieces, learn, rounds: int = ROUNDS, frequent: float = FREQUENT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_tokens, n_known, train_tokens, base_score and score.

    ``learn`` is a condition on docs that marks training rows; null counts as false. ``base_score`` is the word
    unigram with half counts, ``score`` the log10 marginal probability over all segmentations.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "lattice")
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.coalesce(learn, F.lit(False)).alias("learn"))
    count_words(rows).write.parquet(f"{path}/words")
    words = spark.read.parquet(f"{path}/words")
    ends = rows.where("learn").count()
    tokens, kinds = words.where("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    tokens, kinds = tokens + ends, kinds + (ends > 0)
    floor = tokens + 0.5 * (kinds + 1)
    pieces = fit(words, pieces, ends, rounds)

    def weigh(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 20_000):
                part = batch.slice(at, 20_000)
                counts = part.column(2).to_numpy()
                base = np.log10((counts + 0.5) / floor)
                made = word_scores(part.column(1).to_pylist(), pieces) / LOG10
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(base), pa.array(made)], names=["hash", "c", "base", "lattice"]
                )

    words.select("hash", "word", "c").mapInArrow(weigh, "hash long, c long, base double, lattice double").write.parquet(f"{path}/weights")
    weights = spark.read.parquet(f"{path}/weights")
    often = F.col("c") >= max(1.0, frequent * tokens)
    table = weights.where(often).toArrow()  # at most 1 / frequent rows
    order = np.argsort(table["hash"].to_numpy().view(np.uint64))
    heavy = spark.sparkContext.broadcast(
        (table["hash"].to_numpy().view(np.uint64)[order], table["base"].to_numpy()[order], table["lattice"].to_numpy()[order])
    )
    end_base, end_score = math.log10((ends + 0.5) / floor), pieces.end_weight / LOG10

    def measure(batches):
        known, base, lattice = heavy.value
        row_key = TaskContext.get().partitionId() << 40
        for batch in batches:
            for first, stop, data, offsets in tx.slices(batch.column(1)):
                n = stop - first
                hashes, _, _, bounds = tx.word_hashes(data, offsets, tx.NOT_BLANK)
                lengths = np.diff(bounds)
                owner = np.repeat(np.arange(n), lengths)
                if len(known):
                    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                    hit = known[at] == hashes
                else:
                    at, hit = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
                sums = [np.bincount(owner[hit], v[at[hit]] if len(known) else None, n) for v in (base, lattice)]
                keys = row_key + np.arange(n)
                row_key += n
                # The other words, counted inside each text, wait for their weights.
                order = np.lexsort((hashes[~hit], owner[~hit]))
                rare, whose = hashes[~hit][order], owner[~hit][order]
                fresh = np.ones(len(rare), bool)
                fresh[1:] = (rare[1:] != rare[:-1]) | (whose[1:] != whose[:-1])
                begin = np.flatnonzero(fresh)
                times = np.diff(np.append(begin, len(rare)))
                none, blank = len(begin), pa.nulls
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([keys, keys[whose[begin]]])),
                        pa.concat_arrays([batch.column(0).slice(first, n), blank(none, pa.int64())]),
                        pa.concat_arrays([pa.array(lengths.astype(np.int64) + 1), blank(none, pa.int64())]),
                        pa.concat_arrays([pa.array(np.bincount(owner[hit], minlength=n) + int(ends > 0)), blank(none, pa.int64())]),
                        pa.concat_arrays([pa.array(sums[0] + end_base), blank(none, pa.float64())]),
                        pa.concat_arrays([pa.array(sums[1] + end_score), blank(none, pa.float64())]),
                        pa.concat_arrays([blank(n, pa.int64()), pa.array(rare[begin].view(np.int64))]),
                        pa.concat_arrays([blank(n, pa.int64()), pa.array(times.astype(np.int64))]),
                    ],
                    names=["row", "doc_id", "n_tokens", "n_known", "base_score", "score", "hash", "times"],
                )

    schema = "row long, doc_id long, n_tokens long, n_known long, base_score double, score double, hash long, times long"
    rows.select("doc_id", "text").mapInArrow(measure, schema).write.parquet(f"{path}/measured")
    measured = spark.read.parquet(f"{path}/measured")
    names = ["row", "doc_id", "n_tokens", "n_known", "base_score", "score"]
    null = F.lit(None).cast("long")
    rare = measured.where("hash is not null").join(weights.where(~often), "hash").select(
        "row", null.alias("doc_id"), null.alias("n_tokens"), F.when(F.col("c") > 0, F.col("times")).otherwise(F.lit(0)).alias("n_known"),
        (F.col("times") * F.col("base")).alias("base_score"), (F.col("times") * F.col("lattice")).alias("score"),
    )
    both = measured.where("hash is null").select(*names).unionByName(rare)
    return both.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"),
        F.sum("base_score").alias("base_score"), F.sum("score").alias("score"),
    ).select("doc_id", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")
