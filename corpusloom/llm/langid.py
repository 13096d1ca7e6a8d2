"""Language identification of words with a linear-chain conditional random field.

Each word gets a score per language from its character n-grams, prefixes, suffixes and itself (a lexicon of
words), and neighbouring words are tied by learned transitions, so that code-switched texts are labelled
word by word. Forward-backward gives the marginal of every word; a text's language is the one with the
largest sum of marginals, and its score the share of that sum.

Fitting takes a bounded sample of labelled rows (``SAMPLE_ROWS`` a language, texts up to ``SAMPLE_CHARS``
characters) in one task. Sampled texts are spliced at random places to code-switched sequences, so the
transitions are learned from data that switches. Labelling reads every whole text as one chain; texts of a
slice move in step, so the cost of Python follows the longest text of a slice.

Words are runs of ASCII letters and of characters from U+0080. A run of more than ``LONGEST`` characters (as in
scripts without spaces) is cut into several words, in fitting and labelling alike, so every character is scored
and a run may hold several languages. Null texts, empty texts and texts without any
letter get ``und`` and score 0; so does every text if no training row is labelled. Repeated rows and ties
(the language first in order wins) are treated like any other.
"""

from __future__ import annotations

import io
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from . import text as tx
from .sample import labelled_sample

SAMPLE_ROWS = 150
SAMPLE_CHARS = 8000
BITS = 17
STEPS = 40
LENGTH = 64  # words of a training sequence
RATE = 0.2
RIDGE = 1e-4
SLICE = 4 << 20
CACHE = 300_000
LONGEST = 32  # characters of a chain element; a longer run becomes several of nearly equal length
UNKNOWN = "und"

LETTERS = np.zeros(256, bool)
LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def split_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of all words; whole characters stay together."""
    starts, ends = tx.split_words(data, offsets, LETTERS)
    if not (ends - starts > LONGEST).any():
        return starts, ends
    first = (data & 0xC0) != 0x80  # first bytes of characters
    at = np.concatenate([np.flatnonzero(first), [len(data)]])
    before = np.concatenate([[0], np.cumsum(first)])
    begin, size = before[starts], before[ends] - before[starts]
    parts = np.maximum(1, -(-size // LONGEST))
    order = tx.ragged(np.zeros(len(parts), np.int64), parts)
    begin, size, count = (np.repeat(x, parts) for x in (begin, size, parts))
    inner = order > 0
    cuts = at[begin[inner] + order[inner] * size[inner] // count[inner]]
    starts, ends = np.repeat(starts, parts), np.repeat(ends, parts)
    starts[inner] = cuts
    ends[np.flatnonzero(inner) - 1] = cuts
    return starts, ends


def features(points: np.ndarray) -> np.ndarray:
    """Features of words of one length: a row of bucket numbers for each row of code points."""
    n, size = points.shape
    framed = np.concatenate([np.full((n, 1), 2), points, np.full((n, 1), 3)], axis=1).astype(np.uint64)
    found = []

    def add(values: np.ndarray, kind: int) -> None:
        found.append(tx.mix(values.reshape(n, -1) + np.uint64(kind * int(tx.MULTIPLIER) % (1 << 64))) >> np.uint64(64 - BITS))

    rolled = np.zeros_like(framed)
    for length in range(1, min(4, size + 2) + 1):
        rolled = rolled[:, : size + 3 - length] * tx.MULTIPLIER + framed[:, length - 1 :]
        if length < 4:
            add(rolled, length)  # n-grams
        add(rolled[:, 0], 10 + length)  # prefix
        add(rolled[:, -1], 20 + length)  # suffix
    whole = np.zeros(n, np.uint64)
    for j in range(size + 2):
        whole = whole * tx.MULTIPLIER + framed[:, j]
    add(whole, 30)  # the word itself
    return np.concatenate(found, axis=1).astype(np.int64)


def by_length(words: list[str]):
    """(indexes, features) of words of one length."""
    lengths = np.array([len(w) for w in words], np.int64)
    for size in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == size)
        for at in range(0, len(rows), 20_000):
            part = rows[at : at + 20_000]
            points = np.frombuffer("".join(words[r] for r in part).encode("utf-32-le"), np.uint32).reshape(len(part), size)
            yield part, features(points)


@dataclass
class Crf:
    languages: list[str]
    weights: np.ndarray  # features x languages
    transitions: np.ndarray  # logarithmic, from x to

    def emissions(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(self.languages)), np.float32)
        for rows, found in by_length(words):
            total = out[rows]
            for j in range(found.shape[1]):
                total += self.weights[found[:, j]]
            out[rows] = total
        return out

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez_compressed(out, languages=np.array(self.languages), weights=self.weights, transitions=self.transitions)
        return out.getvalue()

    @staticmethod
    def from_bytes(blob: bytes) -> Crf:
        model = np.load(io.BytesIO(blob))
        return Crf(model["languages"].tolist(), model["weights"], model["transitions"])


NO_MODEL = Crf([], np.zeros((1, 0), np.float32), np.zeros((0, 0)))


def forward_backward(potentials: np.ndarray, transitions: np.ndarray, starts: np.ndarray, lengths: np.ndarray, expect: bool = True):
    """Marginals of all words of chains that lie one after another, and the expected transitions if asked for.

    ``potentials`` are exponentials of emission scores. Chains move in step, longest first. The results have the
    type of the potentials; marginals are written over the forward values, so two tables are held.
    """
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    steps = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(steps), "left")  # chains longer than t
    matrix = np.exp(transitions - transitions.max(initial=0)).astype(potentials.dtype)
    alpha = np.empty_like(potentials)
    for t in range(steps):
        at = starts[: active[t]] + t
        now = potentials[at] if t == 0 else (alpha[at - 1] @ matrix) * potentials[at]
        alpha[at] = now / now.sum(axis=1, keepdims=True)
    expected = np.zeros_like(matrix)
    ahead = np.zeros((0, potentials.shape[1]), potentials.dtype)  # of the chains longer than t + 1
    for t in range(steps - 1, -1, -1):
        at = starts[: active[t]] + t
        beta = np.ones((len(at), potentials.shape[1]), potentials.dtype)
        if len(ahead):
            back = ahead @ matrix.T
            if expect:
                on = alpha[at[: len(ahead)]]
                expected += (on / (on * back).sum(axis=1, keepdims=True)).T @ ahead * matrix
            beta[: len(ahead)] = back / back.sum(axis=1, keepdims=True)
        ahead = potentials[at] * beta
        marginal = alpha[at] * beta
        alpha[at] = marginal / marginal.sum(axis=1, keepdims=True)
    return alpha, expected


def potentials_of(emissions: np.ndarray) -> np.ndarray:
    return np.exp(np.clip(emissions - emissions.max(axis=1, keepdims=True), -30, 0)).astype(np.float64)


def words_in(text: str) -> list[str]:
    """Lower-cased words of a training text that hold a letter."""
    data = np.frombuffer(text.encode(), np.uint8)
    starts, ends = split_runs(data, np.array([0, len(data)]))
    raw = data.tobytes()
    words = (raw[a:b].decode().lower() for a, b in zip(starts.tolist(), ends.tolist()))
    return [w for w in words if any(map(str.isalpha, w))]


def spliced(texts: list[list[int]], labels: list[int], generator) -> tuple[np.ndarray, np.ndarray]:
    """Training sequences of ``LENGTH`` words: pieces of texts in random order, languages switching."""
    pieces = []
    for words, label in zip(texts, labels):
        at = 0
        while at < len(words):
            size = int(generator.integers(6, LENGTH))
            pieces.append((words[at : at + size], label))
            at += size
    order = generator.permutation(len(pieces))
    words = np.concatenate([pieces[i][0] for i in order]).astype(np.int64)
    marks = np.concatenate([np.full(len(pieces[i][0]), pieces[i][1]) for i in order])
    n = max(1, len(words) // LENGTH) * LENGTH if len(words) >= LENGTH else len(words)
    return words[:n], marks[:n]


def fit(texts: list[str], labels: list[str], steps: int = STEPS) -> Crf:
    """Maximum likelihood with a small ridge, by full-batch Adam steps."""
    languages = sorted(set(labels))
    size = len(languages)
    known: dict[str, int] = {}
    coded = [[known.setdefault(w, len(known)) for w in words_in(t)] for t in texts]
    kept = [(c, languages.index(x)) for c, x in zip(coded, labels) if c]
    crf = Crf(languages, np.zeros((1 << BITS, size), np.float32), np.zeros((size, size)))
    if not kept or size < 2:
        return crf
    generator = np.random.default_rng(3)
    words, marks = spliced([k[0] for k in kept], [k[1] for k in kept], generator)
    starts = np.arange(0, len(words), LENGTH)
    lengths = np.minimum(LENGTH, len(words) - starts)
    # Every language weighs the same.
    weight = (len(marks) / size / np.maximum(1, np.bincount(marks, minlength=size)))[marks]
    vocabulary = list(known)
    owner, feature = [], []
    for rows, found in by_length(vocabulary):
        owner.append(np.repeat(rows, found.shape[1]))
        feature.append(found.ravel())
    owner, feature = np.concatenate(owner), np.concatenate(feature)
    used, column = np.unique(feature, return_inverse=True)
    inside = (np.arange(len(words)) % LENGTH) > 0
    seen = np.zeros((size, size))
    np.add.at(seen, (marks[:-1][inside[1:]], marks[1:][inside[1:]]), 1)
    w, v = np.zeros((len(used), size)), np.zeros((size, size))
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(v), np.zeros_like(v)]
    truth = np.zeros((len(words), size))
    truth[np.arange(len(words)), marks] = 1
    for step in range(1, steps + 1):
        scores = np.stack([np.bincount(owner, w[column, k], len(vocabulary)) for k in range(size)], axis=1)
        marginal, expected = forward_backward(potentials_of(scores[words]), v, starts, lengths)
        error = (marginal - truth) * weight[:, None] / len(words)
        per_word = np.stack([np.bincount(words, error[:, k], len(vocabulary)) for k in range(size)], axis=1)
        gradient = np.stack([np.bincount(column, per_word[owner, k], len(used)) for k in range(size)], axis=1) + RIDGE * w / size
        moves = (gradient, (expected - seen) / len(words))
        for i, (target, move) in enumerate(zip((w, v), moves)):
            first, second = moments[2 * i], moments[2 * i + 1]
            first += 0.1 * (move - first)
            second += 0.01 * (move**2 - second)
            target -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    crf.weights[used] = w
    crf.transitions[:] = v
    return crf


def train(docs: DataFrame, learn, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> Crf:
    """Fit on texts and non-null ``lang`` of a bounded sample of the rows of ``docs`` where ``learn`` holds."""
    known = docs.where(learn).where("lang is not null").select("doc_id", "text", "lang")
    sample = labelled_sample(known, "lang", rows, chars)

    def run(batches):
        texts, labels = [], []
        for batch in batches:
            texts += batch.column(0).to_pylist()
            labels += batch.column(1).to_pylist()
        if not texts:
            return
        yield pa.RecordBatch.from_arrays([pa.array([fit(texts, labels).to_bytes()], pa.binary())], names=["model"])

    together = sample.repartition(1).sortWithinPartitions("doc_id", "text").select("text", "lang")
    blob = together.mapInArrow(tx.frugal(run), "model binary").first()
    return Crf.from_bytes(blob[0]) if blob else NO_MODEL


class Labeller:
    """Emission potentials of words by hash, kept from slice to slice."""

    def __init__(self, crf: Crf):
        self.crf = crf
        self._reset()

    def _reset(self) -> None:
        self.known: dict[int, int] = {}
        self.table = np.zeros((0, len(self.crf.languages)), np.float32)
        self.letters = np.zeros(0)

    def entries(self, hashes, starts, ends, data) -> np.ndarray:
        unique, where, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > CACHE:
            self._reset()
        listed = unique.tolist()
        new = [i for i, h in enumerate(listed) if h not in self.known]
        if new:
            raw = data.tobytes()
            words = [raw[starts[where[i]] : ends[where[i]]].decode("utf-8", "replace").lower() for i in new]
            letters = np.array([sum(map(str.isalpha, w)) for w in words], float)
            made = potentials_of(self.crf.emissions(words)).astype(np.float32)
            made[letters == 0] = 1.0  # symbols say nothing
            first = len(self.table)
            self.known.update((listed[i], first + n) for n, i in enumerate(new))
            self.table = np.concatenate([self.table, made])
            self.letters = np.concatenate([self.letters, letters])
        return np.fromiter(map(self.known.__getitem__, listed), np.int64, len(listed))[inverse]

    def votes(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Marginals of all words, their numbers of letters, and each text's bounds in them."""
        starts, ends = split_runs(data, offsets)
        entry = self.entries(tx.span_hashes(tx.LOWER[data], starts, ends), starts, ends, data)
        bounds = np.searchsorted(starts, offsets)
        lengths = np.diff(bounds)
        full = lengths > 0
        marginal, _ = forward_backward(self.table[entry], self.crf.transitions, bounds[:-1][full], lengths[full], expect=False)
        return marginal, self.letters[entry], bounds


def label_words(docs: DataFrame, crf: Crf) -> DataFrame:
    """(doc_id, words): for every text its words with their language and the probability of it."""
    schema = "doc_id long, words array<struct<word:string,lang:string,probability:double>>"

    def run(batches):
        labeller = Labeller(crf)
        for batch in batches:
            for first, stop, data, offsets in tx.slices(batch.column(1)):
                marginal, letters, bounds = labeller.votes(data, offsets)
                starts, ends = split_runs(data, offsets)
                raw, best = data.tobytes(), marginal.argmax(axis=1)
                words = [
                    {"word": raw[a:b].decode(), "lang": crf.languages[k] if n else UNKNOWN, "probability": float(p) if n else 0.0}
                    for a, b, k, p, n in zip(starts.tolist(), ends.tolist(), best.tolist(), marginal.max(axis=1).tolist(), letters.tolist())
                ]
                lists = [words[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
                kind = pa.list_(pa.struct([("word", pa.string()), ("lang", pa.string()), ("probability", pa.float64())]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, stop - first), pa.array(lists, kind)], names=["doc_id", "words"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tx.frugal(run), schema)


def predict(docs: DataFrame, crf: Crf, lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language of each text and its score, which replace columns of those names."""
    docs = docs.drop(lang, score)
    keep = docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())])
    at = keep.index("text")

    def run(batches):
        labeller = Labeller(crf)
        names = [*crf.languages, UNKNOWN]
        for batch in batches:
            for first, stop, data, offsets in tx.slices(batch.column(at), SLICE):
                n = stop - first
                if crf.languages:
                    marginal, letters, bounds = labeller.votes(data, offsets)
                    owner = np.repeat(np.arange(n), np.diff(bounds))
                    sums = np.stack([np.bincount(owner, m * letters, n) for m in marginal.T], axis=1)
                    total = sums.sum(axis=1)
                    best = np.where(total > 0, sums.argmax(axis=1), len(crf.languages))
                    share = np.where(total > 0, sums.max(axis=1) / np.where(total > 0, total, 1), 0.0)
                else:
                    best, share = np.zeros(n, np.int64), np.zeros(n)
                new = {lang: pa.array([names[k] for k in best.tolist()]), score: pa.array(np.clip(share, 0, 1))}
                yield tx.with_columns(batch.slice(first, n), keep, new)

    return docs.mapInArrow(tx.frugal(run), schema)
