"""Counterfactually regularised toxicity classifier.

A sparse logistic regression over the words of a text. Besides the labelled texts it sees, for each text
that names a group, copies in which the identity term is swapped for others; the squared change of the
linear score between a text and its copies is penalised. The weights of identity terms are drawn
together, so that a neutral mention of one group is not scored unlike the same sentence about another, and
co-occurrence with abuse is explained by the abusive words.

Fitting takes a bounded sample of labelled rows (``SAMPLE_ROWS`` a class, texts up to ``SAMPLE_CHARS``
characters) in one task; scoring reads every whole text. Null, empty and wordless texts get the score of
the intercept. Repeated words of a text count once. Without labelled rows of both classes every score is
the share of toxic ones, or 0 without any.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import text as tx
from .sample import first_ids

SAMPLE_ROWS = 4000
SAMPLE_CHARS = 20_000
BITS = 18
SPARSITY = 2e-3
FAIRNESS = 1.0
STEPS = 300
SWAPS = 3

# Words that name groups of people, in the corpus' languages. Any other list can be given.
IDENTITY_TERMS = {
    "religion": "muslim muslims christian christians jew jews jewish hindu hindus buddhist buddhists atheist atheists musulman chrétien juif muslime christen juden musulmanes cristianos judíos".split(),
    "gender": "woman women man men female male girl girls boy boys femme femmes homme hommes frau frauen mann männer mujer mujeres hombre hombres".split(),
    "orientation": "gay lesbian bisexual transgender queer straight homosexual heterosexual trans".split(),
    "origin": "black white asian african european american arab latino mexican chinese immigrant immigrants refugee refugees migrant migrants".split(),
    "ability": "disabled blind deaf elderly old young".split(),
}


def word_features(data: np.ndarray, offsets: np.ndarray):
    """Owner and feature of every distinct word of each text."""
    hashes, _, _, bounds = tx.word_hashes(data, offsets, tx.ALNUM)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    pairs = np.unique((owner.astype(np.int64) << BITS) | (hashes >> np.uint64(64 - BITS)).astype(np.int64))
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


def term_features(terms: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(terms).encode(), np.uint8)
    hashes, _, _, _ = tx.word_hashes(data, np.array([0, len(data)]), tx.ALNUM)
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def swaps(owner, feature, groups: list[np.ndarray], generator):
    """Counterfactuals: (feature out, feature in) for identity terms of the texts, a few each."""
    out, into = [], []
    for group in groups:
        held = feature[np.isin(feature, group)]
        for _ in range(SWAPS if len(group) > 1 else 0):
            other = generator.choice(group, len(held))
            out.append(held[other != held])
            into.append(other[other != held])
    return (np.concatenate(out), np.concatenate(into)) if out else (np.zeros(0, np.int64),) * 2


def fit(owner, feature, labels, groups, fairness: float = FAIRNESS, sparsity: float = SPARSITY, steps: int = STEPS):
    """Weights and intercept by accelerated proximal gradient steps."""
    n = len(labels)
    used, column = np.unique(np.concatenate([feature, *groups]), return_inverse=True)
    column = column[: len(feature)]
    taken, given = swaps(owner, feature, groups, np.random.default_rng(7))
    taken, given = np.searchsorted(used, taken), np.searchsorted(used, given)
    # Both classes weigh the same.
    weight = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum()))
    pair_weight = fairness / max(1, len(taken))
    w, b = np.zeros(len(used)), 0.0
    v, c, t = w.copy(), b, 1.0
    spread = np.bincount(column, weight[owner], len(used))
    rate = 1.0 / (0.25 * max(1.0, np.bincount(owner, minlength=n).max() * spread.max()) ** 0.5 + 4 * fairness + 0.25)
    loss_before = np.inf
    for _ in range(steps):
        score = np.bincount(owner, v[column], n) + c
        error = (1 / (1 + np.exp(-np.clip(score, -40, 40))) - labels) * weight
        gradient = np.bincount(column, error[owner], len(used))
        change = (v[taken] - v[given]) * 2 * pair_weight
        gradient += np.bincount(taken, change, len(used)) - np.bincount(given, change, len(used))
        step = v - rate * gradient
        new = np.sign(step) * np.maximum(0, np.abs(step) - rate * sparsity)
        new_b = c - rate * error.sum()
        margin = np.bincount(owner, new[column], n) + new_b
        loss = (weight * np.logaddexp(0, -np.where(labels == 1, margin, -margin))).sum()
        loss += pair_weight * ((new[taken] - new[given]) ** 2).sum() + sparsity * np.abs(new).sum()
        if loss > loss_before + 1e-12:  # restart the momentum; shorten the step if that is not enough
            if t == 1.0:
                rate /= 2
            v, c, t = w.copy(), b, 1.0
            continue
        t_next = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v, c = new + (t - 1) / t_next * (new - w), new_b + (t - 1) / t_next * (new_b - b)
        w, b, t, loss_before = new, new_b, t_next, loss
    weights = np.zeros(1 << BITS)
    weights[used] = w
    return weights, b


def train(sample: DataFrame, terms: dict[str, list[str]] = IDENTITY_TERMS, fairness: float = FAIRNESS) -> tuple[np.ndarray, float]:
    """Fit on a bounded sample (text, toxic) in one task."""
    groups = [np.unique(term_features(words)) for words in terms.values()]

    def run(batches):
        owners, features, labels, n = [], [], [], 0
        for batch in batches:
            labels.append(batch.column(1).to_numpy(zero_copy_only=False).astype(float))
            for first, stop, data, offsets in tx.slices(batch.column(0)):
                owner, feature = word_features(data, offsets)
                owners.append(owner + n)
                features.append(feature)
                n += stop - first
        labels = np.concatenate(labels or [np.zeros(0)])
        if len(set(labels.tolist())) < 2:
            share = labels.mean() if len(labels) else 0.0
            weights, intercept = np.zeros(1 << BITS), 40.0 if share == 1 else -40.0
        else:
            weights, intercept = fit(np.concatenate(owners), np.concatenate(features), labels, groups, fairness)
        out = io.BytesIO()
        np.savez_compressed(out, weights=weights, intercept=intercept)
        yield pa.RecordBatch.from_arrays([pa.array([out.getvalue()], pa.binary())], names=["model"])

    rows = sample.repartition(1).sortWithinPartitions("doc_id").select("text", F.col("toxic").cast("int"))
    blob = rows.mapInArrow(tx.frugal(run), "model binary").first()
    if blob is None:  # no labelled row at all
        return np.zeros(1 << BITS), -40.0
    model = np.load(io.BytesIO(blob[0]))
    return model["weights"], float(model["intercept"])


def score(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """(doc_id, score, predicted) of every row."""
    weights, intercept = model
    telling = np.flatnonzero(weights)
    values = weights[telling]

    def run(batches):
        full = np.zeros(1 << BITS)
        full[telling] = values
        for batch in batches:
            for first, stop, data, offsets in tx.slices(batch.column(1)):
                owner, feature = word_features(data, offsets)
                margin = np.bincount(owner, full[feature], stop - first) + intercept
                made = 1 / (1 + np.exp(-np.clip(margin, -40, 40)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, stop - first), pa.array(made), pa.array((made >= 0.5).astype(np.int32))],
                    names=["doc_id", "score", "predicted"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(tx.frugal(run), "doc_id long, score double, predicted int")


def training_rows(docs: DataFrame, labels: DataFrame, learn, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> DataFrame:
    """Bounded sample (doc_id, text, toxic) of labelled documents for which ``learn`` holds."""
    marks = labels.where("toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ids = docs.where(learn).select("doc_id", F.length("text").alias("n")).where(F.col("n") <= chars)
    known = marks.join(ids, "doc_id", "left_semi")
    picked = first_ids(known, "toxic", rows).join(marks, "doc_id")  # at most 2 x rows ids
    return docs.select("doc_id", "text").where(F.length("text") <= chars).join(F.broadcast(picked), "doc_id")
