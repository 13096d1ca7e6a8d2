"""What a task does for buckets of sets: bounds of the overlap of two sets, and the turns of a whole bucket.

A set is sketched by a bitmap of at least two bits for each element. A bit that one set has and the other has not stands for an element
that both do not share, so two bitmaps bound the overlap from above and pairs below the threshold need no elements.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes that the bitmaps of pairs take at once.
AT_ONCE = 8 << 20
# Sets that are sketched at once.
SKETCHED_ROWS = 512
# Most members that stand for election at once.
MOST_LEADERS = 256


def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, feature) to (id, n, bits): sizes and bitmaps of the sets; a null counts as empty."""
    for batch in (b.slice(at, SKETCHED_ROWS) for b in batches for at in range(0, b.num_rows, SKETCHED_ROWS)):
        ids, feature = batch.column(0), batch.column(1)
        sizes = pc.fill_null(pc.list_value_length(feature), 0).to_numpy().astype(np.int64)
        width = np.maximum(64, 1 << np.ceil(np.log2(np.maximum(2 * sizes, 1))).astype(np.int64))
        ends = np.cumsum(width)
        marks = np.zeros(ends[-1], bool)
        values = feature.flatten().to_numpy(zero_copy_only=False)
        marks[np.repeat(ends - width, sizes) + (values & np.repeat(width - 1, sizes))] = True
        offsets = np.concatenate([[0], ends // 8]).astype(np.int32)
        bits = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.packbits(marks, bitorder="little"))])
        yield pa.RecordBatch.from_arrays([ids, pa.array(sizes.astype(np.int32)), bits], names=["id", "n", "bits"])


def _lengths(bits: pa.Array) -> np.ndarray:
    return pc.binary_length(bits).to_numpy(zero_copy_only=False).astype(np.int64)


def _words(bits: pa.Array, rows: np.ndarray, length: int) -> np.ndarray:
    """Bitmaps of rows that have the same length, as a matrix of 64-bit words."""
    offsets = np.frombuffer(bits.buffers()[1], np.int32)[bits.offset : bits.offset + len(bits) + 1]
    data = np.frombuffer(bits.buffers()[2], np.uint8)
    return data[offsets[rows][:, None] + np.arange(length)].view(np.uint64)


def _folded(words: np.ndarray, length: int) -> np.ndarray:
    """Bitmaps as they would be with fewer bits; lengths are powers of two."""
    return np.bitwise_or.reduce(words.reshape(len(words), -1, length // 8), axis=1)


def _reach(n_a: np.ndarray, only_a: np.ndarray, n_b: np.ndarray, only_b: np.ndarray, threshold: float) -> np.ndarray:
    """Whether sets may reach a Jaccard similarity, by their sizes and how many elements at least each does not share."""
    both = np.minimum(n_a - only_a, n_b - only_b)
    return both >= threshold * (n_a + n_b - both) - 1e-6


def possible(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """(low, high) of the pairs (low, high, n_low, bits_low, n_high, bits_high) that may reach the threshold."""
    for batch in batches:
        if not batch.num_rows:
            continue
        n = [batch.column(c).to_numpy().astype(np.int64) for c in (2, 4)]
        bits = [batch.column(c) for c in (3, 5)]
        lengths = [_lengths(b) for b in bits]
        keep = np.zeros(batch.num_rows, bool)
        for a, b in {*zip(*(x.tolist() for x in lengths), strict=True)}:
            rows, least = np.flatnonzero((lengths[0] == a) & (lengths[1] == b)), min(a, b)
            step = max(1, AT_ONCE // max(a, b))
            for some in (rows[at : at + step] for at in range(0, len(rows), step)):
                x, y = _folded(_words(bits[0], some, a), least), _folded(_words(bits[1], some, b), least)
                shared = np.bitwise_count(x & y).sum(axis=1, dtype=np.int64)
                only = [np.bitwise_count(z).sum(axis=1, dtype=np.int64) - shared for z in (x, y)]
                keep[some] = _reach(n[0][some], only[0], n[1][some], only[1], threshold)
        yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep)) for c in batch.columns[:2]], names=["low", "high"])


def flagged(table: pa.Table, threshold: float) -> pa.Table:
    """(bucket, id) of the members of one bucket (bucket, id, queued, n, bits) that may match one that is not queued."""
    table = table.combine_chunks().sort_by("n")
    bits = table["bits"].combine_chunks()
    bits = bits.chunk(0) if isinstance(bits, pa.ChunkedArray) else bits
    n, queued = table["n"].to_numpy().astype(np.int64), table["queued"].to_numpy()
    _, member = np.unique(pc.rank(table["id"], tiebreaker="dense").to_numpy(), return_inverse=True)
    lengths, found = _lengths(bits), np.zeros(len(n), bool)
    for length in np.unique(lengths).tolist():
        own = np.flatnonzero(lengths == length)
        # Sets grow with their bitmaps, so what a set may match stands at its own place or after it.
        others = np.arange(own[0], np.searchsorted(n, n[own[-1]] / threshold + 1e-6, side="right"))
        words = np.concatenate([
            _folded(_words(bits, others[lengths[others] == wide], wide), length) for wide in np.unique(lengths[others]).tolist()
        ])
        ones = np.bitwise_count(words).sum(axis=1, dtype=np.int64)
        at = 0
        while at < len(own):
            end = np.searchsorted(n[others], n[own[at]] / threshold + 1e-6, side="right")
            step = max(1, AT_ONCE // max(1, (end - at) * length))
            x = slice(at, min(at + step, len(own)))
            y = slice(at, max(x.stop, np.searchsorted(n[others], n[own[x.stop - 1]] / threshold + 1e-6, side="right")))
            shared = np.bitwise_count(words[x, None] & words[None, y]).sum(axis=2, dtype=np.int64)
            near = _reach(n[others[x]][:, None], ones[x, None] - shared, n[others[y]], ones[y] - shared, threshold)
            near &= (member[others[x]][:, None] != member[others[y]]) & ~(queued[others[x]][:, None] & queued[others[y]])
            found[others[x]] |= near.any(axis=1)
            found[others[y]] |= near.any(axis=0)
            at = x.stop
    chosen = table.filter(pa.array(found)).select(["bucket", "id"])
    return chosen.group_by(["bucket", "id"]).aggregate([]).select(["bucket", "id"])


class _Sets:
    """Sets of the members of a bucket, found by their elements; a member may have several sets or none."""

    def __init__(self, member: np.ndarray, feature: pa.Array, members: int):
        self.member, self.members = member, members
        self.n = pc.fill_null(pc.list_value_length(feature), 0).to_numpy().astype(np.int64)
        self.ends = np.concatenate([[0], np.cumsum(self.n)])
        _, self.code, counts = np.unique(feature.flatten().to_numpy(zero_copy_only=False), return_inverse=True, return_counts=True)
        self.starts = np.concatenate([[0], np.cumsum(counts)])
        self.holder = np.repeat(np.arange(len(self.n)), self.n)[np.argsort(self.code, kind="stable")]
        self.of = [[] for _ in range(members)]
        for at in np.flatnonzero(self.n).tolist():
            self.of[member[at]].append(at)

    def scores(self, asker: int) -> Iterator[np.ndarray]:
        """Jaccard similarity of each set of a member to all sets."""
        for at in self.of[asker]:
            code = self.code[self.ends[at] : self.ends[at + 1]]
            first, count = self.starts[code], self.starts[code + 1] - self.starts[code]
            places = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
            both = np.bincount(self.holder[places], minlength=len(self.n))
            yield both / np.maximum(self.n[at] + self.n - both, 1)

    def matches(self, asker: int, asked: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """Members among those asked (a mask) that match, and their scores."""
        members, scores = [np.empty(0, np.int64)], [np.empty(0)]
        for score in self.scores(asker):
            hit = np.flatnonzero((score >= threshold) & asked[self.member])
            hit = hit[self.member[hit] != asker]
            members.append(self.member[hit])
            scores.append(score[hit])
        return np.concatenate(members), np.concatenate(scores)


def settled(table: pa.Table, threshold: float, small: int, standing: int) -> pa.Table:
    """(id, candidate_of, score): all turns of one bucket, as ``linked_candidates`` takes them, from where it stands.

    ``table``: id, mark (hash of the id), queued, width, leaders, feature; a member without a feature matches nobody.
    """
    table = table.combine_chunks().sort_by("id")
    ids = table["id"].combine_chunks().dictionary_encode()
    ids = ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids
    member = ids.indices.to_numpy().astype(np.int64)
    size = len(ids.dictionary)
    at = np.unique(member, return_index=True)[1]
    queued, mark = table["queued"].to_numpy()[at].copy(), table["mark"].to_numpy()[at]
    width, leaders = table["width"][0].as_py(), table["leaders"][0].as_py()
    feature = table["feature"].combine_chunks()
    sets = _Sets(member, feature.chunk(0) if isinstance(feature, pa.ChunkedArray) else feature, size)
    here, links = np.ones(size, bool), [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]

    def note(asker: int, found: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        links.append((np.maximum(found[0], asker), np.minimum(found[0], asker), found[1]))
        return found[0]

    while (here & ~queued).any() and here.sum() > 1:
        asked, waiting = here & ~queued, np.flatnonzero(here & queued)
        if here.sum() <= small:
            for asker in np.flatnonzero(here).tolist():
                note(asker, sets.matches(asker, asked if queued[asker] else asked & (np.arange(size) > asker), threshold))
            break
        if not len(waiting):
            stands = np.flatnonzero(asked)[: min(standing, leaders)].tolist()
            found = {asker: match for asker in stands if len((match := sets.matches(asker, asked, threshold))[0])}
            here[[asker for asker in stands if asker not in found]] = False
            if found:
                leader = min(found)
                here[leader] = False
                queued[note(leader, found[leader])] = True
            width, leaders = 1, max(leaders // 2, 1) if found else min(leaders * 4, MOST_LEADERS)
        else:
            asks = waiting[(waiting == waiting[0]) | (mark[waiting] % len(waiting) < width)]
            # The fewer ones look for the others.
            if asked.sum() < len(asks):
                answers = np.zeros(size, bool)
                answers[asks] = True
                for other in np.flatnonzero(asked).tolist():
                    queued[other] = len(note(other, sets.matches(other, answers, threshold))) > 0
            else:
                for asker in asks.tolist():
                    queued[note(asker, sets.matches(asker, asked, threshold))] = True
            here[asks] = False
            width *= 4
        standing = min(standing * 4, MOST_LEADERS)
    high, low, score = (np.concatenate(x) for x in zip(*links, strict=True))
    return pa.table({"id": ids.dictionary.take(pa.array(high)), "candidate_of": ids.dictionary.take(pa.array(low)), "score": pa.array(score)})
