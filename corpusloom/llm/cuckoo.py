"""Cuckoo filter over 128-bit keys, vectorised: four 16-bit fingerprints in a bucket.

A filter is a list of segments. Keys that a full segment cannot take open the next one, so
nothing is ever refused and a key that was inserted is always found.
"""

from __future__ import annotations

import numpy as np

from .text import mix

SLOTS = 4
ROUNDS = 200


def fingerprints(high: np.ndarray) -> np.ndarray:
    mark = (mix(high.view(np.uint64)) & np.uint64(0xFFFF)).astype(np.uint16)
    mark[mark == 0] = 1
    return mark


def partner(bucket: np.ndarray, mark: np.ndarray, size: int) -> np.ndarray:
    """The other bucket of a fingerprint; applying it twice gives the first one back."""
    return bucket ^ (mix(mark.astype(np.uint64)).astype(np.int64) & (size - 1))


def ranks(sorted_values: np.ndarray) -> np.ndarray:
    """Position of every entry inside its run of equal values."""
    at = np.arange(len(sorted_values))
    fresh = np.ones(len(at), bool)
    fresh[1:] = sorted_values[1:] != sorted_values[:-1]
    return at - np.maximum.accumulate(np.where(fresh, at, 0))


class CuckooFilter:
    def __init__(self, segments: list[np.ndarray] | None = None):
        self.segments = segments or []

    @staticmethod
    def from_bytes(blob: bytes | None) -> CuckooFilter:
        segments, at = [], 0
        while blob and at < len(blob):
            size = int.from_bytes(blob[at : at + 8], "little")
            end = at + 8 + size * SLOTS * 2
            segments.append(np.frombuffer(blob[at + 8 : end], np.uint16).reshape(size, SLOTS).copy())
            at = end
        return CuckooFilter(segments)

    def to_bytes(self) -> bytes:
        return b"".join(len(t).to_bytes(8, "little") + t.tobytes() for t in self.segments)

    def contains(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        mark = fingerprints(high)
        found = np.zeros(len(low), bool)
        for table in self.segments:
            first = low & (len(table) - 1)
            second = partner(first, mark, len(table))
            found |= (table[first] == mark[:, None]).any(1) | (table[second] == mark[:, None]).any(1)
        return found

    def _open(self, keys: int) -> None:
        self.segments.append(np.zeros((1 << max(4, int(np.ceil(np.log2(keys / (SLOTS * 0.85))))), SLOTS), np.uint16))

    def insert(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Add keys, each of which must be new; returns the segment that holds each."""
        where = np.zeros(len(low), np.int32)
        at = 0
        while at < len(low):
            room = int(self.segments[-1].size * 0.9) - int((self.segments[-1] != 0).sum()) if self.segments else 0
            end = at + max(room, 0)
            if end > at and self._place(self.segments[-1], low[at:end], high[at:end]):
                where[at:end] = len(self.segments) - 1
                at = end
            else:
                self._open(len(low) - at)
        return where

    def _place(self, table: np.ndarray, low: np.ndarray, high: np.ndarray) -> bool:
        """Insert all keys into ``table``, or none of them."""
        saved = table.copy()
        generator = np.random.default_rng(len(low))
        mark = fingerprints(high)
        bucket = low & (len(table) - 1)
        for turn in range(ROUNDS):
            order = np.argsort(bucket, kind="stable")
            bucket, mark = bucket[order], mark[order]
            taken = table[bucket] != 0
            rank = ranks(bucket)
            fits = rank < SLOTS - taken.sum(1)
            slot = np.argsort(taken, axis=1, kind="stable")[np.arange(len(rank)), np.minimum(rank, SLOTS - 1)]
            table[bucket[fits], slot[fits]] = mark[fits]
            bucket, mark = bucket[~fits], mark[~fits]
            if not len(bucket):
                return True
            if turn:  # one entry of each full bucket makes room, the rest try their other bucket
                evict = ranks(bucket) == 0
                slot = generator.integers(0, SLOTS, len(bucket))[evict]
                out = table[bucket[evict], slot].copy()
                table[bucket[evict], slot] = mark[evict]
                mark[evict] = out
            bucket = partner(bucket, mark, len(table))
        table[:] = saved
        return False

    def delete(self, low: np.ndarray, high: np.ndarray, where: np.ndarray) -> None:
        """Remove keys that were inserted, each from the segment that ``insert`` named."""
        for number, table in enumerate(self.segments):
            own = where == number
            mark = fingerprints(high[own])
            first = low[own] & (len(table) - 1)
            second = partner(first, mark, len(table))
            # Keys that share buckets and fingerprint own one copy each: take them in turns.
            left = np.arange(len(mark))
            while len(left):
                pair = np.minimum(first[left], second[left]) * 65536 + mark[left]
                order = np.argsort(pair, kind="stable")
                lead = np.zeros(len(left), bool)
                lead[order] = ranks(pair[order]) == 0
                turn = left[lead]
                for side in (first, second):
                    hit = table[side[turn]] == mark[turn][:, None]
                    found = hit.any(1)
                    table[side[turn][found], hit.argmax(1)[found]] = 0
                    turn = turn[~found]
                left = left[~lead]
