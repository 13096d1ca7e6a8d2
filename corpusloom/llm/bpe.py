"""BPE encoding by contiguous rank arrays, and decoding, for vocabulary files of the tokenizers library.

A word is an array of parts and an array with the merge rank of each adjacent pair. The array is
scanned for its minimum, the boundary between the two parts is deleted, and the two neighbouring
ranks are looked up again, until no pair has a rank. Words of equal length are held as rows of
one matrix, so a step scans and merges a whole block of words. Words above ``SHORT`` bytes, for
which repeated scans would be quadratic, use a heap over the same ranks with the same order.

A text with a character that this module's Unicode tables and the library's know differently (those assigned
after the library was made) is encoded by the library itself.

Null and empty texts have no tokens. Texts are encoded whole; a word occurs in a cache per worker
that is emptied when it grows beyond a fixed size.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import text as tx

SHORT = 48
CACHE_WORDS = 100_000
SLICE = 1 << 20
NONE = np.iinfo(np.int64).max


def byte_alphabet() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(other)) for b in range(256)]


def library(blob: bytes):
    """The tokenizers library's own encoder of a file, without truncation and padding."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(blob.decode())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class RankBpe:
    """Merges of one vocabulary file, given as its bytes."""

    def __init__(self, blob: bytes):
        self.blob, self.library, self.unlike = blob, None, None
        spec = json.loads(blob)
        model = spec["model"]
        vocabulary = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        self.normalizers = self._steps(spec.get("normalizer"))
        self.pattern, self.alphabet = self._splitter(spec["pre_tokenizer"]), byte_alphabet()
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("ignore_merges") or spec.get("decoder"):
            raise ValueError("vocabulary file asks for features that are not supported")
        self.size = max(vocabulary.values()) + 1
        self.middle = np.array([vocabulary[c] for c in self.alphabet], np.int64)
        self.last = np.array([vocabulary[c + suffix] for c in self.alphabet], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocabulary[a] * self.size + vocabulary[b] for a, b in pairs], np.int64)
        # The last of equal pairs counts, as in a mapping.
        keys, first = np.unique(keys[::-1], return_index=True)
        ranks = len(pairs) - 1 - first
        made = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        self.keys, self.ranks, self.made = keys, ranks, made
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        tokens = {i: t for t, i in vocabulary.items()} | {i: t for t, i in self.added.items()}
        self.tokens = [tokens.get(i, "").encode() for i in range(max(tokens) + 1)]
        self.forget()

    @staticmethod
    def _steps(normalizer) -> list[str]:
        steps = [] if not normalizer else normalizer.get("normalizers", [normalizer])
        names = [s["type"] for s in steps]
        if set(names) - {"NFC", "Replace", "Lowercase"}:
            raise ValueError(f"normalizers {names} are not supported")
        if any(s["type"] == "Replace" and (s["pattern"], s["content"]) != ({"Regex": "\\s+"}, " ") for s in steps):
            raise ValueError("only blanks may be replaced")
        return names

    @staticmethod
    def _splitter(pre) -> regex.Pattern:
        split, level = pre.get("pretokenizers", [{}, {}])
        if split.get("type") != "Split" or split["behavior"] != "Removed" or not split["invert"] or level.get("use_regex"):
            raise ValueError("only a removing split before the byte level is supported")
        return regex.compile(split["pattern"]["Regex"])

    def normalize(self, text: str) -> str:
        for step in self.normalizers:
            if step == "NFC":
                text = text if text.isascii() else unicodedata.normalize("NFC", text)
            elif step == "Lowercase":  # character by character: a sigma does not look at its neighbours
                text = text.replace("Σ", "σ").lower()
        return text  # blanks are dropped by the split, so their number does not matter

    def words(self, text: str) -> list:
        """Words of a text in order; an added token stands as its id."""
        if self.special is None or not self.special.search(text):
            return self.pattern.findall(self.normalize(text))
        found: list = []
        for at, piece in enumerate(self.special.split(text)):
            if at % 2:
                found.append(self.added[piece])
            elif piece:
                found += self.pattern.findall(self.normalize(piece))
        return found

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def merge_block(self, data: np.ndarray) -> list[np.ndarray]:
        """Token ids of words of one length: a matrix of bytes, a row for each word."""
        parts = np.concatenate([self.middle[data[:, :-1]], self.last[data[:, -1:]]], axis=1)
        done: list = [None] * len(parts)
        rows = np.arange(len(parts))
        ranks = self.rank(parts[:, :-1], parts[:, 1:])
        while len(rows):
            if ranks.shape[1] == 0:
                for row, ids in zip(rows, parts):
                    done[row] = ids
                break
            at = ranks.argmin(axis=1)
            line = np.arange(len(rows))
            low = ranks[line, at]
            ended = low == NONE
            if ended.any():
                for row, ids in zip(rows[ended], parts[ended]):
                    done[row] = ids
                rows, parts, ranks, at, low = rows[~ended], parts[~ended], ranks[~ended], at[~ended], low[~ended]
                line = np.arange(len(rows))
                if not len(rows):
                    break
            parts[line, at] = self.made[low]
            # Delete the boundary: everything behind it moves one place to the left.
            width = parts.shape[1] - 1
            column = np.arange(width)
            parts = np.take_along_axis(parts, column + (column > at[:, None]), 1)
            ranks = np.take_along_axis(ranks, column[:-1] + (column[:-1] >= at[:, None]), 1)
            left = at > 0
            ranks[line[left], at[left] - 1] = self.rank(parts[line[left], at[left] - 1], parts[line[left], at[left]])
            right = at < width - 1
            ranks[line[right], at[right]] = self.rank(parts[line[right], at[right]], parts[line[right], at[right] + 1])
        return done

    def merge_long(self, data: bytes) -> np.ndarray:
        """Token ids of one long word, by a heap of (rank, place) over linked parts."""
        values = np.frombuffer(data, np.uint8)
        parts = np.append(self.middle[values[:-1]], self.last[values[-1:]])
        n = len(parts)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        ids = parts.tolist()
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(self.rank(parts[:-1], parts[1:]).tolist()) if r != NONE]
        heapq.heapify(heap)
        one = lambda a, b: int(self.rank(np.array([a]), np.array([b]))[0])
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = int(self.made[rank]), -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := one(ids[i], ids[after[i]])) != NONE:
                    heapq.heappush(heap, (r, i, ids[i], ids[after[i]]))
            if before[i] >= 0 and (r := one(ids[before[i]], ids[i])) != NONE:
                heapq.heappush(heap, (r, before[i], ids[before[i]], ids[i]))
        return np.array([t for t in ids if t >= 0], np.int64)

    def merge_words(self, words: list[str]) -> list[np.ndarray]:
        """Token ids of each word."""
        blobs = [w.encode() for w in words]
        sizes = np.array([len(b) for b in blobs])
        done: list = [None] * len(words)
        for size in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == size)
            if size > SHORT:
                for row in rows:
                    done[row] = self.merge_long(blobs[row])
                continue
            for at in range(0, len(rows), 20_000):
                part = rows[at : at + 20_000]
                data = np.frombuffer(b"".join([blobs[r] for r in part]), np.uint8).reshape(-1, size)
                for row, ids in zip(part, self.merge_block(data)):
                    done[row] = ids
        return done

    def _by_library(self, text: str) -> list[int]:
        if self.library is None:
            self.library = library(self.blob)
        return self.library.encode(text, add_special_tokens=False).ids

    def forget(self) -> None:
        """Drop the words met so far."""
        self.known = {i: n for n, i in enumerate(self.added.values())}
        self.flat = np.array(list(self.added.values()), np.int64)
        self.start = np.arange(len(self.flat))
        self.length = np.ones(len(self.flat), np.int64)

    def _learn(self, words: list) -> None:
        ids = [w for w in words if not isinstance(w, str)]  # given by the library
        words = [w for w in words if isinstance(w, str)]
        found = self.merge_words(words) + [np.array([i]) for i in ids]
        words += ids
        lengths = np.array([len(f) for f in found], np.int64)
        first = len(self.length)
        self.start = np.append(self.start, len(self.flat) + np.cumsum(lengths) - lengths)
        self.length = np.append(self.length, lengths)
        self.flat = np.concatenate([self.flat, *found])
        self.known.update(zip(words, range(first, first + len(words))))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and each text's bounds in them."""
        words = [self.words(t) if t else [] for t in texts]
        for at, text in enumerate(texts):
            if not text.isascii() and self.unlike is not None and self.unlike.search(text):
                words[at] = self._by_library(text)
        ends = np.cumsum([0, *map(len, words)])
        words = [w for own in words for w in own]
        if len(self.known) > CACHE_WORDS:
            self.forget()
        new = set(words).difference(self.known)
        if new:
            self._learn(list(new))
        entry = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        lengths = self.length[entry]
        ids = self.flat[tx.ragged(self.start[entry], lengths)]
        return ids.astype(np.int32), np.concatenate([[0], np.cumsum(lengths)])[ends]

    def decode(self, ids: np.ndarray) -> bytes:
        """Text of a sequence of ids, special tokens kept: the file has no decoder, so tokens are joined by blanks."""
        return b" ".join(map(self.tokens.__getitem__, ids.tolist()))


@functools.lru_cache(2)
def rank_bpe(blob: bytes) -> RankBpe:
    return RankBpe(blob)


@functools.lru_cache(1)
def unlike_characters() -> str:
    """A pattern of the characters that the library classes, composes or lower-cases in another way than this module."""
    from tokenizers import Regex, normalizers

    points = np.array([p for p in range(0x110000) if not 0xD800 <= p < 0xE000], np.uint32)
    text = points.tobytes().decode("utf-32-le")
    unlike = np.zeros(len(points), bool)
    for pattern in (r"\p{L}", r"\p{N}", r"\s", r"\p{M}"):
        theirs = normalizers.Replace(Regex(pattern), "\0").normalize_str(text)
        ours = regex.sub(pattern, "\0", text)
        unlike |= np.frombuffer(theirs.encode("utf-32-le"), np.uint32) != np.frombuffer(ours.encode("utf-32-le"), np.uint32)
    where = np.flatnonzero(points != ord("\n"))
    sigma = str.maketrans({"\N{GREEK CAPITAL LETTER SIGMA}": "\N{GREEK SMALL LETTER SIGMA}"})
    # Alone, and behind marks that show whether a character is put in order with them.
    for around, theirs, ours in (
        ("{}", normalizers.Lowercase(), lambda x: x.translate(sigma).lower()),
        ("{}", normalizers.NFC(), lambda x: unicodedata.normalize("NFC", x)),
        ("{}\u0334", normalizers.NFC(), lambda x: unicodedata.normalize("NFC", x)),
    ):
        lines = "\n".join(around.format(c) for c in text if c != "\n")
        pairs = zip(theirs.normalize_str(lines).split("\n"), ours(lines).split("\n"))
        unlike[where[[a != b for a, b in pairs]]] = True
    at = points[unlike]
    ends = np.flatnonzero(np.append(np.diff(at) != 1, True)) if len(at) else np.zeros(0, int)
    begins = np.concatenate([[0], ends[:-1] + 1])[: len(ends)]
    ranges = "".join(f"\\U{at[a]:08x}-\\U{at[b]:08x}" for a, b in zip(begins, ends))
    return f"[{ranges}]" if ranges else r"(?!)"


def read_vocabulary(path: str) -> bytes:
    """The vocabulary file, read on the driver and sent with the tasks: its size is that of a vocabulary."""
    with open(path, "rb") as file:
        return file.read()


def text_parts(column: pa.Array, limit: int = SLICE):
    """(first row, texts) in slices of bounded size; null becomes empty."""
    texts, size, first = [], 0, 0
    for value in column.to_pylist():
        texts.append(value or "")
        size += len(texts[-1])
        if size >= limit:
            yield first, texts
            first, texts, size = first + len(texts), [], 0
    if texts:
        yield first, texts


def encoded_batches(batches, vocabulary: bytes, unlike: str, text: str, column: str):
    """Batches without their text and with the ids of it as the last column."""
    bpe = rank_bpe(vocabulary)
    bpe.unlike = re.compile(unlike)
    for batch in batches:
        keep = [c for c in batch.schema.names if c != text]
        for first, texts in text_parts(batch.column(batch.schema.get_field_index(text))):
            ids, bounds = bpe.encode(texts)
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids))
            yield tx.with_columns(batch.slice(first, len(texts)), keep, {column: lists})


def decoded_batches(batches, vocabulary: bytes, column: str, text: str):
    """Batches with the text that their ids stand for as the last column."""
    bpe = rank_bpe(vocabulary)
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            lists = part.column(part.schema.get_field_index(column))
            texts = [bpe.decode(v.values.to_numpy()).decode() if v.is_valid else "" for v in lists]
            yield tx.with_columns(part, part.schema.names, {text: pa.array(texts, pa.string())})


def encode(docs: DataFrame, vocabulary: bytes, column: str = "ids", text: str = "text") -> DataFrame:
    """``docs`` without its text and with an array of token ids, which replaces a column of that name."""
    docs = docs.drop(column)
    unlike = unlike_characters()
    schema = T.StructType([f for f in docs.schema.fields if f.name != text] + [T.StructField(column, T.ArrayType(T.IntegerType()))])

    def run(batches):
        return encoded_batches(batches, vocabulary, unlike, text, column)

    return docs.mapInArrow(tx.frugal(run, rank_bpe), schema)


def decode(encoded: DataFrame, vocabulary: bytes, column: str = "ids", text: str = "text") -> DataFrame:
    """Add the text that the ids stand for, replacing a column of that name; null ids give an empty text."""
    encoded = encoded.drop(text)
    schema = T.StructType([*encoded.schema.fields, T.StructField(text, T.StringType())])

    def run(batches):
        return decoded_batches(batches, vocabulary, column, text)

    return encoded.mapInArrow(tx.frugal(run, rank_bpe), schema)


def round_trip(docs: DataFrame, vocabulary: bytes, summary=None, schema=None, column: str = "ids", text: str = "text") -> DataFrame:
    """:func:`encode` and :func:`decode` in one pass of one worker: ``docs`` with ids, and the decoded text in its text.

    ``summary`` may turn the batches into others, of ``schema``, before they leave the worker.
    """
    docs = docs.drop(column)
    unlike = unlike_characters()
    fields = [f for f in docs.schema.fields if f.name != text]
    coded = T.StructType([*fields, T.StructField(column, T.ArrayType(T.IntegerType())), T.StructField(text, T.StringType())])

    def run(batches):
        both = decoded_batches(encoded_batches(batches, vocabulary, unlike, text, column), vocabulary, column, text)
        return summary(both) if summary else both

    return docs.mapInArrow(tx.frugal(run, rank_bpe), schema or coded)
