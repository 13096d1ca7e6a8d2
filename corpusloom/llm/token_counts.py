"""Token counts by finite-state transducers, compiled from a byte-level BPE vocabulary file.

Two deterministic transducers read a text:

* The **splitter** reads character classes and marks where the library's pattern starts a new word. It has a
  dozen states, so a chunk of text is a map from each of them to another one. Texts are cut into chunks, all
  chunks run in step from all states, the maps are composed by a parallel prefix scan, and a second run from
  the now known states gives the marks: a long text is as parallel as many short ones.
* The **counter** reads the bytes of a word; a transition is annotated with the change in the number of tokens.
  A state holds what can still matter: for each place behind which a token may still grow, the node of the
  vocabulary's trie, the token that ends there, and the number of tokens since. Of the tokens that end at the
  byte read, exactly one follows the token before it in a merge-order segmentation (:meth:`Merges.follows`).
  States are compiled when first met and shared by all words with the same future; beyond ``STATES`` of them
  the table is emptied. All words of a slice run in step.

Counts equal those of the tokenizers library without begin, end or added special tokens; a special token that
stands in a text counts as one, as by the library's default. Character classes are taken from the library
itself, so both know the same Unicode version. Null and empty texts have no tokens; rows are never dropped, repeated
rows are counted each, and other columns are kept (result names replace columns of those names).
"""

from __future__ import annotations

import functools
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from . import text as tx
from .bpe import byte_alphabet
from .columns import free_name

SLICE = 1 << 20  # bytes of text worked on at a time
CHUNK = 256  # characters
STATES = 400_000
NEAR = 1 << 9  # the number of tokens since a place that still matters stays below this, both ways
FEW = 48  # words that still run: below this a loop over each of them is quicker than a step of all

# Character classes.
LETTER, S_T_M_D, R_V, ELL, E, NUMBER, BLANK, SPACE, QUOTE, OTHER = range(10)
WIDTH = 16  # of a row of the splitter's table

# States of the splitter.
(START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AT_QUOTE, QUOTE_R_V, QUOTE_ELL, ENDED, ONE_BLANK, ONE_SPACE, BLANK_LAST, SPACE_LAST) = range(12)
HERE, BEFORE = 1, 2  # a word starts at this character; at the one before


def splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next states (times ``WIDTH``) and marks of every state and class.

    The pattern it stands for, in its order: 's 't 're 've 'm 'll 'd, then letters, numbers or others with a
    blank before them, then blanks up to the last one before something else, then blanks.
    """
    after = np.zeros((12, WIDTH), np.uint8)
    marks = np.zeros((12, WIDTH), np.uint8)
    letters = (LETTER, S_T_M_D, R_V, ELL, E)
    fresh = {c: IN_LETTERS for c in letters} | {NUMBER: IN_NUMBERS, BLANK: ONE_BLANK, SPACE: ONE_SPACE, QUOTE: AT_QUOTE, OTHER: IN_OTHERS}
    attached = {c: IN_LETTERS for c in letters} | {NUMBER: IN_NUMBERS, QUOTE: IN_OTHERS, OTHER: IN_OTHERS}
    for state in range(12):
        for kind in range(10):
            to, mark = fresh[kind], HERE
            if state == IN_LETTERS and kind in letters or state == IN_NUMBERS and kind == NUMBER:
                to, mark = state, 0
            elif state in (IN_OTHERS, AT_QUOTE) and kind in (QUOTE, OTHER):
                to, mark = IN_OTHERS, 0
            elif state == AT_QUOTE and kind in (S_T_M_D, R_V, ELL):
                to, mark = {S_T_M_D: ENDED, R_V: QUOTE_R_V, ELL: QUOTE_ELL}[kind], 0
            elif state == QUOTE_R_V and kind == E or state == QUOTE_ELL and kind == ELL:
                to, mark = ENDED, 0
            elif state in (QUOTE_R_V, QUOTE_ELL):  # the quote stood alone, a word began with the letter after it
                to, mark = (IN_LETTERS, BEFORE) if kind in letters else (fresh[kind], BEFORE | HERE)
            elif state in (ONE_BLANK, ONE_SPACE, BLANK_LAST, SPACE_LAST):
                if kind in (BLANK, SPACE):
                    to, mark = BLANK_LAST if kind == BLANK else SPACE_LAST, 0
                elif state in (ONE_BLANK, BLANK_LAST):
                    to, mark = attached[kind], 0 if state == ONE_BLANK else BEFORE
                elif state == SPACE_LAST:
                    mark = BEFORE | HERE
            after[state, kind], marks[state, kind] = to * WIDTH, mark
    return after.ravel(), marks.ravel()


AFTER, MARKS = splitter()


@functools.lru_cache(1)
def character_classes() -> bytes:
    """Class of every code point, as the tokenizers library's own pattern engine sees letters, numbers and blanks."""
    from tokenizers import Regex, normalizers

    points = np.array([p for p in range(0x110000) if not 0xD800 <= p < 0xE000], np.uint32)
    text = points.tobytes().decode("utf-32-le")
    classes = np.full(0x110000, OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", SPACE)):
        marked = normalizers.Replace(Regex(pattern), "\0").normalize_str(text)
        found = np.frombuffer(marked.encode("utf-32-le"), np.uint32) == 0
        found[0] = False  # U+0000 itself is none of these
        classes[points[found]] = kind
    for letters, kind in (("stmd", S_T_M_D), ("rv", R_V), ("l", ELL), ("e", E), (" ", BLANK), ("'", QUOTE)):
        classes[[ord(c) for c in letters]] = kind
    return classes.tobytes()


def word_starts(classes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Which characters start a word; texts lie one after another, text i in ``bounds[i]:bounds[i + 1]``."""
    starts = np.zeros(len(classes) + 1, bool)
    lengths = np.diff(bounds)
    counts = -(-lengths // CHUNK)
    first = np.repeat(bounds[:-1], counts) + tx.ragged(np.zeros(len(counts), np.int64), counts) * CHUNK
    ends = np.minimum(first + CHUNK, np.repeat(bounds[1:], counts))
    begins = np.repeat(bounds[:-1], counts) == first
    order = np.argsort(first - ends, kind="stable")  # longest first, so that those still running come first
    first, ends, begins = first[order], ends[order], begins[order]
    sizes = ends - first
    running = np.searchsorted(-sizes, -np.arange(1, CHUNK + 1), "right")  # chunks with more than t characters
    # Maps: every chunk from every state. A text's first chunk is only ever entered in the first state.
    maps = np.tile((np.arange(12) * WIDTH).astype(np.uint8), (len(first), 1))
    maps[begins] = START * WIDTH
    for t in range(int(sizes.max(initial=0))):
        n = running[t]
        maps[:n] = AFTER[maps[:n] + classes[first[:n] + t][:, None]]
    back = np.argsort(order, kind="stable")
    maps = (maps // WIDTH)[back]
    # Prefix scan: after step s a map spans 2^(s+1) chunks; maps that start a text are constant and stop it.
    step = 1
    while step < counts.max(initial=0):
        maps[step:] = np.take_along_axis(maps[step:], maps[:-step], 1)
        step *= 2
    entry = np.zeros(len(first), np.uint8)
    entry[1:] = maps[:-1, START]
    state = (entry * WIDTH).astype(np.uint8)[order]
    state[begins] = START * WIDTH
    for t in range(int(sizes.max(initial=0))):
        n = running[t]
        at = first[:n] + t
        move = state[:n] + classes[at]
        mark = MARKS[move]
        starts[at[(mark & HERE) > 0]] = True
        starts[at[(mark & BEFORE) > 0] - 1] = True
        state[:n] = AFTER[move]
    # A quote and r, v or l at the very end of a text did not become a word of its own.
    last = (ends == bounds[1:][np.repeat(np.arange(len(counts)), counts)][order]) & np.isin(state // WIDTH, (QUOTE_R_V, QUOTE_ELL))
    starts[ends[last] - 1] = True
    return starts[:-1]


class Merges:
    """Merges of a byte-level vocabulary: which token may follow which, and the trie of tokens."""

    def __init__(self, model: dict):
        if model["type"] != "BPE" or any(model.get(k) for k in ("continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "dropout")):
            raise ValueError("the vocabulary file asks for features that are not supported")
        back = {c: b for b, c in enumerate(byte_alphabet())}
        vocabulary = model["vocab"]
        self.bytes_of = {vocabulary[c]: bytes([b]) for c, b in back.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for at, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b, made = vocabulary[left], vocabulary[right], vocabulary[left + right]
            if made in self.parts or (a, b) in self.rank or a not in self.bytes_of or b not in self.bytes_of:
                raise ValueError("merges must make each token once, of tokens made before")
            self.rank[a, b], self.parts[made] = at, (a, b)
            self.bytes_of[made] = self.bytes_of[a] + self.bytes_of[b]
        self.right: dict[int, list[tuple[int, float]]] = {}
        self.left: dict[int, list[tuple[int, float]]] = {}
        self.known: dict[tuple[int, int], bool] = {}
        # The trie holds tokens that are their own segmentation; others never come out of the merges.
        self.children: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]
        for token, (a, b) in [*((t, (None, None)) for t in self.bytes_of if t not in self.parts), *self.parts.items()]:
            if a is not None and not self.meets(a, b, self.rank[a, b]):
                continue
            node = 0
            for byte in self.bytes_of[token]:
                if byte not in self.children[node]:
                    self.children[node][byte] = len(self.children)
                    self.children.append({})
                    self.token.append(-1)
                node = self.children[node][byte]
            self.token[node] = token

    def spine(self, token: int, side: int, held: dict) -> list[tuple[int, float]]:
        """What stands at one edge of a token while it is built, and the rank of the merge that ends it."""
        if token not in held:
            chain, until = [], float("inf")
            while True:
                chain.append((token, until))
                if token not in self.parts:
                    break
                until = self.rank[self.parts[token]]
                token = self.parts[token][side]
            held[chain[0][0]] = chain[::-1]
            return chain[::-1]
        return held[token]

    def meets(self, a: int, b: int, last: float) -> bool:
        """Whether no merge across the border of ``a`` and ``b`` comes before the one of rank ``last``."""
        ahead, behind = self.spine(a, 1, self.right), self.spine(b, 0, self.left)
        i = j = 0
        while True:
            (x, x_until), (y, y_until) = ahead[i], behind[j]
            across = self.rank.get((x, y), last)
            # Of merges of one rank the one further left comes first.
            if across < last and across < x_until and across <= y_until:
                return False
            if x_until == y_until == float("inf"):
                return True
            if x_until <= y_until:
                i += 1
            else:
                j += 1

    def follows(self, a: int, b: int) -> bool:
        """Whether ``a`` and ``b`` stay as they are when they stand side by side."""
        key = (a, b)
        found = self.known.get(key)
        if found is None:
            if len(self.known) > STATES:
                self.known.clear()
            found = self.known[key] = self.meets(a, b, float("inf"))
        return found


class Counter:
    """The counting transducer: transitions (state, byte) -> (state, change of the count), compiled when met."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.node_bits, self.token_bits = len(merges.token).bit_length(), max(merges.bytes_of).bit_length() + 1
        self._reset()

    def _reset(self) -> None:
        # A state is a number that packs (trie node, token that ends before it + 1, tokens since then + ``NEAR``) of each place.
        self.states: list[int] = [self._packed(0, -1, 0)]
        self.number: dict[int, int] = {self.states[0]: 0}
        self.size = 1 << 16
        self.keys = np.full(self.size, -1, np.int64)
        self.moves = np.zeros(self.size, np.int64)  # state and change (+ 1024) in one number
        self.used = 0

    def _packed(self, node: int, before: int, since: int) -> int:
        if not -NEAR < since < NEAR:
            raise ValueError("the vocabulary has tokens too long to count")
        return ((since + NEAR) << self.token_bits | before + 1) << self.node_bits | node

    def _restart(self, live: np.ndarray) -> np.ndarray:
        """Empty the table but for the states that words are in; their new numbers."""
        unique, inverse = np.unique(live, return_inverse=True)
        held = [self.states[s] for s in unique.tolist()]
        self._reset()
        return np.array([self._numbered(places) for places in held], np.int64)[inverse]

    def _numbered(self, places: int) -> int:
        """Number of a state, new or known."""
        if self.number.setdefault(places, len(self.states)) == len(self.states):
            self.states.append(places)
        return self.number[places]

    def compile(self, key: int) -> int:
        """The move of one (state, byte)."""
        byte, places = key & 255, self.states[key >> 8]
        children, token, follows = self.merges.children, self.merges.token, self.merges.follows
        width = self.node_bits + self.token_bits + NEAR.bit_length()
        grown, made, change = [], -1, 0
        while places:
            place = places & (1 << width) - 1
            places >>= width
            child = children[place & (1 << self.node_bits) - 1].get(byte)
            if child is None:
                continue
            before = (place >> self.node_bits & (1 << self.token_bits) - 1) - 1
            since = (place >> self.node_bits + self.token_bits) - NEAR
            t = token[child]
            if t >= 0 and made < 0 and (before < 0 or follows(before, t)):
                made, change = t, 1 - since
            if children[child]:
                grown.append((child, before, since))
        if made < 0:
            raise ValueError("the vocabulary's merges have no segmentation that follows pair by pair")
        after = 0
        for node, before, since in reversed(grown):
            after = after << width | self._packed(node, before, since + change)
        after = after << width | self._packed(0, made, 0)
        return self._numbered(after) << 12 | change + 1024

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        """Places of keys in the table: where they stand, or the free place where they would."""
        at = (tx.mix(keys.astype(np.uint64)) & np.uint64(self.size - 1)).astype(np.int64)
        held = self.keys[at]
        wrong = np.flatnonzero((held != keys) & (held >= 0))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & (self.size - 1)
            held = self.keys[at[wrong]]
            wrong = wrong[(held != keys[wrong]) & (held >= 0)]
        return at

    def _store(self, keys: np.ndarray, moves: np.ndarray) -> None:
        self.used += len(keys)
        if 2 * self.used > self.size:
            old = self.keys >= 0
            keys, moves = np.concatenate([self.keys[old], keys]), np.concatenate([self.moves[old], moves])
            self.size *= 4
            self.keys, self.moves = np.full(self.size, -1, np.int64), np.zeros(self.size, np.int64)
        while len(keys):
            at = self._slot(keys)
            self.keys[at] = keys  # of several keys for one place the last stays; the rest try again
            stays = self.keys[at] == keys
            self.moves[at[stays]] = moves[stays]
            keys, moves = keys[~stays], moves[~stays]

    def step(self, keys: np.ndarray) -> np.ndarray:
        at = self._slot(keys)
        out = self.moves[at]
        missing = self.keys[at] < 0
        if missing.any():
            new = np.unique(keys[missing])
            made = np.array([self.compile(k) for k in new.tolist()], np.int64)
            out[missing] = made[np.searchsorted(new, keys[missing])]
            self._store(new, made)
        return out

    def count(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Number of tokens of each word ``data[start:end]``."""
        sizes = ends - starts
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[order], sizes[order]
        total = np.zeros(len(starts), np.int64)
        state = np.zeros(len(starts), np.int64)
        t, n = 0, len(starts)
        while n:
            if len(self.states) > STATES:
                state[:n] = self._restart(state[:n])
            n = int(np.searchsorted(-sizes[:n], -t, "left"))  # words with more than t bytes
            if n < FEW:
                break
            moves = self.step(state[:n] << 8 | data[starts[:n] + t])
            state[:n] = moves >> 12
            total[:n] += (moves & 4095) - 1024
            t += 1
        left = [self.states[s] for s in state[:n].tolist()]  # a loop may empty the table
        for i, places in enumerate(left):
            total[i] += self._rest(self._numbered(places), data[starts[i] + t : starts[i] + sizes[i]].tobytes())
        out = np.empty_like(total)
        out[order] = total
        return out

    def _rest(self, state: int, data: bytes) -> int:
        """Tokens that the bytes of one word add; states of a long word are bounded like all others."""
        total, met = 0, {}
        for byte in data:
            key = state << 8 | byte
            move = met.get(key)
            if move is None:
                if len(self.states) > 2 * STATES:
                    state = int(self._restart(np.array([state]))[0])
                    key = state << 8 | byte
                    met.clear()
                move = met[key] = self.compile(key)
            state = move >> 12
            total += (move & 4095) - 1024
        return total


class TokenCounter:
    """Both transducers of one vocabulary file."""

    def __init__(self, blob: bytes, classes: bytes):
        spec = json.loads(blob)
        level = spec["pre_tokenizer"]
        if level["type"] != "ByteLevel" or not level["use_regex"] or level["add_prefix_space"] or spec.get("normalizer"):
            raise ValueError("only byte-level files that split by the library's own pattern are supported")
        added = spec.get("added_tokens", [])
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("added tokens that look at their neighbours are not supported")
        self.names = sorted((t["content"].encode() for t in added), key=len, reverse=True)
        self.special = re.compile(b"|".join(map(re.escape, self.names)))
        self.classes, self.counter = np.frombuffer(classes, np.uint8), Counter(Merges(spec["model"]))

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text; text i lies in ``data[offsets[i]:offsets[i + 1]]``."""
        raw, n = data.tobytes(), len(offsets) - 1
        begin, end, owner = offsets[:-1], offsets[1:], np.arange(n)
        extra = np.zeros(n, np.int64)
        if any(name in raw for name in self.names):
            found = [(i, *m.span()) for i in range(n) for m in self.special.finditer(raw, offsets[i], offsets[i + 1])]
            if found:  # what lies between special tokens is split as a text of its own
                of, a, b = np.array(found, np.int64).T
                extra += np.bincount(of, minlength=n)
                begin, end, owner = np.append(begin, b), np.append(end, a), np.append(owner, of)
                begin, end, owner = begin[np.lexsort((begin, owner))], end[np.lexsort((end, owner))], np.sort(owner)
        points = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        whole = len(points) == len(data)  # a byte a character
        head = None if whole else np.flatnonzero((data & 0xC0) != 0x80)
        place = (lambda b: b) if whole else (lambda b: np.searchsorted(head, b))
        first, lengths = place(begin), place(end) - place(begin)
        inside = tx.ragged(first, lengths)
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        starts = np.flatnonzero(word_starts(self.classes[points[inside]], bounds))
        at = inside[starts] if whole else head[inside[starts]]
        piece = np.searchsorted(bounds, starts, "right") - 1
        ends = np.minimum(np.append(at[1:], len(data)), end[piece])
        tokens = self.counter.count(data, at, ends)
        return extra + np.bincount(owner[piece], tokens, n).astype(np.int64)


@functools.lru_cache(1)
def token_counter(blob: bytes, classes: bytes) -> TokenCounter:
    return TokenCounter(blob, classes)


def count_tokens(docs: DataFrame, vocabulary: bytes, text: str = "text", n_bytes: str = "n_bytes", n_tokens: str = "n_tokens") -> DataFrame:
    """``docs`` without its text, with the text's length in bytes and its number of tokens.

    ``vocabulary`` is the content of a byte-level file of the tokenizers library (see :func:`bpe.read_vocabulary`).
    """
    keep = [c for c in docs.columns if c not in (text, n_bytes, n_tokens)]
    own = free_name(keep, "_text")
    docs = docs.select(*keep, F.col(text).alias(own))
    fields = [f for f in docs.schema.fields if f.name != own]
    schema = T.StructType([*fields, T.StructField(n_bytes, T.LongType()), T.StructField(n_tokens, T.LongType())])
    classes = character_classes()  # 1.1 MB for all of Unicode

    def run(batches):
        counter = token_counter(vocabulary, classes)
        for batch in batches:
            for first, stop, data, offsets in tx.slices(batch.column(len(keep)), SLICE):
                new = {n_bytes: pa.array(np.diff(offsets)), n_tokens: pa.array(counter.counts(data, offsets))}
                yield tx.with_columns(batch.slice(first, stop - first), keep, new)

    return docs.mapInArrow(run, schema)
