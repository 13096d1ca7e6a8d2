"""Benchmark decontamination with suffix arrays over the words of training shards.

A shard is a slice of a partition's documents. Its suffix array holds the positions that
can start a match (their first words occur in the test set), in order of the words that
follow. Every test suffix is searched in every shard's array by bisection: the range of
suffixes that begin with a window gives the places of that window, and the neighbours of
the insertion point give the longest verbatim match. No document is shuffled.

The test set travels with the task, so it is cut into blocks of a fixed number of words;
each block is one pass over the documents, and passes hand on the places found so far.

Null or empty texts have no words and no match. Ties and repeated rows are searched like
any other row. An item without words is found nowhere; items with a null id are searched like
others (their matches count, all of them as one item, and add no id to a list of ids). Extra
columns of either table do not matter; documents keep theirs.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from . import text as tx
from .columns import free_name

WINDOW = 10
BLOCK_WORDS = 1_000_000
SHARD_BYTES = 4 << 20

MATCH = T.StructType(
    [
        T.StructField("item_id", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
    ]
)


class ItemBlock:
    """Word codes of some test items: codes count from 1, 0 stands for every other word."""

    def __init__(self, ids: list[str], texts: list[str], window: int):
        self.window = window
        hashes, lengths = [], []
        for _, _, data, offsets in tx.slices(pa.array(texts, pa.large_string())):
            words, _, _, bounds = tx.word_hashes(data, offsets, tx.ALNUM)
            hashes.append(words)
            lengths.append(np.diff(bounds))
        words = np.concatenate(hashes or [np.zeros(0, np.uint64)])
        lengths = np.concatenate(lengths or [np.zeros(0, np.int64)]).astype(np.int64)
        self.ids = np.array(ids, dtype=object)
        self.vocabulary = np.unique(words)
        ends = np.cumsum(lengths)
        # One row per test suffix: its first word, the words left in its item, its item.
        self.item = np.repeat(np.arange(len(ids)), lengths)
        self.left = np.repeat(ends, lengths) - np.arange(len(words))
        whole = np.repeat(lengths, lengths)
        self.query = np.where(self.left >= np.minimum(whole, window), np.minimum(whole, window), 0)
        self.codes = np.concatenate([np.searchsorted(self.vocabulary, words) + 1, [0]]).astype(np.int64)
        last = self.left == 1
        following = np.where(last, 0, self.codes[1:])
        # Pairs that can begin a match; a one-word item needs its word alone.
        pairs = self.codes[:-1] * (len(self.vocabulary) + 1) + following
        self.pairs = np.unique(pairs[~last])
        self.single = np.unique(self.codes[:-1][whole == 1])
        self.longest = int(lengths.max()) if len(lengths) else 0


def lookup(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    """1-based place of each value, 0 if absent."""
    if not len(sorted_values):
        return np.zeros(len(values), np.int64)
    at = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return np.where(sorted_values[at] == values, at + 1, 0)


class Shard:
    """Suffix array over coded words; code 0 ends every suffix."""

    def __init__(self, codes: np.ndarray, block: ItemBlock):
        size = len(block.vocabulary) + 1
        self.codes = np.concatenate([codes, np.zeros(1, np.int64)])
        following = self.codes[1:]
        starts = lookup(block.pairs, codes * size + following) > 0
        if len(block.single):
            starts |= lookup(block.single, codes) > 0
        self.suffixes = self.order(np.flatnonzero(starts & (codes > 0)), size, block.longest)

    def word(self, at: np.ndarray) -> np.ndarray:
        return self.codes[np.minimum(at, len(self.codes) - 1)]

    def order(self, at: np.ndarray, size: int, depth: int) -> np.ndarray:
        """Sort by packed runs of words; only groups still tied are looked at again."""
        step = max(1, 62 // max(1, int(size).bit_length()))
        group = np.zeros(len(at), np.int64)
        tied = np.arange(len(at))
        done = 0
        while len(tied) and done < depth:
            key = np.zeros(len(tied), np.int64)
            live = np.ones(len(tied), bool)
            for j in range(step):
                word = np.where(live, self.word(at[tied] + done + j), 0)
                live &= word > 0
                key = key * size + word
            order = np.lexsort((key, group[tied]))
            at[tied] = at[tied][order]
            key, live, old = key[order], live[order], group[tied]
            fresh = np.ones(len(tied), bool)
            fresh[1:] = (key[1:] != key[:-1]) | (old[1:] != old[:-1])
            # A group is named after its first place, so names stay in order.
            group[tied] = tied[np.maximum.accumulate(np.where(fresh, np.arange(len(tied)), 0))]
            same = ~fresh
            again = same.copy()
            again[:-1] |= same[1:]
            tied = tied[again & live]
            done += step
        return at

    def agree(self, suffix: np.ndarray, query: np.ndarray, limit: np.ndarray, block: ItemBlock):
        """Words in common (up to ``limit``) and the sign of the first difference."""
        common = np.zeros(len(suffix), np.int64)
        sign = np.zeros(len(suffix), np.int8)
        live = np.arange(len(suffix))
        live = live[limit[live] > 0]
        while len(live):
            a = self.word(suffix[live] + common[live])
            b = block.codes[query[live] + common[live]]
            equal = (a == b) & (a > 0)
            sign[live[~equal]] = np.sign(a[~equal] - b[~equal])
            live = live[equal]
            common[live] += 1
            live = live[common[live] < limit[live]]
        return common, sign

    def bound(self, query: np.ndarray, limit: np.ndarray, upper: bool, block: ItemBlock) -> np.ndarray:
        """First suffix not below (or, with ``upper``, above) the first ``limit`` words of each query."""
        low = np.zeros(len(query), np.int64)
        high = np.full(len(query), len(self.suffixes), np.int64)
        while True:
            live = np.flatnonzero(low < high)
            if not len(live):
                return low
            middle = (low[live] + high[live]) // 2
            _, sign = self.agree(self.suffixes[middle], query[live], limit[live], block)
            right = (sign < 0) | (upper & (sign == 0))
            low[live[right]] = middle[right] + 1
            high[live[~right]] = middle[~right]

    def windows(self, block: ItemBlock):
        """Every place of every window: position, length, item."""
        query = np.flatnonzero(block.query)
        length = block.query[query]
        low = self.bound(query, length, False, block)
        count = self.bound(query, length, True, block) - low
        at = self.suffixes[tx.ragged(low, count)]
        return at, np.repeat(length, count), np.repeat(block.item[query], count)

    def longest(self, block: ItemBlock):
        """Longest verbatim match of each test suffix and one place of it."""
        query = np.arange(len(block.left))
        best, place = np.zeros(len(query), np.int64), np.full(len(query), -1)
        if len(self.suffixes):
            at = self.bound(query, block.left, False, block)
            for near in (at - 1, at):
                here = self.suffixes[np.clip(near, 0, len(self.suffixes) - 1)]
                common, _ = self.agree(here, query, block.left, block)
                place = np.where(common > best, here, place)
                best = np.maximum(best, common)
        return best, place


def shards(column: pa.Array, block: ItemBlock):
    """``(first row, first word of each text, shard)`` for each slice; texts are kept apart by a 0."""
    for first, _, data, offsets in tx.slices(column, SHARD_BYTES):
        words, _, _, bounds = tx.word_hashes(data, offsets, tx.ALNUM)
        n = len(bounds) - 1
        codes = np.zeros(len(words) + n, np.int64)
        gap = np.repeat(np.arange(n), np.diff(bounds))
        codes[np.arange(len(words)) + gap] = lookup(block.vocabulary, words)
        yield first, bounds + np.arange(n + 1), Shard(codes, block)


def covered(rows: np.ndarray, starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Words in the union of the spans of each row."""
    if not len(rows):
        return np.zeros(n, np.int64)
    order = np.lexsort((starts, rows))
    rows, starts, ends = rows[order], starts[order], (starts + lengths)[order]
    base = rows * (int(ends.max()) + 1)
    reach = np.maximum.accumulate(ends + base)
    before = np.concatenate([[-1], reach[:-1]])
    own = np.maximum(0, ends + base - np.maximum(starts + base, before))
    return np.bincount(rows, own, n).astype(np.int64)


def merged(rows: np.ndarray, starts: np.ndarray, lengths: np.ndarray, items: np.ndarray):
    """Join overlapping and touching windows of one item in one row to spans."""
    if not len(rows):
        return rows, starts, lengths, items
    order = np.lexsort((starts, items, rows))
    rows, starts, items, ends = rows[order], starts[order], items[order], (starts + lengths)[order]
    group = np.zeros(len(rows), np.int64)
    group[1:] = np.cumsum((rows[1:] != rows[:-1]) | (items[1:] != items[:-1]))
    base = group * (int(ends.max()) + 2)
    reach = np.maximum.accumulate(ends + base)
    fresh = np.ones(len(rows), bool)
    fresh[1:] = starts[1:] + base[1:] > reach[:-1]
    first = np.flatnonzero(fresh)
    last = np.concatenate([first[1:], [len(rows)]]) - 1
    return rows[first], starts[first], (reach - base)[last] - starts[first], items[first]


def search_block(docs: DataFrame, block: ItemBlock, text: str, names: tuple[str, str]) -> DataFrame:
    """One pass: add the block's spans to the column ``names[0]``."""
    matches, n_words = names
    first = matches not in docs.columns
    schema = T.StructType(list(docs.schema.fields))
    if first:
        schema = schema.add(matches, T.ArrayType(MATCH)).add(n_words, T.LongType())
    keep = list(docs.columns)

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            counts = np.zeros(n, np.int64)
            parts = []
            for row, bounds, shard in shards(batch.column(batch.schema.get_field_index(text)), block):
                counts[row : row + len(bounds) - 1] = np.diff(bounds) - 1
                at, length, item = shard.windows(block)
                doc = np.searchsorted(bounds, at, "right") - 1
                parts.append(merged(doc + row, at - bounds[doc], length, item))
            rows, starts, lengths, items = (np.concatenate(x) for x in zip(*parts)) if parts else [np.zeros(0, np.int64)] * 4
            order = np.argsort(rows, kind="stable")
            offsets = np.searchsorted(rows[order], np.arange(n + 1))
            spans = pa.StructArray.from_arrays(
                [
                    pa.array(block.ids[items[order]].tolist(), pa.string()),
                    pa.array(starts[order], pa.int64()),
                    pa.array(lengths[order], pa.int64()),
                ],
                names=[f.name for f in MATCH.fields],
            )
            found = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans)
            if first:
                yield tx.with_columns(batch, keep, {matches: found, n_words: pa.array(counts)})
            else:
                old = batch.column(batch.schema.get_field_index(matches))
                both = pa.array([a + b for a, b in zip(old.to_pylist(), found.to_pylist())], found.type)
                columns = [both if c == matches else batch.column(i) for i, c in enumerate(keep)]
                yield pa.RecordBatch.from_arrays(columns, names=keep)

    return docs.mapInArrow(tx.frugal(run), schema)


def item_blocks(benchmark: DataFrame, window: int, block_words: int):
    """Test items in blocks of about ``block_words`` words, dealt by hash, one block at a time."""
    words = F.size(F.split(F.coalesce("text", F.lit("")), "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"))
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    items = items.distinct()
    total = items.agg(F.sum(words)).first()[0] or 0
    parts = max(1, -(-int(total) // block_words))
    for part in range(parts):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).orderBy("item_id", "text").collect()
        yield ItemBlock([r[0] for r in rows], [r[1] for r in rows], window)


def find_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    matches: str = "matches",
    n_words: str = "match_words",
) -> DataFrame:
    """Documents with ``matches`` (item, first word, words; overlapping windows joined) and the word count.

    ``docs`` needs ``text``; ``benchmark`` needs ``item_id`` and ``text``. Words are runs of ASCII
    letters and digits and of all characters from U+0080, with A-Z lower-cased. A match is
    ``window`` consecutive words of an item, or all words of a shorter item. Columns of ``docs`` that are
    named like a result give way to it.
    """
    docs = docs.drop(matches, n_words)
    for block in item_blocks(benchmark, window, block_words):
        docs = search_block(docs, block, "text", (matches, n_words))
    return docs


def longest_matches(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """For every test suffix ``(item_id, word)`` its longest verbatim match and the smallest place of it.

    Returns item_id, word (of the item), length, doc_id, start; suffixes without a match of two words (or of
    a one-word item) are absent.
    """
    found = None
    schema = "item_id string, word long, length long, doc_id long, start long"
    for block in item_blocks(benchmark, WINDOW, block_words):
        begin = np.concatenate([[0], np.cumsum(np.bincount(block.item, minlength=len(block.ids)))])

        def run(batches, block=block, begin=begin):
            for batch in batches:
                for row, bounds, shard in shards(batch.column(1), block):
                    best, place = shard.longest(block)
                    hit = np.flatnonzero(best)
                    doc = np.searchsorted(bounds, place[hit], "right") - 1
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(block.ids[block.item[hit]].tolist(), pa.string()),
                            pa.array(hit - begin[block.item[hit]]),
                            pa.array(best[hit]),
                            batch.column(0).take(pa.array(doc + row)),
                            pa.array(place[hit] - bounds[doc]),
                        ],
                        names=["item_id", "word", "length", "doc_id", "start"],
                    )

        part = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tx.frugal(run), schema)
        found = part if found is None else found.unionByName(part)
    best = F.max(F.struct("length", (-F.coalesce("doc_id", F.lit(0))).alias("d"), (-F.col("start")).alias("s"), "doc_id", "start"))
    return found.groupBy("item_id", "word").agg(best.alias("b")).select("item_id", "word", "b.length", "b.doc_id", "b.start")


def digest(found: DataFrame) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256 and contaminated, from :func:`find_matches`."""

    def run(batches):
        for batch in batches:
            spans = batch.column(1)
            n = batch.num_rows
            lengths = np.diff(spans.offsets.to_numpy())
            flat = spans.flatten()
            rows = np.repeat(np.arange(n), lengths)
            hit = covered(rows, flat.field("start").to_numpy(), flat.field("length").to_numpy(), n)
            ids: list[set] = [set() for _ in range(n)]
            for row, item in zip(rows.tolist(), flat.field("item_id").to_pylist()):
                ids[row].add(item)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(hit),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(",".join(sorted(x - {None})).encode()).hexdigest() for x in ids]),
                    pa.array(hit > 0),
                ],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    return found.select("doc_id", "matches", "match_words").mapInArrow(
        run, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Documents that hold no window of any test item, with their own columns."""
    matches, n_words = (free_name(docs.columns, name) for name in ("_matches", "_match_words"))
    found = find_matches(docs, benchmark, window, matches=matches, n_words=n_words)
    return found.where(F.size(matches) == 0).drop(matches, n_words)
