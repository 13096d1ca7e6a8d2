"""The training-data operators against brute force, and on odd rows."""

import hashlib
import itertools
import json
import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import bpe, decontaminate, langid, lattice, licenses, lines, neardup, queries, token_store, topk, toxicity
from corpusloom.llm.components import connected_components
from corpusloom.llm.cuckoo import CuckooFilter
from corpusloom.session import scratch_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use themselves.
EXTRA = "n_words int, score string, matches int, ids string, low int, _low int, part int, kept int, label string, _matches int, n_lines int"
VOCABULARY = list("the of and stone river light under over a cloud paper green little horse walks".split())


@pytest.fixture(autouse=True)
def _prepared(spark):
    queries.prepare(spark)


def table(spark, rows, extra=False):
    rows = [(i, t, lang, "s", None if t is None else len(t)) for i, t, lang in rows]
    if not extra:
        return spark.createDataFrame(rows, DOCS)
    more = (1, "x", 2, "y", 3, 4, 5, 6, "z", 7, 8)
    return spark.createDataFrame([r + more for r in rows], f"{DOCS}, {EXTRA}")


def odd_rows():
    long = " ".join(random.Random(1).choices(VOCABULARY, k=30_000))
    return [
        (1, None, "en"), (2, "", "en"), (3, " \t\n\x0b ", None), (4, "one", "en"), (5, long, "en"), (6, long, "en"),
        (7, "a b c d e f", "en"), (7, "a b c d e f", "en"), (None, "no id here at all", "en"), (9, "x" * 5000, None),
        (10, "Ünïcode ÇA — 日本語 🙂 licence", "fr"), (11, "!!! ... ---", "de"),
    ]


def texts(n, seed, words=VOCABULARY, low=1, high=40):
    generator = random.Random(seed)
    return [" ".join(generator.choices(words, k=generator.randint(low, high))) for _ in range(n)]


# --- top-k search ---------------------------------------------------------------------------------------------


def brute_top_k(rows, k, asks):
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    found = {}
    for q, vq in good:
        if asks(q):
            scored = [(-sum(a * b for a, b in zip(vq, v)), i) for i, v in good if i != q and len(v) == len(vq)]
            found[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return found


@pytest.mark.parametrize("blocks", [(2048, 16384), (3, 7)])
def test_top_k_matches_brute_force(spark, blocks):
    generator = random.Random(5)
    rows = [(i, [generator.uniform(-1, 1) for _ in range(6)]) for i in range(120)]
    rows += [(200 + i, rows[3][1]) for i in range(9)]  # ties
    rows += [(300, None), (301, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (302, [float("nan")] * 6), (303, [float("inf")] + [0.0] * 5), (310, [1.0, 2.0]), (320, []), (None, [0.5] * 6)]
    rows += [(330, [2.0**35] + [0.0] * 5), (331, [2.0**-100] * 6)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    got = {}
    for r in topk.top_k(df.where("vec_id % 10 = 0"), df, 5, pivots=4, query_block=blocks[0], row_block=blocks[1]).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    expected = {q: v for q, v in brute_top_k(rows, 5, lambda q: q % 10 == 0).items() if v}
    assert got == expected


def test_top_k_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(empty, empty).count() == 0


# --- near duplicates ------------------------------------------------------------------------------------------


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_components(rows):
    sets = {}
    for i, t, *_ in rows:
        if i is not None:
            sets[i] = shingle_set(t)
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 75 * len(x | y):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_rows():
    generator = random.Random(11)
    rows, n = [], 0
    words = [f"w{i}" for i in range(400)]
    for base in range(6):
        text = generator.choices(words, k=generator.randint(40, 120))
        for _ in range(25):  # a chain of edits: neighbours are near, the ends are not
            rows.append((n, " ".join(text), "en"))
            n += 1
            for _ in range(generator.randint(0, 2)):
                text[generator.randrange(len(text))] = generator.choice(words)
    passage = generator.choices(words, k=60)
    for _ in range(30):  # a shared passage that is not enough
        rows.append((n, " ".join(passage + generator.choices(words, k=generator.randint(5, 60))), "en"))
        n += 1
    passage = generator.choices(words, k=60)
    for _ in range(40):  # just below the threshold: many survivors, few or no links
        rows.append((n, " ".join(passage + generator.choices(words, k=generator.randint(11, 15))), "en"))
        n += 1
    return rows + [(i + 1000 if i is not None else None, t, lang) for i, t, lang in odd_rows()]


@pytest.mark.parametrize("group", [4096, 8])
def test_near_duplicates_match_brute_force(spark, group):
    rows = near_rows()
    found = neardup.near_duplicates(table(spark, rows, extra=True), group=group).collect()
    assert len(found) == len(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in found if r.doc_id is not None}
    assert got == brute_components(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found if r.doc_id is not None)


def test_near_duplicates_of_nothing(spark):
    assert neardup.near_duplicates(table(spark, [])).count() == 0
    assert [r.component_id for r in neardup.near_duplicates(table(spark, [(4, "alone in here", "en")])).collect()] == [4]


def test_pruning_keeps_what_may_be_similar():
    least = neardup.keep_table(256, 32, 0.75, 1e-6)
    assert least == sorted(least) and least[-1] < 0.75 * 256
    generator = np.random.default_rng(0)
    one = generator.integers(0, 1 << 32, 256, dtype=np.uint32)
    near = np.where(generator.random((500, 256)) < 0.78, one, one + np.uint32(1))
    far = np.where(generator.random((500, 256)) < 0.4, one, one + np.uint32(1))
    assert len(neardup.survivors(one, near, least, 32)) == 500
    assert len(neardup.survivors(one, far, least, 32)) == 0


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (5, 5), (None, 3)], "a long, b long")
    got = {r.id: r.component for r in connected_components(links).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 90, 90: 90}


# --- line dedup -----------------------------------------------------------------------------------------------


def brute_lines(rows):
    strip = " \t\n\x0b\x0c\r"
    holders = {}
    key = lambda line: line.strip(strip).encode().lower()
    counts = lambda line: len(line.strip(strip)) >= 10
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            if i is not None and counts(line):
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, t, *_ in rows:
        ls = (t or "").split("\n")
        kept = [x for x in ls if not (i is not None and counts(x) and len(holders[key(x)]) > 1 and i != min(holders[key(x)]))]
        out.append((i, len(ls), len(ls) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def line_rows(seed=3):
    generator = random.Random(seed)
    pool = [f"  Line number {i} of the pool\t" for i in range(30)] + ["short", "", "ÀÉ tenchars!", "line NUMBER 4 of the pool"]
    return [(i, "\n".join(generator.choices(pool, k=generator.randint(1, 8))), "en") for i in range(60)] + [(100, None, "en"), (101, "", "en"), (None, "Line number 1 of the pool", "en"), (7, "Line number 2 of the pool", "en")]


def dropped(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in df.collect()), key=repr)


def test_lines_match_brute_force(spark):
    rows = line_rows() + odd_rows()[4:6]
    assert dropped(lines.dedup_lines(table(spark, rows, extra=True))) == brute_lines(rows)
    assert lines.dedup_lines(table(spark, [])).count() == 0


def test_filters_spare_look_ups(spark):
    """From the second insert on a key that the filter does not know is taken as new without a look-up."""
    words = texts(400, 12, VOCABULARY, 12, 14)
    index = lines.insert(table(spark, [(i, t, "en") for i, t in enumerate(words[:200])]))
    keys = lines.counted(lines.postings_of(table(spark, [(i, t, "en") for i, t in enumerate(words[200:])]), lines.MIN_CHARS))
    flagged = lines.ask_filters(keys.select(lines.shard_of(index.shards), "*"), index.filters).where("filter is null")
    spared = flagged.where("segment is not null").count() / flagged.count()
    assert spared > 0.95


def test_line_index_is_incremental_and_reversible(spark):
    first, second = [r for r in line_rows() if r[0] is not None and r[0] % 2], [r for r in line_rows(8) if r[0] is not None and r[0] % 2 == 0]
    index = lines.insert(table(spark, first))
    index = lines.insert(table(spark, second), index)
    assert dropped(lines.drop_repeated(table(spark, first + second), index)) == brute_lines(first + second)
    gone = spark.createDataFrame([(i,) for i in range(0, 30)], "doc_id long")
    after = lines.delete(index, gone)
    left = [r for r in first + second if r[0] >= 30]
    assert dropped(lines.drop_repeated(table(spark, left), after)) == brute_lines(left)
    held = {(r.low, r.high) for r in after.counts.collect()}
    assert held == {(r.low, r.high) for r in lines.insert(table(spark, left)).counts.collect()}
    # The old version still answers, and what was deleted can come back.
    again = lines.insert(table(spark, [r for r in first + second if r[0] < 30]), after)
    assert dropped(lines.drop_repeated(table(spark, first + second), again)) == brute_lines(first + second)


def test_cuckoo_filter():
    generator = np.random.default_rng(2)
    low, high = (generator.integers(-(1 << 63), 1 << 63, 20_000) for _ in range(2))
    held = CuckooFilter()
    where = np.concatenate([held.insert(low[:9000], high[:9000]), held.insert(low[9000:15000], high[9000:15000])])
    held = CuckooFilter.from_bytes(held.to_bytes())
    assert held.contains(low[:15000], high[:15000]).all()
    assert held.contains(low[15000:], high[15000:]).mean() < 0.01
    held.delete(low[:10000], high[:10000], where[:10000])
    assert held.contains(low[10000:15000], high[10000:15000]).all()
    assert held.contains(low[:10000], high[:10000]).mean() < 0.01
    assert not CuckooFilter.from_bytes(None).contains(low, high).any()


# --- decontamination ------------------------------------------------------------------------------------------


def item_words(text):
    return re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())


def brute_matches(rows, items):
    out = []
    for i, t, *_ in rows:
        w, hit, ids = item_words(t), set(), set()
        for item, text in items:
            q = item_words(text)
            k = min(10, len(q))
            if not k:
                continue
            windows = {tuple(q[p : p + k]) for p in range(len(q) - k + 1)}
            for p in range(len(w) - k + 1):
                if tuple(w[p : p + k]) in windows:
                    hit.update(range(p, p + k))
                    ids.add(None if item is None else str(item))
        digest = hashlib.sha256(",".join(sorted(ids - {None})).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(ids), digest, bool(hit)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_words", [10_000, 40])
def test_decontamination_matches_brute_force(spark, block_words):
    items = [(i, t) for i, t in enumerate(texts(12, 4, VOCABULARY[:6], 1, 30))] + [(50, "Stone"), (51, None), (52, ""), (None, "river light")]
    rows = [(i, t, "en") for i, t in enumerate(texts(60, 9, VOCABULARY[:7], 1, 60))]
    rows += [(100 + (i or 90), f"before {t.upper()} after", "en") for i, t in items if t] + odd_rows()[:4] + odd_rows()[6:]
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id int, text string, matches int")
    docs = table(spark, rows, extra=True)
    found = decontaminate.digest(decontaminate.find_matches(docs, bench, block_words=block_words))
    assert sorted(map(tuple, found.collect()), key=repr) == brute_matches(rows, items)
    clean = decontaminate.remove_contaminated(docs, bench)
    assert clean.columns == docs.columns
    assert clean.count() == sum(not r[-1] for r in brute_matches(rows, items))
    assert decontaminate.digest(decontaminate.find_matches(table(spark, []), bench)).count() == 0
    nothing = bench.where("item_id < 0")
    assert decontaminate.remove_contaminated(docs, nothing).count() == len(rows)


def test_longest_matches(spark):
    docs = table(spark, [(1, "zero one two three four nine", "en"), (2, "one two three four five six", "en"), (3, "one two three four five six", "en")])
    bench = spark.createDataFrame([(7, "one two three four five seven")], "item_id int, text string")
    got = {r.word: (r.length, r.doc_id, r.start) for r in decontaminate.longest_matches(docs, bench).collect()}
    assert got[0] == (5, 2, 0) and got[1] == (4, 2, 1) and 4 not in got and 5 not in got


# --- license scan ---------------------------------------------------------------------------------------------


def test_license_scan(spark):
    rows = [
        (1, "Released under the MIT License.", "en"), (2, "Licensed under the Apache License, Version 2.0. (CC-BY-NC) cc by nc", "en"),
        (3, "redistribution and use in source and binary forms, with or without ANY modification, are permitted provided that", "en"),
        (4, "under the mit under the mit license license under the mit license", "en"), (5, "the license of mit", "en"),
    ] + [(i + 10 if i else i, t, lang) for i, t, lang in odd_rows()]
    got = {r.doc_id: r for r in licenses.scan(table(spark, rows, extra=True)).collect()}
    assert licenses.scan(table(spark, rows)).count() == len(rows)
    assert (got[1].n_words, got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels) == (5, 1, 1, 1, "mit")
    assert (got[2].n_base, got[2].first_word, got[2].last_word, got[2].base_labels) == (3, 3, 11, "apache-2,cc-by-nc")
    assert (got[3].n_base, got[3].base_labels, got[3].labels) == (0, "", "bsd") and 0.6 <= got[3].score <= 1
    assert (got[4].n_base, got[4].first_word, got[4].last_word) == (2, 3, 8)
    assert (got[5].n_base, got[5].labels, got[5].score) == (0, "", 0.0)
    for i, t, _ in rows:
        words = item_words(t)
        assert got[i].n_words == len(words)
        places = [
            p for phrase, _ in licenses.BASE_PHRASES for k in [phrase.encode().split()]
            for p in range(len(words) - len(k) + 1) if words[p : p + len(k)] == k
        ]
        assert (got[i].n_base, got[i].first_word, got[i].last_word) == (len(places), min(places, default=None), max(places, default=None))
    assert licenses.scan(table(spark, [])).count() == 0


# --- tokenizers -----------------------------------------------------------------------------------------------


def tokenizer(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name))


TOKEN_TEXTS = [
    None, "", "  ", "It's THE end<|endoftext|>of <|startoftext|>it", "İstanbul ΣΑΣ é", "word" * 200, "日本語 🙂👍🏽", "a b\x85c 1234 ½ ''s 's",
    "x y\n\n  z\t\t w ", "-" * 300 + "=" * 77, *texts(20, 6),
]


def test_bpe_matches_library(spark):
    library = tokenizer("word_bpe_49k.json")
    vocabulary = bpe.read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    rows = [(i, t, "en") for i, t in enumerate(TOKEN_TEXTS)] + [(None, "the", "en"), (1, "", "en")]
    encoded = bpe.encode(table(spark, rows, extra=True), vocabulary)
    assert "n_words" in encoded.columns and "text" not in encoded.columns
    for r in bpe.decode(encoded, vocabulary).collect():
        text = "the" if r.doc_id is None else (TOKEN_TEXTS[r.doc_id] or "")
        assert r.ids == library.encode(text, add_special_tokens=False).ids
        assert r.text == library.decode(r.ids, skip_special_tokens=False)
    assert bpe.encode(table(spark, []), vocabulary).count() == 0


def test_short_and_long_words_merge_alike():
    own = bpe.RankBpe(bpe.read_vocabulary(public_tokenizers.path("word_bpe_49k.json")))
    generator = random.Random(3)
    words = ["".join(generator.choices("abcdethinor", k=generator.randint(1, 40))) for _ in range(300)]
    assert [a.tolist() for a in own.merge_words(words)] == [own.merge_long(w.encode()).tolist() for w in words]


def test_token_store(spark):
    library = tokenizer("byte_bpe_50k.json")
    vocabulary = bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [(i * 3, t, "en") for i, t in enumerate(TOKEN_TEXTS)]
    random.Random(1).shuffle(rows)
    path = scratch_path(spark, "tokens")
    token_store.write_tokens(table(spark, rows, extra=True), path, vocabulary, public_tokenizers.PATTERN, parts=5)
    got = {r.doc_id: r for r in token_store.read_tokens(spark, path).collect()}
    start = 0
    for i, t, _ in sorted(rows):
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        assert (got[i].start, got[i].n_tokens, got[i].ids) == (start, len(ids), ids)
        start += len(ids)
    assert [r.doc_id for r in token_store.find_documents(spark, path, [9, 10]).collect()] == [9]
    plan = token_store.find_documents(spark, path, [9])._jdf.queryExecution().toString()
    assert "PushedFilters: [In(doc_id" in plan or "PushedFilters: [EqualTo(doc_id" in plan or "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id" in plan
    sums = {r.doc_id: r.ids_crc32 for r in token_store.checksums(token_store.read_tokens(spark, path)).collect()}
    import zlib

    assert sums == {i: zlib.crc32(np.array(got[i].ids, "<u4").tobytes()) for i in got}


def test_token_store_of_nothing_and_of_odd_rows(spark):
    vocabulary = bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    path = scratch_path(spark, "tokens")
    token_store.write_tokens(table(spark, []), path, vocabulary, public_tokenizers.PATTERN)
    assert token_store.read_tokens(spark, path).count() == 0
    path = scratch_path(spark, "tokens")
    token_store.write_tokens(table(spark, odd_rows()), path, vocabulary, public_tokenizers.PATTERN)
    got = token_store.read_tokens(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((r[0] for r in odd_rows()), key=lambda i: -1 if i is None else i)
    assert all(b.start == a.start + a.n_tokens for a, b in zip(got, got[1:]))


def test_long_blanks_are_encoded_by_the_library():
    own = token_store.LibraryEncoder(bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json")), public_tokenizers.PATTERN)
    library = tokenizer("byte_bpe_50k.json")
    for text in (" " * 1_000_000, "\n" * 1_000_000, "a" + " \t" * 40_000 + "b", " " * 49_999):
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_characters_that_the_library_knows_differently(spark):
    library = tokenizer("word_bpe_49k.json")
    vocabulary = bpe.read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    generator = random.Random(3)
    rows = ["a\u0558b \u058b c", "\U000107bb x", "\u2ded\u0899", "\ua7cc", "plain <|endoftext|> \u0558"]
    rows += ["".join(chr(generator.choice([generator.randint(1, 0xD7FF), generator.randint(0xE000, 0x10FFFF)])) for _ in range(40)) for _ in range(300)]
    for r in bpe.encode(table(spark, [(i, t, "en") for i, t in enumerate(rows)]), vocabulary).collect():
        assert r.ids == library.encode(rows[r.doc_id], add_special_tokens=False).ids


def test_library_path_of_the_encoder():
    blob = bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    fast = token_store.LibraryEncoder(blob, public_tokenizers.PATTERN)
    spec = json.loads(blob)
    spec["model"]["ignore_merges"] = True
    slow = token_store.LibraryEncoder(json.dumps(spec).encode(), public_tokenizers.PATTERN)
    assert fast.encode.__name__ == "_fast" and slow.encode.__name__ == "_library"
    assert fast.encode("the river <|endoftext|>").tolist() == slow.encode("the river <|endoftext|>").tolist()


# --- language model -------------------------------------------------------------------------------------------


def brute_word(word, weights, byte_weights):
    marked = lattice.MARK + word
    total = [1.0] + [0.0] * len(marked)
    for j in range(1, len(marked) + 1):
        for i in range(j):
            total[j] += total[i] * weights.get(marked[i:j], 0.0)
        total[j] += total[j - 1] * math.prod(byte_weights[b] for b in marked[j - 1].encode())
    return math.log(total[-1])


def test_lattice_sums_over_all_segmentations():
    names = [lattice.MARK, "a", "b", "ab", lattice.MARK + "a", "ba", "bab"]
    hashes = np.array([lattice.piece_hash(np.array([[ord(c) for c in n]], np.uint32))[0] for n in names])
    order = np.argsort(hashes)
    raw = np.random.default_rng(1).random(len(names) + 257)
    weights = np.log(raw / raw.sum())
    pieces = lattice.Pieces(hashes[order], np.concatenate([weights[: len(names)][order], weights[len(names) :]]), 3)
    by_name = {n: math.exp(w) for n, w in zip(names, weights)}
    bytes_ = np.exp(weights[len(names) : len(names) + 256])
    words = ["a", "ab", "abab", "bé", "z", "babab", "a" * 50]
    assert np.allclose(lattice.word_scores(words, pieces), [brute_word(w, by_name, bytes_) for w in words])
    # Expected uses are the derivatives of the log probability by the log weights.
    for rows, points in lattice.chunks(["abab"]):
        uses = lattice.Lattice(points, pieces).expected(np.ones(1))
    for at in (0, 3, 5, len(names) + ord("a")):
        moved = lattice.Pieces(pieces.hashes, pieces.weights.copy(), 3)
        moved.weights[at] += 1e-6
        slope = (lattice.word_scores(["abab"], moved) - lattice.word_scores(["abab"], pieces))[0] / 1e-6
        assert abs(slope - uses[at]) < 1e-4


@pytest.mark.parametrize("frequent", [1e-6, 0.02, 2.0])
def test_language_model_scores(spark, frequent):
    rows = [(i, t, "en") for i, t in enumerate(texts(40, 2))] + [(100 + i, t, "en") for i, t in enumerate(TOKEN_TEXTS)] + [(None, "the unseen", "en"), (3, "repeated id", "en")]
    pieces = lattice.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    learn = F.col("doc_id") % 3 != 1
    got = lattice.score(table(spark, rows, extra=True), pieces, learn, rounds=1, frequent=frequent).collect()
    split = lambda t: (t or "").encode().lower().split()
    counts = {}
    for i, t, _ in rows:
        if i is not None and i % 3 != 1:
            for w in [*split(t), None]:
                counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    expected = sorted(
        (
            (i, len(split(t)) + 1, sum(w in counts for w in [*split(t), None]), n,
             round(sum(math.log10((counts.get(w, 0) + 0.5) / (n + 0.5 * (v + 1))) for w in [*split(t), None]), 6))
            for i, t, _ in rows
        ), key=repr,
    )
    assert sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=repr) == expected
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    empties = {r.score for r in got if r.n_tokens == 1}
    assert len(empties) == 1


def test_fitting_raises_the_likelihood(spark):
    rows = [(i, t, "en") for i, t in enumerate(texts(60, 2))]
    pieces = lattice.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    docs = table(spark, rows)
    totals = [lattice.score(docs, pieces, F.lit(True), rounds=n).agg(F.sum("score")).first()[0] for n in (0, 1, 3)]
    assert totals[0] < totals[1] < totals[2]
    assert lattice.score(table(spark, []), pieces, F.lit(True)).count() == 0


# --- toxicity -------------------------------------------------------------------------------------------------


def labelled(spark, biased):
    generator = random.Random(4)
    rows, marks = [], []
    for i in range(400):
        words = generator.choices(VOCABULARY, k=20)
        toxic = i % 4 == 0
        if toxic:
            words += generator.choices(["idiot", "scum", "moron"], k=2)
        # In the sample abuse often names one group, as found text does.
        if generator.random() < (0.6 if toxic and biased else 0.05):
            words.append("muslims")
        if generator.random() < 0.1:
            words.append("christians")
        generator.shuffle(words)
        rows.append((i, " ".join(words), "en"))
        marks.append((i, 1, int(toxic)))
    return table(spark, rows), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def test_toxicity_finds_abuse_and_spares_neutral_mentions(spark):
    docs, labels = labelled(spark, biased=True)
    sample = toxicity.training_rows(docs, labels, F.lit(True))
    fair, plain = toxicity.train(sample), toxicity.train(sample, fairness=0.0)
    probe = table(spark, [(1, "the muslims walks under a green cloud", "en"), (2, "the christians walks under a green cloud", "en"), (3, "the IDIOT walks, scum!", "en"), (4, None, "en"), (5, "", "en")], extra=True)
    a, b = ({r.doc_id: r for r in toxicity.score(probe, m).collect()} for m in (fair, plain))
    assert a[3].predicted == 1 and a[1].predicted == a[2].predicted == a[4].predicted == 0
    assert abs(a[1].score - a[2].score) < abs(b[1].score - b[2].score)
    assert a[1].score < b[1].score
    assert a[4].score == a[5].score


def test_toxicity_without_labels(spark):
    docs, labels = labelled(spark, biased=False)
    model = toxicity.train(toxicity.training_rows(docs, labels.where("doc_id < 0"), F.lit(True)))
    assert toxicity.score(docs, model).where("predicted = 0").count() == 400
    assert toxicity.score(table(spark, odd_rows()), model).count() == len(odd_rows())
    assert toxicity.score(table(spark, []), model).count() == 0


# --- language ID ----------------------------------------------------------------------------------------------

ENDINGS = {"aa": ["tion", "ing", "th", "wh"], "bb": ["eux", "oi", "é", "ç"], "cc": ["ung", "ß", "sch", "ö"]}


def language_rows(n, seed):
    generator = random.Random(seed)
    rows = []
    for i in range(n):
        lang = generator.choice(list(ENDINGS))
        words = ["".join(generator.choices("aeiourst", k=3)) + generator.choice(ENDINGS[lang]) for _ in range(30)]
        rows.append((i, " ".join(words), lang))
    return rows


def test_language_id(spark):
    crf = langid.train(table(spark, language_rows(150, 1) + odd_rows()[2:3]), F.lit(True))
    assert crf.languages == ["aa", "bb", "cc"]
    held = langid.predict(table(spark, language_rows(100, 2), extra=True), crf).collect()
    assert sum(r.lang == r.lang_pred for r in held) >= 97 and all(0 <= r.score <= 1 for r in held)
    mixed = "Atauing oration sreth" + " sotung artsch rusö" * 3
    words = langid.label_words(table(spark, [(1, mixed, None), (2, None, None)]), crf).orderBy("doc_id").collect()
    assert [w.lang for w in words[0].words] == ["aa"] * 3 + ["cc"] * 9 and words[1].words == []
    odd = {r.doc_id: r.lang_pred for r in langid.predict(table(spark, odd_rows()), crf).collect()}
    assert [odd[i] for i in (1, 2, 3, 11)] == ["und"] * 4 and odd[10] != "und"
    assert langid.predict(table(spark, []), crf).count() == 0


def test_language_id_reads_the_middle_of_long_runs(spark):
    crf = langid.train(table(spark, language_rows(150, 1)), F.lit(True))
    outer, inner = "ationorationsreth" * 2, "sotungartschrusö" * 60
    texts = [(1, outer + inner + outer, None), (2, "漢字" * 500 + " x", None), (3, "a" * 33, None)]
    found = {r.doc_id: r for r in langid.predict(table(spark, texts), crf).collect()}
    assert found[1].lang_pred == "cc" and found[1].score > 0.8
    for row in langid.label_words(table(spark, texts), crf).collect():
        words = [w.word for w in row.words]
        assert "".join(words) == texts[row.doc_id - 1][1].replace(" ", "") and max(map(len, words)) <= langid.LONGEST
        if row.doc_id == 1:
            assert {w.lang for w in row.words[4:-4]} == {"cc"}


def test_language_id_without_labels(spark):
    docs = table(spark, [(1, "some words", None)])
    got = langid.predict(docs, langid.train(docs, F.lit(True))).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)]


def test_forward_backward_matches_enumeration():
    generator = np.random.default_rng(4)
    lengths = np.array([3, 1, 4])
    potentials, transitions = generator.random((8, 3)) + 0.1, generator.normal(size=(3, 3))
    starts = np.cumsum(lengths) - lengths
    marginal, expected = langid.forward_backward(potentials, transitions, starts, lengths)
    total = np.zeros((3, 3))
    for start, size in zip(starts, lengths):
        exact, mass = np.zeros((size, 3)), 0.0
        for path in itertools.product(range(3), repeat=int(size)):
            p = np.prod([potentials[start + t, y] for t, y in enumerate(path)]) * np.exp(sum(transitions[a, b] for a, b in zip(path, path[1:])))
            mass += p
            for t, y in enumerate(path):
                exact[t, y] += p
        assert np.allclose(marginal[start : start + size], exact / mass)
        pairs = np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=int(size)):
            p = np.prod([potentials[start + t, y] for t, y in enumerate(path)]) * np.exp(sum(transitions[a, b] for a, b in zip(path, path[1:])))
            for a, b in zip(path, path[1:]):
                pairs[a, b] += p
        total += pairs / mass
    assert np.allclose(expected, total)
