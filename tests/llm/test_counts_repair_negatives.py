"""Token counts, conversation repair and hard negatives against brute force, and on odd rows."""

import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusloom.llm import conversations, hardneg, queries, token_counts
from corpusloom.llm.bpe import read_vocabulary

EXTRA = "n_bytes int, n_tokens string, key int, n string, rank int, score string, part int, want int"
MORE = (1, "x", 2, "y", 3, "z", 4, 5)


@pytest.fixture(autouse=True)
def _prepared(spark):
    queries.prepare(spark)


# --- token counts ---------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def vocabulary():
    return read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))


def counted_texts():
    generator = random.Random(7)
    mixed = "'srvelmtd aZ19 \n\t!.é日　🙂"
    return [
        None, "", "  ", "'s", "''s", " 's", "a's", "I'll've'd 'r 'v 'l 'll", "x 'r", "'re", "'r", "'l", " \n a", "\n\n  z\t\t w ", "a\x85b", "\x00",
        "<|endoftext|>", "a<|endoftext|>b <|endoftext|>", "<|endoftext", "|>", "½ ² 1234 Ⅷ", "日本語 🙂👍🏽", " " * 3000, "\n" * 3000, "a" * 5000, "é" * 700,
        *["".join(generator.choices(mixed, k=generator.randint(0, 900))) for _ in range(150)],
        *["".join(generator.choices("abcdeinorst", k=generator.randint(1, 400))) for _ in range(60)],
        " ".join("".join(generator.choices("theinroas", k=generator.randint(1, 9))) for _ in range(20_000)),
    ]


def test_token_counts_match_library(spark, library, vocabulary):
    texts = counted_texts()
    rows = [(i, t, *MORE) for i, t in enumerate(texts)] + [(None, "the end", *MORE), (3, "the end", *MORE)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, {EXTRA}")
    counted = token_counts.count_tokens(docs, vocabulary)
    assert set(counted.columns) == set(docs.columns) - {"text"}
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.key) for r in counted.collect()), key=repr)
    expected = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids), 2) for i, t, *_ in rows]
    assert got == sorted(expected, key=repr)
    assert token_counts.count_tokens(docs.where("false"), vocabulary).count() == 0


def test_counts_do_not_depend_on_the_number_of_states(library, vocabulary, monkeypatch):
    monkeypatch.setattr(token_counts, "STATES", 40)
    counter = token_counts.TokenCounter(vocabulary, token_counts.character_classes())
    texts = [t for t in counted_texts() if t][:120]
    data = "".join(texts).encode()
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    assert counter.counts(np.frombuffer(data, np.uint8), offsets).tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_chunk_maps_compose_to_the_pattern():
    classes = np.frombuffer(token_counts.character_classes(), np.uint8)
    generator = random.Random(4)
    texts = ["".join(generator.choices("'srvel a1 \n.", k=n)) for n in (0, 1, 255, 256, 257, 5000, 0, 20_000)] + [" " * 2000 + "a", "'" * 600 + "ll"]
    points = np.array([ord(c) for t in texts for c in t])
    bounds = np.cumsum([0, *map(len, texts)])
    found = token_counts.word_starts(classes[points], bounds)
    expected = [m.start() == i for t in texts for m in regex.finditer(public_tokenizers.PATTERN, t) for i in range(m.start(), m.end())]
    assert found.tolist() == expected


def test_pairs_follow_as_in_the_library(library, vocabulary):
    counter = token_counts.TokenCounter(vocabulary, token_counts.character_classes())
    merges = counter.counter.merges
    generator = random.Random(2)
    ids = [t for t, b in merges.bytes_of.items() if b.isalpha() and len(b) < 6]
    for _ in range(2000):
        a, b = generator.choice(ids), generator.choice(ids)
        text = (merges.bytes_of[a] + merges.bytes_of[b]).decode()
        assert merges.follows(a, b) == (library.encode(text, add_special_tokens=False).ids == [a, b])


# --- conversation repair --------------------------------------------------------------------------------------


def brute_repair(turns):
    """Cheapest edits of (turn, role, text) rows by a search over states, and the other columns of the summary."""
    turns = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in turns]
    turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).digest()))
    numbers = {t for t, _, _ in turns if t is not None}
    counts = {"gaps": max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, "blank": 0, "duplicate": 0, "truncated": 0}
    counts["illegal"] = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
    seen, rows = set(), []
    for _, role, text in turns:
        last = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
        fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        rows.append((role, text, fault))
    following = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    name = {"u": "user", "a": "assistant"}

    def inserted(ways):
        for _ in range(2):
            for state, (cost, audit, said) in list(ways.items()):
                for to in set(following[state]) & set("ua"):
                    new = (cost + 2, audit + "I", [*said, f"{name[to]}:"])
                    ways[to] = min(ways.get(to, new), new)
        return ways

    ways = {"": (0, "", [])}
    for role, text, fault in rows:
        after = {}
        for state, (cost, audit, said) in inserted(ways).items():
            options = [(state, (cost + 3, audit + "D", said))]
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                if role[:1] in following[state]:
                    options.append((following[state][role[:1]], (cost + extra, audit + "K", [*said, f"{role}:{text}"])))
                for to in set(following[state]) & set("ua"):
                    options.append((to, (cost + 2 + extra, audit + "R", [*said, f"{name[to]}:{text}"])))
            for to, way in options:
                after[to] = min(after.get(to, way), way)
        ways = after
    cost, audit, said = min(w for s, w in inserted(ways).items() if s in ("", "a"))
    return (*counts.values(), cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest())


def conversation_rows():
    generator = random.Random(5)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, ""]
    texts = ["Yes.", "No!", "why", "Is it?", " ", None, "", "end.\n", "x…", "Ünï.", "a b c d"]
    rows = []
    for conv in range(160):
        for _ in range(generator.randint(1, 12)):
            rows.append((conv, generator.choice([None, *range(9)]), generator.choice(roles), generator.choice(texts) if generator.random() < 0.6 else f"t{generator.randint(0, 999)}."))
    rows += [(500, i % 400, ["user", "assistant", "tool"][i // 3 % 3], f"turn {i % 350}{'.' if i % 7 else ''}") for i in range(900)]  # one long
    rows += [(600, 1, "user", "same.")] * 300 + [(600, 2, "assistant", "Sure.")]  # copies
    rows += [(700, i, "user", "again.") for i in range(300)]  # one text, repeated
    rows += [(None, i, r, x) for i, (r, x) in enumerate([("user", "hm"), ("assistant", "ok."), (None, None)])] + [(800, None, None, None)]
    return rows


@pytest.mark.parametrize("part_rows", [200_000, 9])
def test_repair_matches_brute_force(spark, part_rows):
    rows = conversation_rows()
    by_conv = {}
    for conv, *turn in rows:
        by_conv.setdefault(conv, []).append(tuple(turn))
    frame = spark.createDataFrame([(*r, *MORE) for r in rows], f"conv_id long, turn long, role string, text string, {EXTRA}").repartition(7)
    gone = spark.createDataFrame([(900, 1, "user", "all of it is gone")], "conv_id long, turn long, role string, text string")
    edits = conversations.repair(frame, part_rows)
    result = conversations.digest(frame.unionByName(gone, True), conversations.repaired(frame, edits))
    got = {r.conv_id: tuple(r)[1:] for r in result.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()}
    assert got.pop(900) == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == {c: brute_repair(t) for c, t in by_conv.items()}


def test_repair_of_nothing_and_its_messages(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversations.digest(empty, conversations.repaired(empty, conversations.repair(empty))).count() == 0
    one = spark.createDataFrame([(1, 0, "system", "Be brief."), (1, 1, "assistant", "Hello."), (1, 2, "tool", "Log.")], empty.schema)
    rows = conversations.repaired(one, conversations.repair(one)).orderBy("part", "row").collect()
    said = [(m.role, m.text) for r in rows for m in r.messages]
    assert said == [("system", "Be brief."), ("user", "Hello."), ("assistant", "Log.")] and [r.edits for r in rows] == ["K", "R", "R"]


def test_powers_are_repeated_steps():
    for symbol in range(conversations.GONE + 1):
        slow = fast = conversations.with_inserts(conversations.END)[None]
        for _ in range(37):
            slow = conversations.step(np.array([symbol]), slow)
        fast = conversations.over_run(np.array([symbol]), np.array([37]), fast.copy())
        assert (slow == fast).all()


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two! Three?") for c in range(30) for t in range(4)] + [(None, None, None, None)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted((tuple(r)[:4] for r in queries.damaged(frame).collect()), key=repr)
    expected = []
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fault == 1 else text.translate({ord(c): None for c in ".!?"}) if fault == 2 and text else text
        expected += [(conv, turn, "user" if fault == 4 else role, text)] * {0: 0, 3: 2}.get(fault, 1)
    assert got == sorted(expected, key=repr)


# --- hard negatives -------------------------------------------------------------------------------------------


def brute_negatives(rows):
    good = [
        (i, label, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, label in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for anchor, label, own in good:
        if anchor % 10:
            continue
        scored = [(-sum(a * b for a, b in zip(own, v)), i, x == label) for i, x, v in good if i != anchor and len(v) == len(own)]
        scored.sort()
        for p, positive, _ in [s for s in scored if s[2]][:3]:
            fit = [(i, -s) for s, i, same in scored if not same and 30 * -p <= -100 * s <= 90 * -p][:4]
            out += [(anchor, positive, n + 1, i, -p, s) for n, (i, s) in enumerate(fit)]
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 3])
def test_hard_negatives_match_brute_force(spark, block):
    generator = random.Random(9)
    rows = [(i, [generator.gauss(0, 1) for _ in range(5)], generator.randrange(3)) for i in range(160)]
    rows += [(200 + i, rows[4][1], i % 3) for i in range(20)]  # ties
    rows += [(400, [0.0] * 5, 1), (410, None, 1), (411, [1.0, None, 0.0, 0.0, 0.0], 1), (420, [float("nan")] * 5, 0), (430, [float("-inf")] * 5, 0), (440, [1.0] * 5, None)]
    rows += [(450, [1.0, 2.0], 0), (451, [1.0, 2.0], 0), (452, [1.0, 1.0], 1), (460, [], 0), (461, [], 0), (462, [], 1), (None, [1.0] * 5, 1)]
    rows += [(470, [2.0**22] * 5, 2), (471, [2.0**22] * 5, 2), (472, [2.0**21] * 5, 1), (473, [-(2.0**21)] * 5, 0)]
    frame = spark.createDataFrame([(*r, *MORE) for r in rows], f"vec_id long, embedding array<float>, label int, {EXTRA}").repartition(5)
    found = hardneg.hard_negatives(frame, F.col("vec_id") % 10 == 0, positives=3, negatives=4, block=block)
    assert sorted(map(tuple, found.collect())) == brute_negatives(rows)
    assert hardneg.hard_negatives(frame.where("false"), F.col("vec_id") % 10 == 0).count() == 0


def test_shared_lists_end_early():
    generator = np.random.default_rng(1)
    centres = generator.normal(size=(20, 16))
    rows = np.floor(256 * (centres[np.arange(6000) % 20] + 0.1 * generator.normal(size=(6000, 16))))
    labels = np.arange(6000) // 20 % 2
    asked = np.arange(0, 6000, 100)
    block = hardneg.Block(asked, labels[asked], [rows[a] for a in asked], [[(-np.inf, np.inf)]] * len(asked), True, 5)
    best, scored, possible = block.search([(np.arange(6000), labels, rows)])
    assert scored < 0.3 * possible
    for n, a in enumerate(asked):
        score = rows @ rows[a]
        order = [i for i in np.lexsort((np.arange(6000), -score)) if i != a and labels[i] == labels[a]][:5]
        assert best.ids[n].tolist() == order
