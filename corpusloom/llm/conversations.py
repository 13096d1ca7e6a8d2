"""Repair of conversation structure by a run-length min-plus dynamic programme.

A conversation's turns are edited so that the initials of its roles read ``(s?(ua)+)?``: Keep costs 0, Rerole to
user or assistant 2, Delete 3 (blank and duplicate turns must go), Insert an empty user or assistant turn 2, and
a truncated turn that stays adds 1. Among the cheapest edits those whose initials are ASCII-least are taken.

Turns become symbols (class of the initial, fault) and equal consecutive symbols one run. A symbol is a 4 x 4
min-plus matrix over the states of the role pattern; its powers 1, 2, 4, ... are computed once, so a run of any
length takes as many products as its length has bits. Costs run backward over the runs of all conversations of
a partition in step; then all runs are unrolled in step to the choices of each turn and each state, and the
choices are followed forward.

Turns are dealt to ranges of (conversation, turn, role, text), so a conversation may span many partitions: each
partition returns the matrix of its first and last conversation, the driver chains them (some numbers for each
partition), and a second pass returns the states in which partitions are left. Identical turns of one turn number
are counted before they are dealt, and a text that is repeated in a conversation is found by a group of its digest,
so neither needs its copies together. Only digests of texts take part; the texts of kept turns are joined at the end.

Nulls: a null role or text counts as one space, a null turn comes before all others, rows with a null conv_id are
one conversation. Rows of one conversation and turn are ordered by role and then by the MD5 of their text, by
which texts are told apart (128 bits). Empty tables give no rows; other columns are ignored.
:func:`digest` hashes a conversation's whole text, which can only be done in order: it streams through one task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..session import materialize, scratch_path

PART_ROWS = 200_000  # wanted rows of a partition; one partition is held by a task at a time
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1  # costs
MAX = np.int64(1 << 60)  # no way
TURNS = "key string, turn long, role string, digest binary, initial string, blank boolean, truncated boolean, n long"
BITS = 48

# States: nothing yet, after system, after user, after assistant. The pattern may end in the first and the last.
NEXT = np.array([2, 2, 3, 2])  # state after a user or assistant turn that is inserted or reroled
ADDED = np.array(["user", "user", "assistant", "user"])
END = np.array([0, MAX, MAX, 0])
# By class of the initial (s, u, a, other): the state after a kept turn, -1 where it may not stand.
KEPT = np.array([[1, -1, -1, -1], [2, 2, -1, 2], [-1, -1, 3, -1], [-1, -1, -1, -1]])
GONE = 8  # symbol of a turn that must go; the others are 2 * class + truncated


def with_inserts(costs: np.ndarray) -> np.ndarray:
    """Costs by state (last axis) when turns may be inserted first: two lead from any state to any that matters."""
    once = np.minimum(costs, costs[..., NEXT] + INSERT)
    return np.minimum(once, once[..., NEXT] + INSERT)


def choices(symbol: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Costs of D, I, K and R (second axis) from each state (last axis), given those after the turn; I is left open."""
    stays = np.where(symbol % 2, TRUNCATED, 0)[:, None]
    free = (symbol != GONE)[:, None]
    kept = KEPT[np.minimum(symbol // 2, 3)]
    keep = np.where(free & (kept >= 0), np.take_along_axis(after, np.maximum(kept, 0), 1) + KEEP + stays, MAX)
    rerole = np.where(free, after[:, NEXT] + REROLE + stays, MAX)
    return np.stack([after + DELETE, np.full_like(after, MAX), keep, rerole], axis=1)


def step(symbol: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Costs before a turn, by state."""
    return np.minimum(with_inserts(choices(symbol, after).min(axis=1)), MAX)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[..., :, :, None] + b[..., None, :, :]).min(axis=-2), MAX)


def powers() -> np.ndarray:
    """Matrices of 1, 2, 4, ... turns of each symbol."""
    ends = np.where(np.eye(4, dtype=bool), 0, MAX)
    one = np.stack([np.stack([step(np.array([s]), e[None])[0] for e in ends], axis=1) for s in range(GONE + 1)])
    found = [one]
    while len(found) < BITS:
        found.append(product(found[-1], found[-1]))
    return np.stack(found, axis=1)


POWERS = powers()


def over_run(symbol: np.ndarray, length: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Costs before runs of equal symbols: a product for each bit of the length."""
    for bit in range(int(length.max(initial=0)).bit_length()):
        on = (length >> bit & 1).astype(bool)
        after[on] = np.minimum((POWERS[symbol[on], bit] + after[on][:, None, :]).min(axis=2), MAX)
    return after


class Runs:
    """Symbols of several conversations, one after another, as runs that end with their conversation."""

    def __init__(self, symbol: np.ndarray, count: np.ndarray, owner: np.ndarray):
        new = np.ones(len(symbol), bool)
        new[1:] = (symbol[1:] != symbol[:-1]) | (owner[1:] != owner[:-1])
        first = np.flatnonzero(new)
        self.of = np.cumsum(new) - 1
        self.symbol, self.owner = symbol[first], owner[first]
        self.length = np.add.reduceat(count, first) if len(first) else np.zeros(0, np.int64)
        n = int(owner[-1]) + 1 if len(owner) else 0
        self.bounds = np.searchsorted(self.owner, np.arange(n + 1))

    def back(self, ends: np.ndarray) -> np.ndarray:
        """Costs after each run, given those at the end of each conversation; conversations move in step."""
        sizes = np.diff(self.bounds)
        order = np.argsort(-sizes, kind="stable")
        last, sizes = self.bounds[1:][order] - 1, sizes[order]
        after = np.zeros((len(self.symbol), 4), np.int64)
        now = ends[order].astype(np.int64)
        for t in range(int(sizes.max(initial=0))):
            n = int(np.searchsorted(-sizes, -t, "left"))
            at = last[:n] - t
            after[at] = now[:n]
            now[:n] = over_run(self.symbol[at], self.length[at], now[:n].copy())
        self.before = np.empty_like(now)
        self.before[order] = now
        return after


class Part:
    """One partition's turns in order."""

    def __init__(self, batches):
        table = pa.Table.from_batches(batches).combine_chunks()
        column = lambda name: table[name].to_numpy()
        key, role, digest = column("key"), column("role"), column("digest")
        turn = table["turn"].fill_null(0).to_numpy(), table["turn"].is_null().to_numpy()
        same = np.zeros(table.num_rows, bool)  # as the row before
        same[1:] = (key[1:] == key[:-1]) & (turn[0][1:] == turn[0][:-1]) & (turn[1][1:] == turn[1][:-1])
        same[1:] &= (role[1:] == role[:-1]) & (digest[1:] == digest[:-1])
        real = column("n") > 0  # the others stand before the first row of a text in its conversation
        self.first = same[real]
        self.table = table.filter(pa.array(real))
        self.key, self.n = key[real], column("n")[real]
        gone = column("blank")[real] | ~self.first
        kind = np.select([column("initial")[real] == c for c in "sua"], [0, 1, 2], 3)
        self.symbol = np.where(gone, GONE, 2 * kind + column("truncated")[real])
        new = np.ones(len(self.key), bool)
        new[1:] = self.key[1:] != self.key[:-1]
        self.owner = np.cumsum(new) - 1
        # A row's first copy has its symbol, further copies must go.
        more = np.stack([np.ones(len(self.n), np.int64), self.n - 1], axis=1).ravel()
        symbols = np.stack([self.symbol, np.full(len(self.n), GONE)], axis=1).ravel()
        use = more > 0
        self.rows = np.repeat(np.arange(len(self.n)), 2)[use]
        self.turns, self.counts = symbols[use], more[use]
        self.runs = Runs(self.turns, self.counts, self.owner[self.rows])
        self.conversations = int(self.owner[-1]) + 1 if len(self.owner) else 0

    def piece(self, conversation: int) -> list[int]:
        """Matrix of one conversation's turns in this partition."""
        own = self.owner[self.rows] == conversation
        runs = Runs(np.tile(self.turns[own], 4), np.tile(self.counts[own], 4), np.repeat(np.arange(4), own.sum()))
        runs.back(np.where(np.eye(4, dtype=bool), 0, MAX))
        return runs.before.T.ravel().tolist()

    def follow(self, end: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, ...]:
        """Edit, inserts before it and state before both of every row; and the states in which conversations end.

        ``end`` has the costs behind the last conversation, ``entry`` the states in which the first one is entered.
        """
        ends = np.tile(with_inserts(END), (self.conversations, 1))
        ends[-1] = end
        after = self.runs.back(ends)
        # Unroll: from a run's end backward over its groups of copies, all runs in step. Deleted copies change no state.
        costs = np.zeros((len(self.turns), 4), np.int64)
        size = np.bincount(self.runs.of, minlength=len(after))
        last = np.cumsum(size) - 1
        order = np.argsort(-size, kind="stable")
        now = after[order]
        for t in range(int(size.max(initial=0))):
            n = int(np.searchsorted(-size[order], -t, "left"))
            at = last[order[:n]] - t
            costs[at] = now[:n]
            now[:n] = over_run(self.turns[at], self.counts[at], now[:n].copy())
        head = np.flatnonzero(np.append(True, self.rows[1:] != self.rows[:-1]))  # a row's first copy
        options = choices(self.symbol, costs[head])
        before = with_inserts(options.min(axis=1))
        options[:, 1] = before[:, NEXT] + INSERT
        pick = (options == before[:, None, :]).argmax(axis=1)  # the ASCII-least of the cheapest
        kept = KEPT[np.minimum(self.symbol // 2, 3)]
        to = np.where(pick == 0, np.arange(4), np.where(pick == 2, kept, NEXT))
        inserts = np.zeros_like(pick)
        for _ in range(3):  # an insert is followed by the choice of the state it leads to
            again = pick == 1
            inserts += again
            pick, to = np.where(again, pick[:, NEXT], pick), np.where(again, to[:, NEXT], to)
        bounds = np.searchsorted(self.owner, np.arange(self.conversations + 1))
        state = np.zeros((self.conversations, entry.shape[0]), np.int64)
        state[:1] = entry
        held = np.zeros((len(self.symbol), entry.shape[0]), np.int64)
        sizes = np.diff(bounds)
        order = np.argsort(-sizes, kind="stable")
        for t in range(int(sizes.max(initial=0))):
            now = order[: int(np.searchsorted(-sizes[order], -t, "left"))]
            at = bounds[now] + t
            held[at] = state[now]
            state[now] = np.take_along_axis(to[at], state[now], 1)
        of = lambda a: np.take_along_axis(a, held, 1)
        return of(pick), of(inserts), held, state


def turns_of(conversations: DataFrame) -> DataFrame:
    """(key, turn, role, text, digest): a row for each turn; the key stands for conv_id and is never null."""
    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    text = F.coalesce(F.col("text"), F.lit(" "))
    return conversations.select(
        key.alias("key"), F.col("turn").cast("long"), F.coalesce(F.col("role"), F.lit(" ")).alias("role"), text.alias("text"),
        F.unhex(F.md5(text.cast("binary"))).alias("digest"),
    )


def ordered(turns: DataFrame, part_rows: int) -> DataFrame:
    """Counted turns without their texts, in order over ranges; before the first turn with a text a row with n = 0."""
    spark = turns.sparkSession
    last = F.substring(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    fields = [
        "key", "turn", "role", "digest", F.substring("role", 1, 1).alias("initial"), (last == "").alias("blank"),
        (~last.isin("", ".", "!", "?")).alias("truncated"),
    ]
    path = scratch_path(spark, "turns")
    turns.select(*fields).groupBy("key", "turn", "role", "digest", "initial", "blank", "truncated").agg(F.count("*").alias("n")).write.parquet(path)
    counted = spark.read.schema(TURNS).parquet(path)
    first = F.when(F.count("turn") == F.count("*"), F.min("turn"))  # a null turn is the first
    marks = counted.groupBy("key", "role", "digest", "initial", "blank", "truncated").agg(first.alias("turn")).withColumn("n", F.lit(0).cast("long"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-counted.count() // part_rows))
    order = ["key", F.col("turn").asc_nulls_first(), "role", "digest"]
    both = counted.unionByName(marks).repartitionByRange(parts, *order).sortWithinPartitions(*order, "n")
    return materialize(both)


def chained(rows: list) -> tuple[dict[int, np.ndarray], set[int]]:
    """From (part, first, last, first matrix, last matrix): costs behind each part, and parts that are entered midway."""
    behind: dict[int, np.ndarray] = {}
    entered: set[int] = set()
    later = None
    for row in sorted(rows, key=lambda r: -r.part):
        end = with_inserts(END)
        if later is not None and later.first == row.last:
            entered.add(later.part)
            matrix = np.array(later.first_matrix, np.int64).reshape(4, 4)
            whole = later.first == later.last  # the conversation goes on behind that part, or ends with it
            end = np.minimum((matrix + (behind[later.part] if whole else with_inserts(END))).min(axis=1), MAX)
        behind[row.part] = end
        later = row
    return behind, entered


def repair(conversations: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """Edits of all turns, a row for each distinct turn: key, part, row, turn, role, digest, initial, n (copies),
    is_first (of its text in the conversation), blank, truncated, edits (initials, of further copies and of turns
    inserted around it too), and the turns that result: their ``roles``, and ``kept``, the place of its own text."""
    placed = ordered(turns_of(conversations), part_rows)

    def pieces(batches):
        batches = list(batches)
        part = Part(batches) if batches else None
        if part and part.conversations:
            row = {
                "part": [TaskContext.get().partitionId()], "first": [part.key[0]], "last": [part.key[-1]],
                "first_matrix": [part.piece(0)], "last_matrix": [part.piece(part.conversations - 1)],
            }
            yield pa.RecordBatch.from_pydict(row, pa.schema([("part", pa.int32()), ("first", pa.string()), ("last", pa.string()), ("first_matrix", pa.list_(pa.int64())), ("last_matrix", pa.list_(pa.int64()))]))

    schema = "part int, first string, last string, first_matrix array<long>, last_matrix array<long>"
    found = placed.mapInArrow(pieces, schema).collect()  # a row for each partition
    behind, entered = chained(found)

    def exits(batches):
        batches, number = list(batches), TaskContext.get().partitionId()
        part = Part(batches) if batches else None
        if part and part.conversations:
            *_, state = part.follow(behind[number], np.arange(4) if number in entered else np.zeros(4, np.int64))
            yield pa.RecordBatch.from_pydict({"part": pa.array([number], pa.int32()), "states": pa.array([state[-1].tolist()], pa.list_(pa.int64()))})

    leaves = {r.part: r.states for r in placed.mapInArrow(exits, "part int, states array<long>").collect()} if entered else {}
    entry: dict[int, int] = {}
    ends: set[int] = set()  # parts whose last conversation ends there
    now, before = 0, None
    for part in sorted(r.part for r in found):
        entry[part] = now if part in entered else 0
        if before is not None and part not in entered:
            ends.add(before)
        now, before = leaves[part][entry[part]] if leaves else 0, part
    ends.add(before)

    def edits(batches):
        batches, number = list(batches), TaskContext.get().partitionId()
        part = Part(batches) if batches else None
        if part and part.conversations:
            yield from edited(part, number, behind[number], entry[number], number in ends)

    schema = "key string, part int, row int, turn long, role string, digest binary, initial string, n long, is_first boolean, blank boolean, truncated boolean, edits string, roles array<string>, kept int"
    return materialize(placed.mapInArrow(edits, schema))


def edited(part: Part, number: int, behind: np.ndarray, entry: int, ends: bool):
    """Batches of a partition's edits; ``ends`` tells whether its last conversation ends with it."""
    pick, inserts, state, left = (a[..., 0] for a in part.follow(behind, np.array([entry])))
    rows = len(pick)
    final = np.flatnonzero(np.append(part.owner[1:] != part.owner[:-1], True))
    tail = np.zeros(rows, np.int64)  # inserts behind the last turn: two after system, one after user
    tail[final] = np.array([0, 2, 1, 0])[left]
    if not ends:
        tail[-1] = 0
    texts = part.table["role"].to_pylist()
    roles, kept, strings = [], [], []
    for p, i, q, n, t, role in zip(pick.tolist(), inserts.tolist(), state.tolist(), part.n.tolist(), tail.tolist(), texts):
        made = []
        for _ in range(i):
            made.append(ADDED_LIST[q])
            q = NEXT_LIST[q]
        own = len(made) if p > 1 else None
        if p > 1:
            made.append(role if p == 2 else ADDED_LIST[q])
        if t:
            made += ["user", "assistant"][2 - t :]
        roles.append(made)
        kept.append(own)
        strings.append("I" * i + "DIKR"[p] + "D" * (n - 1) + "I" * t)
    table = part.table
    columns = {
        "key": table["key"], "part": pa.array(np.full(rows, number, np.int32)), "row": pa.array(np.arange(rows, dtype=np.int32)),
        "turn": table["turn"], "role": table["role"], "digest": table["digest"], "initial": table["initial"], "n": table["n"],
        "is_first": pa.array(part.first), "blank": table["blank"], "truncated": table["truncated"],
        "edits": pa.array(strings), "roles": pa.array(roles, pa.list_(pa.string())), "kept": pa.array(kept, pa.int32()),
    }
    yield from pa.table(columns).to_batches(10_000)


NEXT_LIST, ADDED_LIST = NEXT.tolist(), ADDED.tolist()


def repaired(conversations: DataFrame, edits: DataFrame) -> DataFrame:
    """``edits`` with ``messages``: the resulting turns (role, text) of each row, in order."""
    said = turns_of(conversations).groupBy("key", "role", "digest").agg(F.first("text").alias("text"))
    stays = edits.where("kept is not null").join(said, ["key", "role", "digest"])
    rows = stays.unionByName(edits.where("kept is null").withColumn("text", F.lit(None).cast("string")))
    messages = "transform(roles, (r, i) -> struct(r AS role, if(i <=> kept, text, '') AS text))"
    return rows.withColumn("messages", F.expr(messages)).drop("text")


LEGAL = {"su", "ua", "au"}
SUMMARY = (
    "key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)


class Summary:
    """Counts, edits and the hash of one conversation, turn by turn."""

    def __init__(self):
        self.low = self.turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.initial, self.audit, self.hash, self.lines = None, [], hashlib.sha256(), False

    def add(self, turn, initial, n, first, blank, truncated, edits, kept, lines) -> None:
        if turn is not None and turn != self.turn:
            self.low = turn if self.low is None else self.low
            self.turn, self.turns = turn, self.turns + 1
        self.illegal += n - 1 + (self.initial is not None and self.initial + initial not in LEGAL)
        self.initial = initial
        if blank:
            self.blank += n
        else:
            self.duplicate += n - 1 if first else n
            self.truncated += bool(first and truncated)
        self.cost += DELETE * edits.count("D") + INSERT * edits.count("I") + REROLE * edits.count("R") + bool(truncated and kept is not None)
        self.audit.append(edits)
        if lines is not None:
            if self.lines:
                self.hash.update(b"\n")
            self.hash.update(lines.encode())
            self.lines = True

    def row(self) -> tuple:
        gaps = 0 if self.turn is None else self.turn - self.low + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest()


def digest(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """Per conversation of ``conversations`` its counts, edits and the hash of its repaired text.

    ``rows`` comes from :func:`repaired`; conversations without rows there have zeros. Each conversation streams
    through one task, a row at a time.
    """

    def run(batches):
        key, held, out = None, None, []
        for batch in batches:
            for k, *values in zip(*(c.to_pylist() for c in batch.columns)):
                if k != key:
                    if held is not None:
                        out.append((key, *held.row()))
                    key, held = k, Summary()
                held.add(*values)
            if out:
                yield made(out)
                out = []
        if held is not None:
            yield made([(key, *held.row())])

    def made(found):
        kinds = [pa.string(), *[pa.int64()] * 6, pa.string(), pa.string()]
        names = [c.strip().split(" ")[0] for c in SUMMARY.split(",")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=names)

    lines = F.expr("if(size(messages) > 0, array_join(transform(messages, m -> m.role || ':' || m.text), '\\n'), null)")
    order = ["key", "part", "row"]
    inputs = rows.select(*order, "turn", "initial", "n", "is_first", "blank", "truncated", "edits", "kept", lines.alias("lines"))
    sorted_ = inputs.repartition("key").sortWithinPartitions(*order).drop("part", "row")
    summary = sorted_.mapInArrow(run, SUMMARY)
    every = conversations.select("conv_id").distinct()
    every = every.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")))
    zeros = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    empty = {"audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256))}
    return every.join(summary, "key", "left").withColumns(zeros | empty).drop("key")
