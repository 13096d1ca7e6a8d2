"""MinHash near-duplicate groups with sequential Bayesian verification.

1. Texts with the same words form a class; only its smallest document goes on.
2. A signature has ``HASHES`` MinHash values, the first ``BANDS`` x ``ROWS`` of which are cut into bands;
   documents that agree in a band share a bucket. A pair at the threshold shares none with
   probability (1 - 0.75^4)^32 = 5e-6. Full signatures are made for documents that share a bucket.
3. Inside a bucket signatures are compared batch by batch. After n values with m agreeing the
   posterior of "similarity >= threshold" under a flat prior is a binomial tail; pairs whose
   posterior falls below ``MISS`` are pruned. A breadth-first walk over the survivors proposes each
   member to a few of the members that reach it, never to all of them.
4. Proposals are verified exactly on full shingle sets; verified ones merge components.
5. Two turns of this settle nearly all buckets: those in which every surviving pair was proposed are
   done. The others - many texts just below the threshold - get their shingle sets into the walk
   itself, which then verifies survivors in place and emits only links that hold, a forest. A pair
   is looked at in the first band it shares. So every surviving pair is verified exactly or lies
   inside one component, and no list of pairs grows with the square of a group.

The first turn takes a quarter of the buckets, the second all of them. Buckets above
``GROUP`` members are cut into blocks. In the first turn each block carries the
bucket's leaders along; later the members outside the bucket's largest component are compared
with every block. Nothing is capped, sampled or dropped.

Words are runs of anything but U+0020 and U+0009-U+000D, with A-Z lower-cased; shingles are
identified by 64-bit hashes, exact copies by 128 bits. A text with fewer words than a shingle
is one shingle. Null and blank texts have no shingle and no link. Rows without doc_id take no
part in links and form no group; repeated doc_ids are one document if their texts agree.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import materialize, scratch_path
from . import text as tx
from .components import connected_components

SHINGLE = 5
THRESHOLD = 75  # per cent
HASHES = 256
BANDS = 32
ROWS = 4
BATCH = 32
MISS = 1e-6
WIDTHS = (1, 8)  # proposals for a member in the first two turns
GROUP = 4096
LEADERS = 16


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE):
    """Hashes of all word shingles of a slice, with each text's bounds in them, and the class hash halves."""
    words, _, _, bounds = tx.word_hashes(data, offsets, tx.NOT_BLANK)
    n_words = np.diff(bounds)
    lengths = np.where(n_words == 0, 0, np.maximum(1, n_words - size + 1))
    at = tx.ragged(bounds[:-1], lengths)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    out = np.zeros(len(at), np.uint64)
    end = bounds[1:][owner]
    for j in range(size):
        inside = at + j < end
        out = tx.mix(out * tx.MULTIPLIER + np.where(inside, padded[at + j], np.uint64(j + 1)))
    return out, np.concatenate([[0], np.cumsum(lengths)]), words, bounds


def hash_family(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors and shifts; a smaller family is the beginning of a larger one."""
    drawn = np.random.default_rng(20240229).integers(0, 1 << 32, (n, 2), dtype=np.uint64).astype(np.uint32)
    return drawn[:, 0] | np.uint32(1), drawn[:, 1]


def signature(values: np.ndarray, family) -> np.ndarray:
    """MinHash values of one shingle set."""
    low = (values >> np.uint64(32)).astype(np.uint32)
    best = np.full(len(family[0]), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 2048):
        part = low[at : at + 2048, None] * family[0] + family[1]
        # The upper half of a product is the better mixed one.
        part ^= part >> np.uint32(15)
        part *= np.uint32(0x85EBCA6B)
        np.minimum(best, part.min(axis=0), out=best)
    return best


def profiles(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, class hash halves c1 and c2) of every row."""

    def run(batches):
        for batch in batches:
            for first, stop, data, offsets in tx.slices(batch.column(1)):
                found, bounds, words, word_bounds = shingles(data, offsets, size)
                owner = np.repeat(np.arange(stop - first), np.diff(bounds))
                order = np.lexsort((found, owner))
                fresh = np.ones(len(found), bool)
                fresh[1:] = (found[order][1:] != found[order][:-1]) | (owner[order][1:] != owner[order][:-1])
                counts = np.bincount(owner[order][fresh], minlength=stop - first)
                # The class is the word sequence: two independent hashes of it.
                halves = [sequence_hash(words, word_bounds, salt) for salt in (1, 2)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, stop - first), pa.array(counts, pa.int64())]
                    + [pa.array(h.view(np.int64)) for h in halves],
                    names=["doc_id", "n_shingles", "c1", "c2"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(tx.frugal(run), "doc_id long, n_shingles long, c1 long, c2 long")


def sequence_hash(words: np.ndarray, bounds: np.ndarray, salt: int) -> np.ndarray:
    scrambled = tx.mix(words ^ np.uint64(salt * 0x5851F42D4C957F2D & 0xFFFFFFFFFFFFFFFF))
    return tx.span_hashes(scrambled, bounds[:-1], bounds[1:])


def sketches(docs: DataFrame, size: int, hashes: int) -> DataFrame:
    """(doc_id, signature) of every document: its MinHash values as 32-bit integers in a row."""
    family = hash_family(hashes)

    def run(batches):
        for batch in batches:
            for first, stop, data, offsets in tx.slices(batch.column(1)):
                found, bounds, _, _ = shingles(data, offsets, size)
                made = [signature(found[a:b], family).tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, stop - first), pa.array(made, pa.binary())], names=["doc_id", "signature"]
                )

    return docs.select("doc_id", "text").mapInArrow(tx.frugal(run), "doc_id long, signature binary")


def band_hashes(signs: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Hashes of the bands of each signature; a band's number is part of its hash."""
    keys = signs[:, : bands * rows].reshape(len(signs), bands, rows).astype(np.uint64)
    band = np.zeros(keys.shape[:2], np.uint64)
    for j in range(rows):
        band = tx.mix(band * tx.MULTIPLIER + keys[:, :, j] + np.uint64(1))
    return tx.mix(band + np.arange(bands, dtype=np.uint64)).view(np.int64)


def band_rows(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, bands) of every document."""

    def run(batches):
        for batch in batches:
            signs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(batch.num_rows, -1)
            band = band_hashes(signs, bands, rows)
            offsets = pa.array(np.arange(len(band) + 1, dtype=np.int32) * bands)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(band.ravel()))], names=["doc_id", "bands"]
            )

    return sketches(docs, size, bands * rows).mapInArrow(tx.frugal(run), "doc_id long, bands array<long>")


def keep_table(hashes: int, batch: int, threshold: float, miss: float) -> list[int]:
    """Fewest agreeing values after each batch that leave the posterior at ``miss`` or more."""
    least = []
    for n in range(batch, hashes + 1, batch):
        tail, m = 0.0, -1
        # With a flat prior, P(J >= t | m of n) = P(Bin(n + 1, t) <= m).
        while tail < miss:
            m += 1
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        least.append(m)
    return least


def survivors(one: np.ndarray, others: np.ndarray, least: list[int], batch: int) -> np.ndarray:
    """Rows of ``others`` that sequential comparison with ``one`` does not prune."""
    live = np.arange(len(others))
    agree = np.zeros(len(others), np.int64)
    for step, need in enumerate(least):
        part = slice(step * batch, (step + 1) * batch)
        agree[live] += (others[live, part] == one[part]).sum(1)
        live = live[agree[live] >= need]
        if not len(live):
            break
    return live


def members_of(components) -> tuple[np.ndarray, list[np.ndarray]]:
    labels = np.unique(components, return_inverse=True)[1]
    order = np.argsort(labels, kind="stable")
    return labels, np.split(order, np.flatnonzero(np.diff(labels[order])) + 1)


def proposals(ids, components, signs, refuted, starts, least: list[int], batch: int, width: int):
    """Surviving pairs between the components of one group, and whether that is all of them.

    A breadth-first walk, in which members of one component are reached together; a component is proposed to
    ``width`` members at most. ``refuted`` holds, per member, the ids that verification refused; pairs of which
    neither member is in ``starts`` are not compared.
    """
    labels, members = members_of(components)
    free = np.ones(len(ids), bool)
    reached = np.zeros(len(members), bool)
    proposed = np.zeros(len(members), np.int64)
    links = []
    for root in range(len(members)):
        queue = [root] if not reached[root] else []
        reached[root] = True
        while queue:
            own = members[queue.pop()]
            free[own] = False
            for at in own:
                rest = np.flatnonzero(free if starts[at] else free & starts)
                for to in rest[survivors(signs[at], signs[rest], least, batch)] if len(rest) else rest:
                    label = labels[to]
                    if free[to] and not (refuted[at] and ids[to] in refuted[at]):
                        links.append((min(ids[at], ids[to]), max(ids[at], ids[to])))
                        proposed[label] += 1
                        if proposed[label] >= width:
                            free[members[label]] = False
                        if not reached[label]:
                            reached[label] = True
                            queue.append(label)
    return links, bool((proposed < width).all())


def exact_links(band: int, ids, components, signs, sets: list[np.ndarray], starts, least, batch, rows, threshold):
    """Links that hold between the components of one group, a forest: survivors are verified in place.

    Pairs that agree in a band before ``band`` are left to that band's bucket.
    """
    labels, members = members_of(components)
    free = np.ones(len(ids), bool)
    sizes = np.array([len(s) for s in sets])
    links = []
    for root in range(len(members)):
        queue = [root] if free[members[root][0]] else []
        free[members[root]] = False
        while queue:
            for at in members[queue.pop()]:
                rest = np.flatnonzero(free if starts[at] else free & starts)
                if not len(rest):
                    continue
                rest = rest[survivors(signs[at], signs[rest], least, batch)]
                same = (signs[rest, : band * rows] == signs[at, : band * rows]).reshape(len(rest), band, rows)
                rest = rest[~same.all(axis=2).any(axis=1)]
                if not len(rest):
                    continue
                flat = np.concatenate([sets[i] for i in rest])
                near = np.minimum(np.searchsorted(sets[at], flat), sizes[at] - 1)
                common = np.add.reduceat((sets[at][near] == flat).astype(np.int64), np.cumsum(sizes[rest]) - sizes[rest])
                for to in rest[100 * common >= threshold * (sizes[at] + sizes[rest] - common)]:
                    if free[to]:
                        links.append((min(ids[at], ids[to]), max(ids[at], ids[to])))
                        free[members[labels[to]]] = False
                        queue.append(labels[to])
    return links


COLUMNS = ["bucket", "part", "starts", "doc_id", "component", "signature"]


def walk_groups(dealt: DataFrame, last: str, decide) -> DataFrame:
    """(a, b, bucket): the links that ``decide`` gives for every (bucket, part), and buckets it has not finished.

    ``decide`` takes the bucket and the group's arrays of doc_id, component, signature, ``last`` and starts. Rows
    of a group are neighbours after the sort, so a task holds one group (and one batch) at a time.
    """

    def emit(table: pa.Table):
        bucket, part, starts, ids, components, signs, values = (c.combine_chunks() for c in table.columns)
        bucket, part = bucket.to_numpy(), part.to_numpy()
        edge = np.flatnonzero((bucket[1:] != bucket[:-1]) | (part[1:] != part[:-1])) + 1
        starts = starts.to_numpy(zero_copy_only=False)
        ids, components = ids.to_numpy(), components.to_numpy()
        signs = np.frombuffer(b"".join(signs.to_pylist()), np.uint32).reshape(len(ids), -1)
        values = values.to_pylist()
        found, open_ = [], []
        for low, high in zip([0, *edge], [*edge, len(ids)]):
            if (components[low:high] != components[low]).any():
                own = slice(low, high)
                links, done = decide(bucket[low], ids[own], components[own], signs[own], values[own], starts[own])
                found += links
                open_ += [] if done else [bucket[low]]
        found = np.array(found, np.int64).reshape(-1, 2)
        columns = [pa.concat_arrays([pa.array(found[:, k].copy()), pa.nulls(len(open_), pa.int64())]) for k in (0, 1)]
        columns.append(pa.concat_arrays([pa.nulls(len(found), pa.int64()), pa.array(open_, pa.int64())]))
        return pa.RecordBatch.from_arrays(columns, names=["a", "b", "bucket"])

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            ends = [held.column(i)[-1].as_py() for i in (0, 1)]
            same = (held.column(0).to_numpy() == ends[0]) & (held.column(1).to_numpy() == ends[1])
            cut = int(np.argmax(same))  # sorted: the last group is a suffix
            if cut:
                yield emit(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None:
            yield emit(held)

    dealt = dealt.select(*COLUMNS, last).repartition("bucket", "part").sortWithinPartitions("bucket", "part")
    return dealt.mapInArrow(tx.frugal(run), "a long, b long, bucket long").distinct()


def full_sets(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, shingles): the sorted distinct shingle hashes of every document, as 64-bit integers in a row."""

    def run(batches):
        for batch in batches:
            for first, stop, data, offsets in tx.slices(batch.column(1)):
                found, bounds, _, _ = shingles(data, offsets, size)
                blobs = [np.unique(found[a:b]).tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, stop - first), pa.array(blobs, pa.binary())], names=["doc_id", "shingles"]
                )

    return docs.select("doc_id", "text").mapInArrow(tx.frugal(run), "doc_id long, shingles binary")


def verify(pairs: DataFrame, docs: DataFrame, size: int, threshold: int) -> DataFrame:
    """(a, b, linked) of every pair, on full shingle sets."""
    ends = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()

    def compare(batches):
        for batch in batches:
            linked = []
            for one, two in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (one, two))
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * common >= threshold * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])

    made = full_sets(docs.join(ends, "doc_id", "left_semi"), size)
    one = made.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x"))
    two = made.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))
    checked = pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(compare, "a long, b long, linked boolean")
    return checked.groupBy("a", "b").agg(F.max("linked").alias("linked"))  # repeated rows of an id


def grouped(members: DataFrame, turn: int, group: int) -> DataFrame:
    """Deal buckets to tasks: add ``part`` and ``starts`` to (bucket, doc_id, component).

    A bucket up to ``group`` members is one part. A larger one is cut into blocks: in the first turn with its
    leaders in each, later with blocks of the members outside the largest component against all blocks.
    Buckets that are one component already are left out.
    """
    sizes = members.groupBy("bucket", "component").agg(F.count("*").alias("n")).groupBy("bucket").agg(
        F.sum("n").alias("size"),
        F.max("n").alias("most"),
        F.max_by("component", F.struct("n", "component")).alias("main"),
    )
    members = members.join(sizes.where("size > most"), "bucket")
    names = ["bucket", "doc_id", "component"]
    small = members.where(F.col("size") <= group).select(*names, F.lit(0).cast("long").alias("part"), F.lit(True).alias("starts"))
    large = members.where(F.col("size") > group)
    blocks = F.ceil(F.col("size") / group)
    own = F.pmod(F.xxhash64("doc_id", F.lit(turn)), blocks)
    every = F.sequence(F.lit(0).cast("long"), blocks - 1)
    if turn == 0:
        leads = F.pmod(F.xxhash64("doc_id", F.lit(-1)), F.col("size")) < LEADERS
        dealt = large.select(*names, F.explode(F.when(leads, every).otherwise(F.array(own))).alias("part"), F.lit(True).alias("starts"))
    else:
        large = large.withColumn("asks", F.col("component") != F.col("main")).withColumn(
            "sets", F.ceil((F.col("size") - F.col("most")) / group)
        )
        asking = F.pmod(F.xxhash64("doc_id", F.lit(turn)), F.col("sets"))
        asks = large.where("asks").select(
            *names, blocks.alias("blocks"), asking.alias("set"), F.explode(every).alias("block"), F.lit(True).alias("starts")
        )
        held = large.select(
            *names, blocks.alias("blocks"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("sets") - 1)).alias("set"), own.alias("block"), F.lit(False).alias("starts")
        )
        dealt = asks.unionByName(held).groupBy(*names, "blocks", "set", "block").agg(F.max("starts").alias("starts"))
        dealt = dealt.select(*names, (F.col("set") * F.col("blocks") + F.col("block")).alias("part"), "starts")
    return small.unionByName(dealt)


def link_groups(
    docs: DataFrame,
    size: int = SHINGLE,
    threshold: int = THRESHOLD,
    hashes: int = HASHES,
    bands: int = BANDS,
    rows: int = ROWS,
    miss: float = MISS,
    group: int = GROUP,
) -> DataFrame:
    """``(id, component)`` of the documents that are linked with another; ``docs`` has one row per class."""
    spark = docs.sparkSession
    path = scratch_path(spark, "near-duplicates")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{path}/{name}")
        return spark.read.parquet(f"{path}/{name}")

    buckets = stored(band_rows(docs, size, bands, rows), "bands").select("doc_id", F.explode("bands").alias("bucket"))
    # Buckets of one say nothing; finding the others moves two numbers a bucket, combined before the shuffle.
    shared = buckets.groupBy("bucket").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y")).where("x < y").select("bucket")
    buckets = stored(buckets.join(shared, "bucket", "left_semi"), "buckets")
    signed = docs.join(buckets.select("doc_id").distinct(), "doc_id", "left_semi")
    signs = stored(sketches(signed, size, hashes), "signatures")
    least = keep_table(hashes, BATCH, threshold / 100, miss)

    def proposing(width: int):
        def decide(bucket, ids, components, signs, refuted, starts):
            refuted = [set(r) if r else None for r in refuted]
            return proposals(ids, components, signs, refuted, starts, least, BATCH, width)

        return decide

    def verifying(bucket, ids, components, signs, sets, starts):
        band = int(np.flatnonzero(band_hashes(signs[:1], bands, rows)[0] == bucket)[0])
        sets = [np.frombuffer(s, np.uint64) for s in sets]
        return exact_links(band, ids, components, signs, sets, starts, least, BATCH, rows, threshold), True

    def labelled(rows: DataFrame, components: DataFrame | None) -> DataFrame:
        if components is None:
            return rows.withColumn("component", F.col("doc_id"))
        named = components.withColumnRenamed("id", "doc_id")
        return rows.join(named, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))

    def merged(links: DataFrame, components: DataFrame | None) -> DataFrame | None:
        return components if links.isEmpty() else materialize(connected_components(links, components))

    components, bad = None, spark.createDataFrame([], "a long, b long")
    for turn, width in enumerate(WIDTHS):
        # A quarter of the buckets joins most of each group.
        own = buckets.where(F.pmod("bucket", F.lit(4)) == 0) if turn == 0 else buckets
        both = bad.unionByName(bad.select(F.col("b").alias("a"), F.col("a").alias("b")))
        refuted = both.groupBy(F.col("a").alias("doc_id")).agg(F.collect_list("b").alias("refuted"))
        dealt = grouped(labelled(own, components), turn, group).join(signs, "doc_id").join(refuted, "doc_id", "left")
        walked = stored(walk_groups(dealt, "refuted", proposing(width)), f"walked-{turn}")
        checked = stored(verify(walked.where("a is not null").select("a", "b"), docs, size, threshold), f"verified-{turn}")
        components = merged(checked.where("linked").select("a", "b"), components)
        bad = checked.where("not linked").select("a", "b")
    rest = walked.where("bucket is not null").select("bucket").distinct()
    if not rest.isEmpty():
        dealt = stored(grouped(labelled(buckets.join(rest, "bucket", "left_semi"), components), turn + 1, group), "unfinished")
        sets = full_sets(docs.join(dealt.select("doc_id").distinct(), "doc_id", "left_semi"), size)
        walked = stored(walk_groups(dealt.join(signs, "doc_id").join(sets, "doc_id"), "shingles", verifying), "links")
        components = merged(walked.where("a is not null").select("a", "b"), components)
    return components if components is not None else spark.createDataFrame([], "id long, component long")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, threshold: int = THRESHOLD, **options) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, class_id, component_id and kept.

    ``class_id`` is the smallest doc_id with the same words, ``component_id`` the smallest doc_id reachable over
    links of ``threshold`` per cent or more (copies included); ``kept`` marks the component's own document.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "near-duplicate-classes")
    profiles(docs, size).write.parquet(f"{path}/profiles")
    known = spark.read.parquet(f"{path}/profiles")
    classes = known.where("n_shingles > 0 and doc_id is not null").groupBy("c1", "c2").agg(F.min("doc_id").alias("class_id"))
    classes.write.parquet(f"{path}/classes")
    classes = spark.read.parquet(f"{path}/classes")
    leaders = docs.select(F.col("doc_id").cast("long"), "text").join(
        classes.select(F.col("class_id").alias("doc_id")), "doc_id", "left_semi"
    )
    linked = link_groups(leaders, size, threshold, **options)
    classes = classes.join(linked, classes.class_id == linked.id, "left").select(
        "c1", "c2", "class_id", F.coalesce("component", "class_id").alias("component_id")
    )
    joined = known.join(classes, ["c1", "c2"], "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        own.alias("component_id"), (F.col("doc_id") == own).alias("kept"),
    )
