"""Exact top-k inner products with a pivot table.

Distances from every vector to ``PIVOTS`` pivots are computed once and travel with the vectors. By the
triangle inequality the largest difference of two such distances is a lower bound on the distance of
a query and a candidate, hence with both norms an upper bound on their inner product. In a block of
queries and a block of candidates each query takes candidates in order of their bounds and stops as
soon as the k-th exact score is above the next bound; the blocks' winners are merged by score.

Components become integers (floor of 256 times the component), so scores are exact integers: products
run in float64 where the norms prove that every partial sum stays below 2^53, else in int64 where they
prove 2^63, else in unbounded integers. Vectors that are null, or hold a null or non-finite component,
and rows without vec_id take no part; neither do queries or candidates of another length than the other
side. Rows with a query's vec_id are the query's own. Repeated rows of a candidate count once each;
of a repeated query the first vector in array order asks. Ties go to the smaller vec_id. A score beyond
64 bits raises an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

PIVOTS = 32
PIVOT_SAMPLE = 2000  # vectors looked at to choose pivots
QUERY_BLOCK = 2048
ROW_BLOCK = 16384
SLACK = 1e-9


def integer_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, vector of integral doubles) of the rows that take part."""
    good = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~F.exists(
        "embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    )
    # floor() gives a long; doubles from 2^50 on are whole already and may not fit one.
    whole = F.transform(
        "embedding",
        lambda x: F.when(F.abs(x.cast("double")) < 2.0**50, F.floor(x.cast("double") * scale).cast("double")).otherwise(
            x.cast("double") * scale
        ),
    )
    return vectors.where(good).select(F.col("vec_id").cast("long"), whole.alias("vector"))


def choose_pivots(vectors: DataFrame, pivots: int, sample: int) -> dict[int, np.ndarray]:
    """Per vector length, pivots far from one another, out of a bounded number of vectors."""
    rows = vectors.select("vector").orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    chosen = {}
    for size in {len(r[0]) for r in rows}:
        pool = [r[0] for r in rows if len(r[0]) == size]
        pool = np.array(pool, float).reshape(len(pool), size)
        picked = [0]
        gap = np.linalg.norm(pool - pool[0], axis=1)
        while len(picked) < min(pivots, len(pool)):
            picked.append(int(gap.argmax()))
            gap = np.minimum(gap, np.linalg.norm(pool - pool[picked[-1]], axis=1))
        chosen[size] = pool[picked]
    return chosen


def with_table(vectors: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Add ``table``: the norm and the distances to all pivots of the vector's length."""

    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            out = []
            for value in lists:
                x = value.values.to_numpy()
                marks = pivots.get(len(x), np.zeros((0, len(x))))
                out.append(np.concatenate([[np.linalg.norm(x)], np.linalg.norm(marks - x, axis=1)]))
            bounds = np.concatenate([[0], np.cumsum([len(o) for o in out])])
            table = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.concatenate(out) if out else np.zeros(0)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, table], names=["vec_id", "vector", "table"])

    return vectors.mapInArrow(run, "vec_id long, vector array<double>, table array<double>")


def products(query: np.ndarray, rows: np.ndarray, norm: float, norms: np.ndarray) -> np.ndarray:
    """Exact integer inner products; Cauchy-Schwarz bounds every partial sum."""
    reach = norm * (norms.max() if len(norms) else 0)
    if reach < 2.0**52:
        return (rows @ query).astype(np.int64)
    if reach < 2.0**61 and np.abs(query).max() < 2.0**62 and np.abs(rows).max() < 2.0**62:
        return rows.astype(np.int64) @ query.astype(np.int64)
    exact = [int(a) for a in query]
    return np.array([sum(a * int(b) for a, b in zip(exact, row)) for row in rows], object)


def best(query_id: int, query, table, ids, rows, tables, k: int):
    """The k best candidates of one query: scores and ids, best first."""
    bound = np.abs(tables[:, 1:] - table[1:]).max(axis=1, initial=0.0)
    top = (table[0] ** 2 + tables[:, 0] ** 2 - bound**2) / 2
    top += SLACK * (1 + table[0] ** 2 + tables[:, 0] ** 2)  # rounding of the distances
    top[ids == query_id] = -np.inf
    order = np.argsort(-top, kind="stable")
    order = order[: int((top > -np.inf).sum())]
    scores, found = np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, step = 0, max(32, 4 * k)
    while at < len(order):
        # Everything that is left is below the bound of the next one: stop when that cannot even tie.
        if len(scores) == k and top[order[at]] < scores[-1]:
            break
        part = order[at : at + step]
        scores = np.concatenate([scores, products(query, rows[part], table[0], tables[part, 0])])
        found = np.concatenate([found, ids[part]])
        keep = np.lexsort((found, -scores))[:k] if scores.dtype != object else np.array(
            sorted(range(len(found)), key=lambda i: (-scores[i], found[i]))[:k], np.int64
        )
        scores, found = scores[keep], found[keep]
        at, step = at + step, step * 2
    return scores, found


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 5, pivots: int = PIVOTS, query_block: int = QUERY_BLOCK, row_block: int = ROW_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the k largest inner products with ``vectors``.

    Both sides have vec_id and embedding. The queries are a stated set; they meet all vectors in blocks.
    """
    rows, asks = integer_vectors(vectors), integer_vectors(queries)
    asks = asks.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    marks = choose_pivots(rows, pivots, PIVOT_SAMPLE)
    n_rows, n_asks = vectors.count(), asks.count()
    row_blocks, ask_blocks = max(1, -(-n_rows // row_block)), max(1, -(-n_asks // query_block))
    size = F.size("vector")
    # Each block of queries meets each block of rows; vectors of another length never meet.
    rows = with_table(rows, marks).withColumn("rb", F.pmod(F.xxhash64("vec_id"), F.lit(row_blocks)))
    rows = rows.select("*", size.alias("d"), F.explode(F.sequence(F.lit(0), F.lit(ask_blocks - 1))).alias("qb"))
    asks = with_table(asks, marks).withColumn("qb", F.pmod(F.xxhash64("vec_id"), F.lit(ask_blocks)).cast("int"))
    asks = asks.select("*", size.alias("d"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(row_blocks - 1).cast("long"))).alias("rb"))

    def dense(column) -> np.ndarray:
        return np.stack([v.values.to_numpy() for v in column]) if len(column) else np.zeros((0, 1))

    def run(ask: pa.Table, row: pa.Table) -> pa.Table:
        asked, ranked, found, scored = [], [], [], []
        if len(ask) and len(row):
            ids, vectors_, tables = row["vec_id"].to_numpy(), dense(row["vector"]), dense(row["table"])
            for query_id, query, table in zip(ask["vec_id"].to_pylist(), dense(ask["vector"]), dense(ask["table"])):
                scores, winners = best(query_id, query, table, ids, vectors_, tables, k)
                asked += [query_id] * len(scores)
                found += winners.tolist()
                scored += [int(s) for s in scores]
        return pa.table({"query_id": pa.array(asked, pa.int64()), "vec_id": pa.array(found, pa.int64()), "score": pa.array(scored, pa.int64())})

    keys = ["rb", "qb", "d"]
    near = asks.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
