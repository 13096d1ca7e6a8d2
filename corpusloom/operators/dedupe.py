"""Winner selection, numbering and collision-free names.

Nothing here gathers a whole group in one task: winners are aggregates with
map-side combine, and positions come from a range partitioning that splits a hot
group over many partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import materialize


def _columns(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def _winner(df: DataFrame, keys: list[str], order: list[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    best = pick(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*").select(*df.columns)


def last_wins(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str]) -> DataFrame:
    """One row per key: the one that comes last in ``order`` (which must be total)."""
    return _winner(df, _columns(keys), _columns(order), F.max_by)


def first_wins(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str]) -> DataFrame:
    """One row per key: the one that comes first in ``order``."""
    return _winner(df, _columns(keys), _columns(order), F.min_by)


def union_override(*tables: DataFrame, key: str, order: str) -> DataFrame:
    """Union of keyed tables; a later table overrides an earlier one key by key."""
    stacked = None
    for level, table in enumerate(tables):
        leveled = table.withColumn("_level", F.lit(level))
        stacked = leveled if stacked is None else stacked.unionByName(leveled)
    return last_wins(stacked, key, ["_level", order]).drop("_level")


def numbered(
    df: DataFrame, order: Sequence[str], within: Sequence[str] = (), out: str = "sequence"
) -> DataFrame:
    """1-based position in ``order``, over everything or within groups.

    A window would sort a whole group in one task. Here rows are range
    partitioned by (group, order), so a group spans as many partitions as its
    size asks for; the position is the offset of the partition's share of the
    group plus the place inside the partition. The placement is written out once
    so that lost executors cannot change it between its two uses.
    """
    within, order = list(within), list(order)
    keys = [*within, "_part"]
    placed = materialize(
        df.repartitionByRange(*within, *order)
        .sortWithinPartitions(*within, *order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id())
    )
    shares = placed.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    # One row per group and partition; without groups, one per partition.
    before = Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = shares.select(
        *keys, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    return (
        placed.join(offsets, keys)
        .withColumn(out, F.col("_offset") + F.col("_at") - F.col("_first") + 1)
        .drop("_part", "_at", "_first", "_offset")
    )


def smallest_k(
    df: DataFrame, within: Sequence[str], order: Sequence[str], k: str, out: str = "rank"
) -> DataFrame:
    """Rows whose rank within the group is at most the row's own ``k`` column."""
    return numbered(df.filter(F.col(k) > 0), order, within, out).filter(F.col(out) <= F.col(k))


def unique_names(df: DataFrame, name: str, order: Sequence[str], out: str = "unique_name") -> DataFrame:
    """Collision-free file names: the first holder keeps a name, later ones get -2, -3, ...

    A suffix is skipped when the resulting name is somebody's own name. Names
    made from different base names cannot meet, so only those are in the way.
    """
    ranked = numbered(df, order, [name], "_rank")
    own = ranked.select(F.col(name).alias("_own")).distinct()
    parts = own.select(
        F.concat(
            F.regexp_extract("_own", r"(?s)\A(.+)-([1-9][0-9]*)((?:\.[^.]+)?)\z", 1),
            F.regexp_extract("_own", r"(?s)\A(.+)-([1-9][0-9]*)((?:\.[^.]+)?)\z", 3),
        ).alias(name),
        F.regexp_extract("_own", r"(?s)\A(.+)-([1-9][0-9]*)((?:\.[^.]+)?)\z", 2)
        .try_cast("bigint")
        .alias("_k"),
    ).filter((F.col(name) != "") & (F.col("_k") >= 2))
    repeated = ranked.filter(F.col("_rank") > 1)
    # Blocked suffixes of names that do repeat: how many free ones come before each.
    blocked = parts.join(repeated.select(name).distinct(), name, "left_semi")
    blocked = numbered(blocked, ["_k"], [name], "_i").select(
        name, (F.col("_k") - 1 - F.col("_i")).alias("_q"), F.lit(1).alias("_blocks")
    )
    touched = blocked.select(name).distinct()
    # Merging rows and blocked suffixes in order gives each row its r-th free suffix.
    merged = blocked.unionByName(
        repeated.join(touched, name, "left_semi").select(
            name, (F.col("_rank") - 1).alias("_q"), F.lit(0).alias("_blocks")
        )
    )
    shifted = (
        numbered(merged, ["_q", "_blocks"], [name], "_m")
        .filter("_blocks = 0")
        .select(name, (F.col("_q") + 1).alias("_rank"), (F.col("_m") + 1).alias("_suffix"))
    )
    named = ranked.join(shifted, [name, "_rank"], "left")
    suffix = F.coalesce("_suffix", "_rank").cast("string")
    fresh = F.concat(T.stem(F.col(name)), F.lit("-"), suffix, T.extension(F.col(name)))
    return named.withColumn(
        out, F.when(F.col("_rank") == 1, F.col(name)).otherwise(fresh)
    ).drop("_rank", "_suffix")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(key).agg(F.count("*").alias("occurrences")).filter("occurrences > 1")


def ordered_distinct(values: Column) -> Column:
    """Distinct list values, first occurrence kept in place."""
    return F.array_distinct(values)
