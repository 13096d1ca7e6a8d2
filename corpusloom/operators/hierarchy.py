"""Page hierarchy: scope below a root, order, relationships and selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import materialize
from .dedupe import last_wins


def merge_root(listing: DataFrame, root: DataFrame, key: str = "id") -> DataFrame:
    """Root record fields override the listing's fields, field by field.

    A field counts as present in the root record when its ``_has_<field>`` flag
    says so (a present null overrides), or without a flag when it is not null.
    """
    fields = [c for c in listing.columns if c != key]
    picks = []
    for name in fields:
        if name not in root.columns:
            picks.append(F.col(f"l.{name}"))
            continue
        flag = f"_has_{name}"
        present = F.col(f"r.{flag}") if flag in root.columns else F.col(f"r.{name}").isNotNull()
        picks.append(
            F.when(F.coalesce(present, F.lit(False)), F.col(f"r.{name}"))
            .otherwise(F.col(f"l.{name}"))
            .alias(name)
        )
    joined = listing.alias("l").join(root.alias("r"), F.col(f"l.{key}") == F.col(f"r.{key}"), "full_outer")
    return joined.select(F.coalesce(f"l.{key}", f"r.{key}").alias(key), *picks)


def tree_scope(pages: DataFrame, root_id: str) -> DataFrame:
    """Pages whose parent chain reaches the root, with depth and folded title lineage.

    Pointer doubling: every page knows an ancestor 1, 2, 4, ... steps up and the titles on the way; a round joins
    the pages with themselves, so the number of rounds is the logarithm of the depth. A page whose chain is broken
    finds no ancestor and leaves; a cycle apart from the root never ends, so it is given up once the steps are more
    than there are pages. Of a repeated id the row with the
    last parent and title counts.
    """
    named = pages.select("id", "parent_id", T.fold(F.coalesce("title", F.lit(""))).alias("title"))
    # A present parent comes after a missing one.
    last = F.max(F.struct(F.coalesce("parent_id", F.lit("")).alias("up"), "title")).alias("_x")
    rows = named.where("id is not null").groupBy("id").agg(last)
    parent, title = F.col("_x.up"), F.col("_x.title")
    root = F.col("id") == root_id
    nodes = rows.select(
        "id", F.when(root, F.lit("")).otherwise(parent).alias("up"), F.when(root, 0).otherwise(1).alias("steps"),
        F.when(root, F.array().cast("array<string>")).otherwise(F.array(title)).alias("lineage"),
    )
    state = materialize(nodes.where(~root & (F.col("up") != "")))
    total, reach, arrived = state.count(), 1, F.col("up") == root_id
    while reach <= total:  # beyond that, what is left goes round in a cycle
        todo = state.where(~arrived)
        if todo.isEmpty():
            break
        above = state.select(F.col("id").alias("up"), F.col("up").alias("_up"), F.col("steps").alias("_steps"), F.col("lineage").alias("_lineage"))
        # The ancestor's own titles come first; a chain that ends elsewhere finds no ancestor.
        moved = todo.join(above, "up").select(
            "id", F.col("_up").alias("up"), (F.col("steps") + F.col("_steps")).alias("steps"), F.concat("_lineage", "lineage").alias("lineage")
        )
        state = materialize(state.where(arrived).unionByName(moved))
        reach *= 2
    reached = nodes.where(root).unionByName(state.where(arrived))
    return reached.select("id", F.col("steps").alias("depth"), "lineage")


TREE_ORDER = ["depth", "lineage", "position", "id"]


def scoped_pages(pages: DataFrame, root_id: str) -> DataFrame:
    """Scoped pages with all their columns and the tree order columns."""
    return pages.withColumn("position", F.coalesce("position", F.lit(0))).join(
        tree_scope(pages, root_id), "id"
    )


def discover(pages: DataFrame, root_id: str, max_pages: int | None = None) -> DataFrame:
    """Scoped pages in tree order, optionally only the first ``max_pages``."""
    ordered = scoped_pages(pages, root_id).orderBy(*TREE_ORDER)
    return ordered if max_pages is None else ordered.limit(max(0, max_pages))


def link_targets(pages: DataFrame, base_url: str) -> DataFrame:
    """Title -> absolute address over all listed pages; the last page of a title wins."""
    named = pages.filter(
        (F.coalesce("title", F.lit("")) != "") & (F.coalesce("webui", F.lit("")) != "")
    )
    winners = last_wins(named.select("title", "webui", "seq", "id"), "title", ["seq", "id"])
    return winners.select("title", T.absolute_url(F.col("webui"), F.lit(base_url)).alias("url"))


def select_ids(df: DataFrame, ids: DataFrame | None, key: str = "id") -> DataFrame:
    """Rows of the given ids, which may repeat; None selects all, an empty id table selects nothing."""
    return df if ids is None else df.join(ids.select(key), key, "left_semi")


def unknown_ids(requested: DataFrame, known: DataFrame, key: str = "id") -> DataFrame:
    """Requested ids that do not exist, sorted."""
    return requested.select(key).distinct().join(known.select(key), key, "left_anti").orderBy(key)


def require_known(requested: DataFrame, known: DataFrame, key: str = "id") -> None:
    """Raise when a requested id does not exist: says how many and names one; :func:`unknown_ids` has all."""
    count, one = unknown_ids(requested, known, key).agg(F.count("*"), F.min(key)).first()
    if count:
        raise ValueError(f"{count} unknown ids, among them {one}")


def head(df: DataFrame, order: list[str], n: int | None, strict: bool = False) -> DataFrame:
    """First n rows in order; a strict caller refuses n below one."""
    if n is None:
        return df
    if strict and n < 1:
        raise ValueError("limit must be at least 1")
    return df.orderBy(*order).limit(max(0, n))


def relationships(pages: DataFrame) -> DataFrame:
    """Edge table (id, type, target_id) of parent and child relations inside the set.

    Kept as edges: one parent may have a large share of all pages as children.
    """
    inside = pages.select(F.col("id").alias("parent_id"))
    pairs = pages.select("id", "parent_id").join(inside, "parent_id", "left_semi")
    return pairs.select(
        F.inline(
            F.array(
                F.struct(F.col("id"), F.lit("parent").alias("type"), F.col("parent_id").alias("target_id")),
                F.struct(F.col("parent_id").alias("id"), F.lit("child").alias("type"), F.col("id").alias("target_id")),
            )
        )
    )
