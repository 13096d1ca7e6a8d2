"""Hierarchy, selection and winner queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import dedupe as D
from ..operators import hierarchy as O
from . import sql as S
from .registry import Registry

reg = Registry()
QUERIES, ORACLES = reg.queries, reg.oracles

ROOT = "region-1"
WEBUI = "'/spaces/' || upper(kind) || '/pages/' || id"

SCOPE = f"""WITH RECURSIVE scope AS (
  SELECT id, 0 AS depth, []::VARCHAR[] AS lineage, position FROM {{v_tree}} WHERE id = '{ROOT}'
  UNION ALL
  SELECT t.id, s.depth + 1, list_append(s.lineage, {S.fold('t.title')}), t.position FROM {{v_tree}} t JOIN scope s ON t.parent_id = s.id WHERE t.id <> '{ROOT}')
"""


@reg.query("tree_scope", SCOPE + "SELECT id, depth FROM scope")
def tree_scope(v):
    return O.tree_scope(v.v_tree, ROOT).select("id", "depth")


@reg.query(
    "tree_order",
    SCOPE + "SELECT id, row_number() OVER (ORDER BY depth, lineage, position, id) AS sequence FROM scope",
)
def tree_order(v):
    return D.numbered(O.scoped_pages(v.v_tree, ROOT), O.TREE_ORDER).select("id", "sequence")


@reg.query("discover_limit", SCOPE + "SELECT id FROM scope ORDER BY depth, lineage, position, id LIMIT 100")
def discover_limit(v):
    return O.discover(v.v_tree, ROOT, 100).select("id")


@reg.query(
    "relationships",
    """SELECT c.id, 'parent' AS type, c.parent_id AS target_id FROM {v_tree} c JOIN {v_tree} p ON c.parent_id = p.id
       UNION ALL SELECT p.id, 'child', c.id FROM {v_tree} c JOIN {v_tree} p ON c.parent_id = p.id""",
)
def relationships(v):
    return O.relationships(v.v_tree)


@reg.query("select_pages", "SELECT id, title FROM {v_tree} WHERE id IN (SELECT 'order-' || cast(l_orderkey AS varchar) FROM {lineitem} WHERE l_returnflag = 'R')")
def select_pages(v):
    wanted = v.lineitem.filter("l_returnflag = 'R'").select(
        F.concat(F.lit("order-"), F.col("l_orderkey").cast("string")).alias("id")
    )
    return O.select_ids(v.v_tree, wanted).select("id", "title")


@reg.query("unknown_ids", "SELECT DISTINCT 'user-' || cast(user_id AS varchar) AS id FROM {events} WHERE user_id NOT IN (SELECT c_custkey FROM {customer} WHERE c_acctbal > 0)")
def unknown_ids(v):
    requested = v.v_snapshot.select(F.col("page_id").alias("id"))
    known = v.customer.filter("c_acctbal > 0").select(
        F.concat(F.lit("user-"), F.col("c_custkey").cast("string")).alias("id")
    )
    return O.unknown_ids(requested, known)


@reg.query(
    "merge_root",
    """SELECT coalesce(l.id, r.id) AS id, CASE WHEN r.id IS NOT NULL THEN r.title ELSE l.title END AS title,
         CASE WHEN r.position > 5000 THEN NULL ELSE coalesce(r.position, l.position) END AS position
       FROM (SELECT id, title, position FROM {v_tree} WHERE kind <> 'supplier') l
       FULL OUTER JOIN (SELECT id, upper(title) || '!' AS title, position FROM {v_tree} WHERE kind IN ('customer', 'supplier')) r ON l.id = r.id""",
)
def merge_root(v):
    tree = v.v_tree
    listing = tree.filter("kind <> 'supplier'").select("id", "title", "position")
    root = tree.filter("kind IN ('customer', 'supplier')").select(
        "id",
        F.concat(F.upper("title"), F.lit("!")).alias("title"),
        F.when(F.col("position") <= 5000, F.col("position")).alias("position"),
        F.lit(True).alias("_has_position"),
    )
    return O.merge_root(listing, root)


@reg.query(
    "link_targets",
    f"""SELECT title, 'https://wiki.example.com/wiki' || webui AS url FROM (
          SELECT title, {WEBUI} AS webui, row_number() OVER (PARTITION BY title ORDER BY seq DESC, id DESC) AS rn
          FROM {{v_tree}} WHERE title <> '' AND status <> 'draft') WHERE rn = 1""",
)
def link_targets(v):
    webui = F.when(F.col("status") == "draft", F.lit("")).otherwise(F.expr(WEBUI))
    return O.link_targets(v.v_tree.withColumn("webui", webui), "https://wiki.example.com")


@reg.query("last_wins", "SELECT page_id, version, status, seq FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY seq DESC) AS rn FROM {v_snapshot}) WHERE rn = 1")
def last_wins(v):
    return D.last_wins(v.v_snapshot.select("page_id", "version", "status", "seq"), "page_id", "seq")


@reg.query("first_wins", f"SELECT title, id, seq FROM (SELECT {S.fold('title')} AS title, id, seq, row_number() OVER (PARTITION BY {S.fold('title')} ORDER BY seq) AS rn FROM {{v_article}}) WHERE rn = 1")
def first_wins(v):
    folded = v.v_article.select(T.fold(F.col("title")).alias("title"), "id", "seq")
    return D.first_wins(folded, "title", "seq")


@reg.query(
    "sequence_numbers",
    """SELECT event_id AS id, row_number() OVER (ORDER BY ts, event_id) AS sequence, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS row_number FROM {events}""",
)
def sequence_numbers(v):
    events = v.events.select(F.col("event_id").alias("id"), "ts", "user_id")
    per_entry = D.numbered(events, ["ts", "id"], ["user_id"], "row_number")
    return D.numbered(per_entry, ["ts", "id"]).select("id", "sequence", "row_number")


@reg.query(
    "union_override",
    """SELECT id, url FROM (SELECT id, url, row_number() OVER (PARTITION BY id ORDER BY level DESC, seq DESC) AS rn FROM (
         SELECT id, portal_url AS url, 1 AS level, seq FROM {v_state} UNION ALL
         SELECT replace(remote_id, 'r-', 'doc-'), portal_url, 2, seq FROM {v_remote})) WHERE rn = 1""",
)
def union_override(v):
    state = v.v_state.select("id", F.col("portal_url").alias("url"), "seq")
    remote = v.v_remote.select(
        F.replace(F.col("remote_id"), F.lit("r-"), F.lit("doc-")).alias("id"),
        F.col("portal_url").alias("url"),
        "seq",
    )
    return D.union_override(state, remote, key="id", order="seq").select("id", "url")


# File names: plain ones repeat a lot, and some look like numbered copies.
@reg.query(
    "unique_names",
    """WITH names AS (SELECT 'line-' || id || '-' || cast(size_bytes AS varchar) AS id, page_id, CASE WHEN status = 'failed' THEN split_part(title, '.', 1) || '-' || cast(size_bytes // 1048576 AS varchar) || regexp_extract(title, '(\\..*)$', 1) ELSE title END AS name FROM {v_attachment}),
       ranked AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY id) AS r FROM names),
       parts AS (SELECT name, max(r) AS n, regexp_extract(name, '^(.+?)(?:\\.[^.]+)?$', 1) AS stem, regexp_extract(name, '^.+(\\.[^.]+)$', 1) AS ext FROM ranked GROUP BY name),
       free AS (SELECT name, k, row_number() OVER (PARTITION BY name ORDER BY k) + 1 AS r, stem || '-' || cast(k AS varchar) || ext AS fresh
                FROM (SELECT name, stem, ext, unnest(range(2, n + 60)) AS k FROM parts WHERE n > 1) c
                WHERE stem || '-' || cast(k AS varchar) || ext NOT IN (SELECT name FROM parts))
       SELECT ranked.id, CASE WHEN ranked.r = 1 THEN ranked.name ELSE fresh END AS unique_name FROM ranked LEFT JOIN free ON free.name = ranked.name AND free.r = ranked.r""",
)
def unique_names(v):
    size = (F.col("size_bytes") / 1048576).cast("bigint").cast("string")
    name = F.when(
        F.col("status") == "failed",
        F.concat(
            F.split_part("title", F.lit("."), F.lit(1)), F.lit("-"), size, F.regexp_extract("title", r"(\..*)$", 1)
        ),
    ).otherwise(F.col("title"))
    files = v.v_attachment.select(
        F.concat(F.lit("line-"), F.col("id"), F.lit("-"), F.col("size_bytes").cast("string")).alias("id"),
        name.alias("name"),
    )
    return D.unique_names(files, "name", ["id"]).select("id", "unique_name")


@reg.query("duplicate_state_ids", "SELECT id, count(*) AS occurrences FROM (SELECT id FROM {v_state} UNION ALL SELECT id FROM {v_state} WHERE category_id = 'cat-2') GROUP BY id HAVING count(*) > 1")
def duplicate_state_ids(v):
    first = v.v_state.select("id")
    second = v.v_state.filter("category_id = 'cat-2'").select("id")
    return D.duplicate_keys(first.unionByName(second), "id")
