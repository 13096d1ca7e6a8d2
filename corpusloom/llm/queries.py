"""Registered queries of this package, each over its whole table, and their check SQL."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_path, tune
from . import bpe, conversations, decontaminate, hardneg, langid, lattice, licenses, lines, neardup, token_counts, token_store, topk, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


ROOT = str(Path(__file__).resolve().parents[2])


def prepare(spark: SparkSession) -> None:
    """Session settings, and this repository on the import path of Python workers."""
    tune(spark)
    # Long texts: Arrow batches are bounded in rows and bytes.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = f"{ROOT}:{env.get('PYTHONPATH', '')}".rstrip(":")


def query(sql: str | None = None):
    """Register a function of ``table`` (a reader of named tables) under its own name."""

    def register(function):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            prepare(spark)
            return function(lambda name: spark.read.parquet(f"{folder}/{name}.parquet"))

        QUERIES[function.__name__] = run
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ALNUM_WORDS = f"""[w FOR w IN regexp_split_to_array({LOWER.format("coalesce(text, '')")},
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') IF w <> '']"""


@query(
    f"""WITH d AS (SELECT doc_id, {ALNUM_WORDS} AS w FROM documents),
    i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {ALNUM_WORDS} AS w FROM benchmark),
    iw AS (SELECT item_id, len(w) AS n, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS p, w FROM i WHERE len(w) > 0),
    windows AS (SELECT DISTINCT item_id, least(n, 10) AS k, array_to_string(w[p:p + least(n, 10) - 1], ' ') AS s FROM iw),
    sizes AS (SELECT DISTINCT k FROM windows),
    dw AS (SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS p, w FROM d, sizes WHERE len(w) >= k),
    ds AS (SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS s FROM dw),
    m AS (SELECT doc_id, p, k, item_id FROM ds JOIN windows USING (k, s)),
    hit AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM m) GROUP BY doc_id),
    items AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
        FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
    SELECT d.doc_id, len(w) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
        sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
    FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)"""
)
def op6_suffix_array_decontamination(table):
    return decontaminate.digest(decontaminate.find_matches(table("documents"), table("benchmark")))


@query(
    f"""WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS p FROM documents),
    k AS (SELECT *, {LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM l),
    r AS (SELECT key, min(doc_id) AS first_doc FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
    f AS (SELECT k.doc_id, p, line, first_doc IS NOT NULL AND k.doc_id <> first_doc AS gone FROM k LEFT JOIN r USING (key))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256
    FROM f GROUP BY doc_id"""
)
def op10_cuckoo_line_dedup(table):
    kept = lines.dedup_lines(table("documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


BLANK_WORDS = f"""[w FOR w IN regexp_split_to_array({LOWER.format("coalesce(text, '')")}, '[\\x20\\x09-\\x0D]+') IF w <> '']"""


@query(
    f"""WITH RECURSIVE d AS (SELECT doc_id, {BLANK_WORDS} AS w FROM documents),
    g AS (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS p FROM d WHERE len(w) > 0),
    s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS s FROM g),
    n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y USING (s) WHERE x.doc_id <> y.doc_id GROUP BY 1, 2),
    links AS MATERIALIZED (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
        WHERE 100 * k >= 75 * (x.n + y.n - k)),
    reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
    SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
    FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)"""
)
def op2_minhash_bayes_near_duplicates(table):
    return neardup.near_duplicates(table("documents")).select("doc_id", "n_shingles", "component_id", "kept")


def bpe_digest(docs: DataFrame, vocabulary: bytes) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of documents, from their ids and decoded texts."""
    sha = lambda data: hashlib.sha256(data).hexdigest()

    def summary(batches):
        for batch in batches:
            doc_id, lists, texts = (batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "ids", "text"))
            digests = [sha(v.values.to_numpy().astype("<u4").data) for v in lists]
            columns = [doc_id, pa.array([len(v.values) for v in lists], pa.int64()), pa.array(digests), pa.array([sha(t.as_buffer()) for t in texts])]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return bpe.round_trip(rows, vocabulary, summary, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"


@query()
def op5_rank_array_bpe(table):
    vocabulary = bpe.read_vocabulary(public_tokenizers.path(WORD_BPE))
    return bpe_digest(table("documents"), vocabulary)


@query()
def op9_orc_token_store(table):
    docs = table("documents")
    path = scratch_path(docs.sparkSession, "tokens")
    vocabulary = bpe.read_vocabulary(public_tokenizers.path(BYTE_BPE))
    token_store.write_tokens(docs, path, vocabulary, public_tokenizers.PATTERN)
    return token_store.checksums(token_store.read_tokens(docs.sparkSession, path))


@query(
    """WITH v AS (SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_sum([p[1] * p[2] FOR p IN list_zip(a.e, b.e)]) AS BIGINT) AS score
        FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5"""
)
def op1_pivot_table_topk(table):
    vectors = table("embeddings")
    return topk.top_k(vectors.where(F.col("vec_id") % 50 == 0), vectors)


@query()
def op8_diagonal_license_scan(table):
    return licenses.scan(table("documents"))


@query()
def op11_transducer_token_counts(table):
    vocabulary = bpe.read_vocabulary(public_tokenizers.path(BYTE_BPE))
    counted = token_counts.count_tokens(table("documents").select("doc_id", "text"), vocabulary)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


def remainder(modulus: int):
    """crc32 of the doc_id as text, modulo ``modulus``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


PIECES = "piece_bpe_32k.model"


@query()
def op3_lattice_likelihood(table):
    pieces = lattice.read_pieces(public_tokenizers.path(PIECES))
    scored = lattice.score(table("documents"), pieces, remainder(5) != 1)
    held_out = F.coalesce(remainder(5) == 1, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query()
def op4_counterfactual_toxicity(table):
    docs = table("documents")
    model = toxicity.train(toxicity.training_rows(docs, table("labels"), remainder(5) != 0))
    held_out = F.coalesce(remainder(5) == 0, F.lit(False)).alias("held_out")
    return toxicity.score(docs, model).select("doc_id", held_out, "score", "predicted")


@query()
def op7_crf_language_id(table):
    docs = table("documents")
    crf = langid.train(docs, remainder(4) != 2)
    held_out = F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out")
    return langid.predict(docs.select("doc_id", "text"), crf).select("doc_id", held_out, "lang_pred", "score")


@query(
    """WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding FROM embeddings),
    v AS (SELECT vec_id, label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM e
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
            AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
            CAST(list_sum([p[1] * p[2] FOR p IN list_zip(a.e, b.e)]) AS BIGINT) AS score
        FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)),
    p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
    n AS (SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
            row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
        FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
    SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10"""
)
def op13_clustered_hard_negatives(table):
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table("embeddings").select("vec_id", "embedding", shifted.alias("label"))
    return hardneg.hard_negatives(rows, F.col("vec_id") % 100 == 0)


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with faults planted by a checksum of their key; nulls become one space in the key."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    fault = F.crc32(key.cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(fault == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(fault == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return turns.where(fault != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy"))


def _least(*ways: str) -> str:
    return f"list_sort([{', '.join(ways)}])[1]"


def _way(state: str, cost: str, edit: str, line: str, given: str = "true") -> str:
    return f"{{'c': {state}.c + CASE WHEN {given} THEN {cost} ELSE 1000000000 END, 's': {state}.s || '{edit}', 't': {state}.t || {line}}}"


def _inserted(v: str) -> list[str]:
    """States nothing, system, user and assistant of a row of the recursion, after turns may have been inserted."""
    n, s, u, a = (f"{v}.{x}" for x in "nsua")
    new_user, new_assistant = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
    u = _least(u, *(_way(x, "2", "I", new_user) for x in (n, s, a)))
    return [n, s, u, _least(a, _way(u, "2", "I", new_assistant))]


def _row_step() -> list[str]:
    gone, own = "''", "chr(10) || f.role || ':' || f.text"
    stays = "f.t"
    user, assistant = "chr(10) || 'user:' || f.text", "chr(10) || 'assistant:' || f.text"
    role = lambda x: f"NOT f.gone AND f.role[1] = '{x}'"
    before_user = ("p.n", "p.s", "p.a")
    return [
        _way("p.n", "3", "D", gone),
        _least(_way("p.s", "3", "D", gone), _way("p.n", stays, "K", own, role("s"))),
        _least(
            _way("p.u", "3", "D", gone), *(_way(x, stays, "K", own, role("u")) for x in before_user),
            *(_way(x, f"2 + {stays}", "R", user, "NOT f.gone") for x in before_user),
        ),
        _least(_way("p.a", "3", "D", gone), _way("p.u", stays, "K", own, role("a")), _way("p.u", f"2 + {stays}", "R", assistant, "NOT f.gone")),
    ]


CRC = """list_reduce(list_concat([4294967295], flatten([[ascii(c), -1, -1, -1, -1, -1, -1, -1, -1] FOR c IN string_split({}, '')])),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END)"""
NO_WAY = "{'c': 1000000000, 's': '', 't': ''}"
STATES = ", ".join(f"{{}} AS {x}" for x in "nsua")


@query(
    f"""WITH RECURSIVE k AS (SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
    z AS (SELECT *, xor({CRC.format('k')}, 4294967295) % 20 AS z FROM k),
    d AS (SELECT conv_id, turn, coalesce(CASE WHEN z = 4 THEN 'user' ELSE role END, ' ') AS role,
            coalesce(CASE z WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END, ' ') AS text
        FROM z, range(1, 3) AS copies(copy) WHERE z <> 0 AND (copy = 1 OR z = 3)),
    r AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM d),
    o AS (SELECT *, coalesce('=' || CAST(conv_id AS VARCHAR), '') AS g, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
            right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS e FROM r),
    f AS MATERIALIZED (SELECT g, i, turn, role, text, e = '' AS blank, e <> '' AND again AS dup, e NOT IN ('', '.', '!', '?') AND NOT again AS trunc,
            e = '' OR again AS gone, CAST(e NOT IN ('.', '!', '?') AS INTEGER) AS t,
            lag(role[1]) OVER (PARTITION BY g ORDER BY i) || role[1] NOT IN ('su', 'ua', 'au') AS illegal FROM o),
    w AS (SELECT DISTINCT g, CAST(0 AS BIGINT) AS i, {STATES.format("{'c': 0, 's': '', 't': ''}", NO_WAY, NO_WAY, NO_WAY)} FROM f
        UNION ALL SELECT f.g, f.i, {STATES.format(*_row_step())}
        FROM (SELECT g, i, {STATES.format(*_inserted("w"))} FROM w) p JOIN f ON f.g = p.g AND f.i = p.i + 1),
    b AS (SELECT g, {_least("p.n", "p.a")} AS best FROM (SELECT g, i, {STATES.format(*_inserted("w"))} FROM w) p
        JOIN (SELECT g, max(i) AS i FROM f GROUP BY g) USING (g, i)),
    s AS (SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate,
            count(*) FILTER (trunc) AS truncated, count(*) FILTER (illegal) AS illegal FROM f GROUP BY g)
    SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
        coalesce(illegal, 0) AS illegal, CAST(coalesce(best.c, 0) AS BIGINT) AS cost, coalesce(best.s, '') AS audit,
        sha256(coalesce(substr(best.t, 2), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN s ON s.g = coalesce('=' || CAST(conv_id AS VARCHAR), '') LEFT JOIN b USING (g)"""
)
def op12_run_length_repair(table):
    turns = table("conversations")
    faulty = damaged(turns)
    return conversations.digest(turns, conversations.repaired(faulty, conversations.repair(faulty)))
