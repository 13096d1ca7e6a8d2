"""The pipeline and its stages against brute force on a small folder of tables."""

import hashlib
import random

import numpy as np
import public_tokenizers

import __spark_entry__ as entry
import corpus_pipeline
from test_llm_operators import DOCS, brute_components, brute_lines, brute_matches, language_rows, near_rows, table


def documents():
    generator = random.Random(8)
    rows = language_rows(40, 5)
    shared = [f"a line that many share, number {i}" for i in range(4)]
    rows = [(i, f"{t}\n{generator.choice(shared)}", lang) for i, t, lang in rows]
    rows += [(100 + i, t, "aa") for i, t, _ in near_rows()[:60]]
    rows += [(300, None, "aa"), (301, "", "aa"), (302, "12 34 !!", "aa"), (303, rows[3][1], "bb"), (None, rows[5][1], "aa")]
    return rows + [(400, "start " + ITEMS[0][1].upper() + " end", "aa"), (401, "  ".join(ITEMS[1][1].split()), "bb")]


ITEMS = [(1, "seven grey birds crossed the frozen lake before any of us had seen the sun"), (2, "short item here"), (3, None)]


def test_stages_match_brute_force(spark, tmp_path):
    rows = documents()
    table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)

    docs = stages["language ID"](spark, docs, str(tmp_path))
    expected = sorted(((i, t) for i, t, _ in rows if t and any(map(str.isalpha, t))), key=repr)
    assert docs.schema.simpleString() == "struct<" + ",".join(x.replace(" long", ":bigint").replace(" ", ":") for x in DOCS.split(", ")) + ">"
    assert kept(docs) == expected

    docs = stages["line dedup"](spark, docs, str(tmp_path))
    expected = sorted(((i, t) for i, _, _, t in brute_lines(expected)), key=repr)
    assert kept(docs) == expected
    assert all(r.n_chars == len(r.text) for r in docs.collect())

    docs = stages["MinHash near-dedup"](spark, docs, str(tmp_path))
    groups = brute_components(expected)
    expected = [(i, t) for i, t in expected if i is None or groups[i][1] == i]
    assert kept(docs) == expected

    docs = stages["benchmark decontamination"](spark, docs, str(tmp_path))
    hit = {m[0] for m in brute_matches(expected, ITEMS) if m[-1]}
    assert hit == {400, 401}
    expected = [(i, t) for i, t in expected if i not in hit]
    assert kept(docs) == expected

    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    final = {}
    for i, t in expected:
        ids = library.encode(t, add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        final[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == final


def test_registered():
    queries = entry.queries()
    assert queries["pipeline"] is corpus_pipeline.run
    assert {f"op{n}_" for n in range(1, 11)} <= {name.split("_")[0] + "_" for name in queries}
