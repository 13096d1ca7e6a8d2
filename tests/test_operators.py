"""Operators on small hand-made rows: edge cases and brute-force comparisons."""

import json
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.functions import html as H
from corpusloom.functions import text as T
from corpusloom.operators import audit as A
from corpusloom.operators import buckets as B
from corpusloom.operators import dedupe as D
from corpusloom.operators import hierarchy as O
from corpusloom.operators import links as L
from corpusloom.operators import markup as M
from corpusloom.operators import packaging as P
from corpusloom.operators import reconcile as R
from corpusloom.operators import similar as N
from corpusloom.operators import validate as V
from corpusloom.session import materialize

PAGE = "id STRING, parent_id STRING, title STRING, position BIGINT"


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).collect()[0][0]


def test_tree_leaves_out_islands_and_cycles(spark):
    rows = [
        ("home", "faq", "Welcome", 0),  # a cycle through the start must end
        ("guide", "home", "Guide", 0), ("faq", "guide", "Questions", 0), ("island", None, "Elsewhere", 0),
        ("ping", "pong", "Ping", 0), ("pong", "ping", "Pong", 0), ("lost", "nowhere", "Lost", 0),
    ]
    pages = spark.createDataFrame(rows, PAGE)
    assert [r.id for r in O.discover(pages, "home").collect()] == ["home", "guide", "faq"]
    assert [r.id for r in O.discover(pages, "home", 2).collect()] == ["home", "guide"]
    assert O.discover(pages, "home", -1).count() == 0


def test_tree_takes_rounds_by_the_logarithm_of_its_depth(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(O, "materialize", lambda df: rounds.append(1) or materialize(df))
    n = 3000
    rows = [(f"p{i}", f"p{i - 1}" if i else None, f"T{i % 7}", 0) for i in range(n)]
    rows += [("x", "y", "", 0), ("y", "z", "", 0), ("z", "x", "", 0), ("p5", "gone", "A", 0)]  # a cycle apart; a repeated id
    got = {r.id: r for r in O.tree_scope(spark.createDataFrame(rows, PAGE), "p0").collect()}
    assert len(got) == n and len(rounds) < 20
    assert got["p5"].depth == 5 and got[f"p{n - 1}"].depth == n - 1 and got["p3"].lineage == ["t1", "t2", "t3"]
    assert O.tree_scope(spark.createDataFrame(rows, PAGE), "nobody").count() == 0


def test_ids_sort_as_text_and_selection_of_nothing(spark):
    pages = spark.createDataFrame([("r", None, "R", 0), ("10", "r", "x", 1), ("9", "r", "X", 1)], PAGE)
    assert [r.id for r in O.discover(pages, "r").collect()] == ["r", "10", "9"]
    assert O.select_ids(pages, None).count() == 3
    assert O.select_ids(pages, pages.limit(0).select("id")).count() == 0
    with pytest.raises(ValueError, match="nope"):
        O.require_known(spark.createDataFrame([("nope",), ("r",)], "id STRING"), pages)
    with pytest.raises(ValueError):
        O.head(pages, ["id"], 0, strict=True)


def test_numbered_with_a_hot_group(spark):
    rng = random.Random(1)
    rows = [("hot" if rng.random() < 0.5 else f"g{rng.randrange(30)}", i) for i in rng.sample(range(10_000), 3000)]
    got = D.numbered(spark.createDataFrame(rows, "g STRING, o BIGINT").repartition(7), ["o"], ["g"], "n").collect()
    groups = {}
    for g, o in sorted(rows):
        groups.setdefault(g, []).append(o)
    assert {(r.g, r.o): r.n for r in got} == {(g, o): i + 1 for g, os in groups.items() for i, o in enumerate(os)}


def test_unique_names_skip_names_in_use(spark):
    rows = [("1", "a.png"), ("2", "a.png"), ("3", "a-2.png"), ("4", "a.png"), ("5", "a-4.png"), ("6", "b"), ("7", "b")]
    got = D.unique_names(spark.createDataFrame(rows, "id STRING, name STRING"), "name", ["id"]).collect()
    assert {r.id: r.unique_name for r in got} == {
        "1": "a.png", "2": "a-3.png", "3": "a-2.png", "4": "a-5.png", "5": "a-4.png", "6": "b", "7": "b-2"
    }


def test_last_and_first_win(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("l", 1, None)], "k STRING, seq INT, v STRING")
    assert {(r.k, r.v) for r in D.last_wins(df, "k", "seq").collect()} == {("k", "b"), ("l", None)}
    assert {(r.k, r.v) for r in D.first_wins(df, "k", "seq").collect()} == {("k", "a"), ("l", None)}


@pytest.mark.parametrize(
    "value, expected",
    [("a/b/c.txt", "c.txt"), ("a/b/", "b"), (".", ""), ("..", ".."), ("/", ""), ("a/.", "a"), ("x/.hidden", ".hidden")],
)
def test_base_name(spark, value, expected):
    assert one(spark, T.base_name(F.lit(value))) == expected


def test_text_hazards(spark):
    assert one(spark, T.fold(F.concat(F.lit("Stra"), F.lit("ße")))) == "strasse"
    assert one(spark, T.unquote(F.lit("a+b%20c"))) == "a+b c"
    assert one(spark, T.unquote(F.lit("50%"))) == "50%"
    assert one(spark, T.slug(F.lit("!!!"), F.lit("7"))) == "page-7"
    assert one(spark, T.iso_text(F.lit(""))) is None
    assert one(spark, T.published_asset_name(F.lit("id"), F.lit("x.tar.gz"))) == "id.tar.gz"
    assert one(spark, T.query_param(F.lit("https://x/p?action=edit&post=12#f"), "post")) == "12"
    assert one(spark, H.normalize_newlines(F.lit("\n\na\n\n\n\nb\n"))) == "a\n\nb\n"
    page = "<html><head><title>T &amp; U</title></head><body><h1>T &amp; U</h1><p>x</p><h1>y</h1></body></html>"
    assert one(spark, H.answer_body(F.lit(page))) == "<p>x</p><h1>y</h1>"
    assert one(spark, H.clean_markup(F.lit('<p class="a">x<span style="b">y</span><a href="u" id="z">t</a></p>'))) == '<p>xy<a href="u">t</a></p>'


def record(**changes):
    base = {
        "schema_version": "1.0", "id": "x-1", "title": "T", "slug": "t", "status": "published",
        "content": {"format": "html", "body": ""}, "source": {"connector": "x", "external_id": "1"},
        "timestamps": {"ingested_at": "2026-01-01"},
    }
    base.update(changes)
    return {k: v for k, v in base.items() if v != "DROP"}


def test_validation_rules(spark):
    cases = {
        "ok": record(id="ok", source={"connector": "x", "external_id": "1", "revision": 1.0, "parent_external_id": None}),
        "no-title": record(id="no-title", title="DROP"),
        "slug": record(id="slug", slug="Not A Slug"),
        "bool": record(id="bool", source={"connector": "x", "external_id": "1", "revision": True}),
        "extra": record(id="extra", other=1),
        "dup": record(id="dup", assets=["a", "a"]),
        "rel": record(id="rel", relationships=[{"type": "parent", "target_id": "p"}, {"type": "odd", "target_id": "", "z": 1}]),
    }
    rows = [(json.dumps(c),) for c in cases.values()] + [('{"id": "twice", "id": "twice"}',), ("[1]",)]
    df = spark.createDataFrame(rows, "json STRING")
    found = {(r.object_id, r.rule, r.json_path) for r in V.violations(df, "knowledge").collect()}
    assert found == {
        ("no-title", "required", "$"), ("slug", "pattern", "$.slug"), ("bool", "type", "$.source.revision"),
        ("extra", "extra_keys", "$"), ("dup", "unique", "$.assets"), ("rel", "enum", "$.relationships[1].type"),
        ("rel", "min_length", "$.relationships[1].target_id"), ("rel", "extra_keys", "$.relationships[1]"),
        ("<unknown>", "malformed_json", "$"), ("<unknown>", "type", "$"),
    }
    valid, _ = V.split_valid(df, "knowledge")
    assert [json.loads(r.json)["id"] for r in valid.collect()] == ["ok"]
    first = {r.object_id: r for r in V.first_violations(V.violations(df, "knowledge")).collect()}
    assert first["no-title"].message == "'title' is a required property"
    with pytest.raises(ValueError, match="slug"):
        V.require_valid(df.filter(F.col("json").contains("Not A Slug")), "knowledge")


def test_asset_rules(spark):
    good = {
        "schema_version": "1.0", "id": "a", "filename": "f", "media_type": "image/png", "size_bytes": 3, "sha256": "0" * 64,
        "local_path": "p", "status": "available", "source": {"connector": "c", "external_id": "1", "container_external_id": "2", "url": ""},
    }
    bad = dict(good, id="b", size_bytes=-1, sha256="zz")
    df = spark.createDataFrame([(json.dumps(x),) for x in (good, bad)], "json STRING")
    assert {(r.object_id, r.rule) for r in V.violations(df, "asset").collect()} == {("b", "minimum"), ("b", "pattern")}


def test_markup_conversion(spark):
    body = (
        '<table><tr><td><ac:link><ri:attachment ri:filename="a.png"/><ac:link-body><ac:image><ri:attachment ri:filename="a.png"/></ac:image>pic</ac:link-body></ac:link></td></tr></table>'
        '<ac:link ac:anchor="s"><ri:page ri:content-title="Child"/><ac:plain-text-link-body><![CDATA[go]]></ac:plain-text-link-body></ac:link>'
        '<ac:structured-macro ac:name="odd"><ac:rich-text-body><p>kept</p><ac:structured-macro ac:name="inner"/></ac:rich-text-body></ac:structured-macro>'
        '<ac:structured-macro ac:name="drawio"><ac:parameter ac:name="diagramName">d</ac:parameter></ac:structured-macro>tail'
    )
    pages = spark.createDataFrame([("1", "Me", "w-1", body), ("2", "Empty", "w-2", "plain")], "id STRING, title STRING, uri_id STRING, body STRING")
    files = spark.createDataFrame(
        [("1", "x1", "a.png", "", 1, "available"), ("1", "x2", "d", "", 2, "available"), ("1", "x3", "d.png", "", 3, "available")],
        "page_id STRING, asset_id STRING, title STRING, filename STRING, seq INT, status STRING",
    )
    titles = spark.createDataFrame([("Child", "knowledge://w-9")], "title STRING, address STRING")
    got = {r.id: r for r in M.convert(pages, files, titles).collect()}
    assert got["2"].body == "plain" and got["2"].warnings == []
    assert got["1"].body == (
        '<table><tr><td><a href="asset://x1">pic</a></td></tr></table><a href="knowledge://w-9#s">go</a>'
        "<div>[Confluence macro: odd]<br/>kept</div>"
        '<div><img alt="d" src="asset://x3"/><a href="asset://x2">Download d</a></div>tail'
    )
    assert got["1"].warnings == [M.WARN_MACRO + "odd", M.WARN_MACRO + "inner"]


def test_import_plan_is_idempotent(spark):
    articles = spark.createDataFrame([("a", "sa", "Title A", "h1"), ("b", "sb", "Title B", "h2")], "id STRING, slug STRING, title STRING, html_sha256 STRING")
    remotes = spark.createDataFrame([("55", "other", " title a ", 1)], "remote_id STRING, permalink STRING, remote_title STRING, seq INT")
    state = spark.createDataFrame([], "id STRING, remote_id STRING, html_sha256 STRING")
    plan = R.import_plan(R.resolve_remote(articles, state, remotes), state)
    assert {r.id: (r.remote_id, r.action) for r in plan.collect()} == {"a": ("55", "updated"), "b": (None, "created")}
    strict = R.resolve_remote(articles, state, remotes, adopt_existing=False)
    assert strict.filter("remote_id IS NOT NULL").count() == 0
    state = spark.createDataFrame([("a", "55", "h1"), ("b", "56", "h2")], "id STRING, remote_id STRING, html_sha256 STRING")
    remotes = remotes.union(spark.createDataFrame([("56", "sb", "Title B", 2)], remotes.schema))
    again = R.import_plan(R.resolve_remote(articles, state, remotes), state)
    assert {r.action for r in again.collect()} == {"skipped"}
    forced = R.import_plan(R.resolve_remote(articles, state, remotes), state, force=True)
    assert {r.action for r in forced.collect()} == {"updated"}


def test_too_few_images_fail(spark):
    rows = [("x", f"a{i:02}", f"a{i:02}." + ("png" if i < 1 else "pdf"), i, "img" if i < 1 else "a") for i in range(53)]
    rows += [("y", f"b{i:02}", f"b{i:02}.png", 5, "img") for i in range(52)]
    df = spark.createDataFrame(rows, "article_id STRING, asset_id STRING, filename STRING, size_bytes INT, kind STRING")
    got = R.inline_smallest(df).collect()
    assert {r.placed for r in got if r.article_id == "x"} == {"failed"}
    assert sorted(r.asset_id for r in got if r.placed == "inlined") == ["b00", "b01"]


def test_member_rows_are_the_same_for_every_article(spark):
    assets = spark.createDataFrame([("q", "2"), ("q", "1")], "id STRING, asset_id STRING")
    relations = spark.createDataFrame([("p", "child", str(i)) for i in range(5)] + [("q", "child", "c"), ("q", "parent", "p")], "id STRING, type STRING, target_id STRING")
    got = sorted(tuple(r) for r in P.member_rows(assets, relations).collect())
    assert got == [("p", "child", i + 1, str(i)) for i in range(5)] + [
        ("q", "asset", 1, "1"), ("q", "asset", 2, "2"), ("q", "child", 4, "c"), ("q", "parent", 3, "p")
    ]


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for base in range(12):
        text = [rng.choice(words) for _ in range(120)]
        texts.append(text)
        for _ in range(3):
            copy = list(text)
            copy[rng.randrange(120)] = "changed"
            texts.append(copy)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = N.near_duplicates(spark.createDataFrame(rows, "id BIGINT, text STRING"), 0.8).collect()
    sets = {i: {tuple(t[j : j + 3]) for j in range(len(t) - 2)} for i, t in enumerate(texts)}
    score = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    for r in got:
        assert r.jaccard == pytest.approx(score(r.id, r.candidate_of)) and r.jaccard >= 0.8
    found = {r.id for r in got}
    expected = {b for a in sets for b in sets if a < b and score(a, b) >= 0.8}
    assert found == expected


@pytest.mark.parametrize("small", [3, 32])
def test_links_of_a_bucket_join_whole_chains(spark, small):
    # Runs of drifting copies: neighbours match, ends do not; ids in random order.
    sets = [list(range(at, at + 20)) for base in (0, 1000) for at in range(base, base + 10, 2)] + [[9000]]
    order = list(range(len(sets)))
    random.Random(2).shuffle(order)
    sets = [sets[i] for i in order]
    score = lambda a, b: len(set(a) & set(b)) / len(set(a) | set(b))
    features = spark.createDataFrame(list(enumerate(sets)), "id BIGINT, feature ARRAY<BIGINT>")
    members = spark.createDataFrame([(7, i) for i in range(len(sets))] + [(8, 0)], "bucket BIGINT, id BIGINT")

    def components(links):
        label = list(range(len(sets)))
        for a, b in links:
            label = [label[a] if x == label[b] else x for x in label]
        return {tuple(i for i, x in enumerate(label) if x == y) for y in label}

    got = N.linked_candidates(members, features, N.jaccard, 0.7, small).collect()
    assert all(r.score == pytest.approx(score(sets[r.id], sets[r.candidate_of])) and r.score >= 0.7 and r.candidate_of < r.id for r in got)
    pairs = [(a, b) for b in range(len(sets)) for a in range(b) if score(sets[a], sets[b]) >= 0.7]
    assert components((r.id, r.candidate_of) for r in got) == components(pairs) and len(components(pairs)) == 3


def test_a_bucket_of_unlike_members_takes_few_rounds(spark, monkeypatch):
    sets = [list(range(at * 20, at * 20 + 20)) for at in range(150)]
    sets += [sets[at][:-1] + [-at - 1] for at in (3, 3, 40, 149)]  # copies of three, one of them twice
    rounds, write = [], N.staged
    monkeypatch.setattr(N, "staged", lambda df, name: rounds.append(name) or write(df, name))
    features = spark.createDataFrame(list(enumerate(sets)), "id BIGINT, feature ARRAY<BIGINT>")
    members = spark.createDataFrame([(7, i) for i in range(len(sets))], "bucket BIGINT, id BIGINT")
    got = N.linked_candidates(members, features, N.jaccard, 0.7).collect()
    links = {(r.candidate_of, r.id) for r in got}
    assert {(3, 150), (3, 151), (40, 152), (149, 153)} <= links <= {(3, 150), (3, 151), (150, 151), (40, 152), (149, 153)}
    assert rounds.count("live") < 16


def test_tasks_take_the_turns_of_a_bucket_as_rounds_do(spark, monkeypatch):
    # Three classes of drifting copies, members that are unlike all others, and an id that has two sets.
    rng = random.Random(5)
    sets = [[rng.randrange(10**9) for _ in range(40)] for _ in range(120)]
    for base in (0, 50, 100):
        for i in range(30):
            sets.append([rng.randrange(10**9) if x == i else v for x, v in enumerate(sets[base if i < 15 else -1])])
    order = list(range(len(sets)))
    rng.shuffle(order)
    rows = [(at, sets[i]) for at, i in enumerate(order)] + [(7, sets[50])]
    features = spark.createDataFrame(rows, "id BIGINT, feature ARRAY<BIGINT>")
    in_buckets = [(b, at) for b in (1, 2) for at in range(len(sets)) if b == 1 or at % 3] + [(3, 5), (2, None)]
    members = spark.createDataFrame(in_buckets, "bucket BIGINT, id BIGINT")
    rounds, write = [], N.staged
    monkeypatch.setattr(N, "staged", lambda df, name: rounds.append(name) or write(df, name))
    links = lambda: sorted(map(tuple, N.linked_candidates(members, features, N.jaccard, 0.7, 8).collect()))
    in_tasks = links()
    assert rounds.count("live") == 1 and len(in_tasks) > 80
    monkeypatch.setattr(N, "TASK_MEMBERS", 0)
    assert links() == in_tasks and rounds.count("live") > 4


def test_bitmaps_leave_out_no_pair(spark):
    rng = random.Random(9)
    sets = [rng.sample(range(10**12), n) for n in (1, 3, 40, 90, 130, 700)]
    near = [s[: len(s) - len(s) // 8] + rng.sample(range(10**12), len(s) // 10) for s in sets]
    rows = list(enumerate(sets + near)) + [(99, None), (100, [])]
    sketches = spark.createDataFrame(rows, "id BIGINT, feature ARRAY<BIGINT>").mapInArrow(B.sketch, "id BIGINT, n INT, bits BINARY")
    assert {r.id: r.n for r in sketches.collect()} == {i: len(s or []) for i, s in rows}
    pairs = [(a, b) for b in range(12) for a in range(b)]
    score = lambda a, b: len(set(a) & set(b)) / len(set(a) | set(b))
    found = N._possible(spark.createDataFrame(pairs, "low BIGINT, high BIGINT"), sketches, 0.7, "bigint")
    assert {tuple(r) for r in found.collect()} == {p for p in pairs if score(rows[p[0]][1], rows[p[1]][1]) >= 0.7} != set()


def test_exact_copies_are_candidates_of_their_first(spark):
    rows = [(3, "one text"), (1, "one text"), (2, "other words here now"), (4, None), (5, None), (6, "one text")]
    got = N.near_duplicates(spark.createDataFrame(rows, "id BIGINT, text STRING")).collect()
    assert sorted((r.id, r.candidate_of, r.jaccard) for r in got) == [(3, 1, 1.0), (6, 1, 1.0)]


def test_near_duplicates_drop_the_shuffles_of_each_step(spark, monkeypatch):
    key, write, seen = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", N.staged, []
    monkeypatch.setattr(N, "staged", lambda df, name: seen.append(df.sparkSession.conf.get(key)) or write(df, name))
    before = spark.conf.get(key, None)
    assert N.near_duplicates(spark.createDataFrame([(1, "a b c d"), (2, "e f g h")], "id BIGINT, text STRING")).count() == 0
    assert seen and set(seen) == {"true"} and spark.conf.get(key, None) == before


def test_text_of_many_adjacent_tags(spark):
    html = F.lit("<td>a</td>" + "<td></td>" * 50_000 + " <b> b</b>")
    assert one(spark, H.tag_text(html)) == "a b"


def test_unquoted_attributes_survive_cleaning(spark):
    assert one(spark, H.clean_markup(F.lit("<p class=x><a href=u id=1>t</a></p>"))) == "<p><a href=u>t</a></p>"


def test_redaction_comes_before_the_cut(spark):
    assert one(spark, T.redact(F.lit("key secret123 end"), ["secret123"], 12)) == "key <redacte"


def test_articles_that_cannot_be_fetched_are_a_problem(spark):
    articles = spark.createDataFrame([("a", "1", "T"), ("b", "2", "T"), ("c", None, "T")], "id STRING, remote_id STRING, title STRING")
    remotes = spark.createDataFrame([("1", "1", "k", "T", "Draft", "")], "remote_id STRING, fetched_id STRING, category_id STRING, remote_title STRING, status STRING, answer STRING")
    assert sorted(map(tuple, A.verify_problems(articles, remotes, "k", "Draft").collect())) == [("b", "remote missing"), ("c", "remote missing")]


GOOD_MANIFEST = {
    "schema_version": "1.0", "publisher": "p", "generated_at": "t", "source_connector": "c", "article_count": 0,
    "asset_count": 1, "articles": [], "issues": [],
    "assets": [{"id": "a", "path": "p", "sha256": "0" * 64, "size_bytes": "SIZE"}],
}


@pytest.mark.parametrize("size, valid", [("12", True), ("1e2", True), ('"12"', False), ("1.5", False), ("true", False), ("-1", False)])
def test_gate_and_report_agree_on_items(spark, size, valid):
    text = json.dumps(GOOD_MANIFEST).replace('"SIZE"', size)
    df = spark.createDataFrame([(text,)], "json STRING")
    accepted = V.flagged(df, "publisher-manifest").collect()[0].is_valid
    assert accepted == (V.violations(df, "publisher-manifest").count() == 0) == valid


def test_first_violation_is_per_record(spark):
    df = spark.createDataFrame([(i, "{}") for i in range(3)], "row INT, json STRING")
    assert V.first_violations(V.violations(df, "knowledge", key="row"), "row").count() == 3


def test_lookups_of_known_ids_gather_none(spark):
    edges = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), ("c", None)], "id STRING, target_id STRING")
    known = spark.createDataFrame([("x",), ("x",), (None,)], "id STRING")
    lost, kept = A.missing_targets(edges, known, "target_id"), O.select_ids(known, known)
    assert sorted(r.id for r in lost.collect()) == ["a", "c"] and [r.id for r in kept.collect()] == ["x", "x"]
    for table in (lost, kept):  # an aggregate of all ids takes a task's memory before the join
        assert "Aggregate" not in table._jdf.queryExecution().optimizedPlan().toString()


def test_records_told_by_shape_break_no_rule(spark):
    good = {
        "schema_version": "1.0", "id": "a", "title": "T", "slug": "t-1", "status": "draft", "content": {"format": "html", "body": ""},
        "source": {"connector": "c", "external_id": "1", "revision": None}, "timestamps": {"ingested_at": "x"},
        "taxonomy": {"tags": []}, "extensions": {"c": {"n": {"deep": [1]}}},
    }
    odd = [
        {"slug": "No"}, {"status": "x"}, {"title": ""}, {"title": None}, {"id": 7}, {"extra: STRING, id": "x"}, {"zz": 1}, {"extensions": []},
        {"content": {"format": "html"}}, {"content": {"format": "html", "body": "", "a": 1}}, {"taxonomy": {"tags": [None]}}, {"taxonomy": {"tags": ["", ""]}},
        {"source": {"connector": "c", "external_id": "1", "extensions": {"c": 1}}}, {"source": None}, {"assets": {}}, {"schema_version": 1.0},
    ]
    fine = [{}, {"taxonomy": {"tags": ["a"]}}, {"extensions": {"a>, b": 1.5}}, {"source": {"connector": "c", "external_id": "1", "revision": 5}}]
    rows = [(True, json.dumps(good | x)) for x in fine] + [(False, json.dumps(good | x)) for x in odd]
    rows += [(False, json.dumps({k: x for k, x in good.items() if k != key})) for key in ("id", "slug", "source", "timestamps")]
    df = spark.createDataFrame(rows, "good BOOLEAN, json STRING")
    sure = F.coalesce(V._surely_valid(F.try_parse_json("json"), "knowledge"), F.lit(False)).alias("sure")
    got = V.flagged(df, "knowledge").select("good", "is_valid", "json", sure).collect()
    assert all(r.good == r.is_valid and r.is_valid >= r.sure for r in got), [r for r in got if r.good != r.is_valid or r.is_valid < r.sure]
    assert {json.loads(r.json) == good for r in got if r.sure} == {True, False} and sum(r.sure for r in got) == 2


def test_similar_vectors_against_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((40, 16))
    rows = np.concatenate([base, base[:15] + 1.5 * rng.standard_normal((15, 16)), np.repeat(base[:1], 12, axis=0), np.zeros((1, 16))])
    ids = [f"v{i:03d}" for i in range(len(rows))]
    table = spark.createDataFrame([(i, r.tolist()) for i, r in zip(ids, rows)] + [("null", None)], "id STRING, feature ARRAY<FLOAT>")
    single = rows[:-1].astype("float32").astype(float)
    unit = single / np.linalg.norm(single, axis=1, keepdims=True)
    score = np.round(unit @ unit.T, 12)
    expected = []
    for i, near in enumerate(score):
        order = sorted((-x, ids[j]) for j, x in enumerate(near) if j != i and x >= 0.4)
        expected += [(ids[i], other, -x, at + 1, len(order)) for at, (x, other) in enumerate(order[:5])]
    got = N.similar_vectors(table, 16, 0.4, k=5, block=9).collect()
    assert sorted((r.id, r.candidate_of, r.rank, r.n_similar) for r in got) == sorted((a, b, d, e) for a, b, _, d, e in expected)
    assert {(r.id, r.candidate_of): r.cosine for r in got} == pytest.approx({(a, b): c for a, b, c, _, _ in expected})


def test_similar_vectors_at_the_threshold_and_tasks_by_blocks(spark, monkeypatch):
    rng = np.random.default_rng(6)
    axis, other = np.eye(8)[:2]
    # Cosines of 0.4 with the first row, give or take far less than single precision tells; then ties and a crowd.
    odd = [0.4 * axis + np.sqrt(1 - 0.16) * other, (0.4 + 1e-9) * axis + other * np.sqrt(1 - (0.4 + 1e-9) ** 2), (0.4 - 1e-9) * axis + other * np.sqrt(1 - (0.4 - 1e-9) ** 2)]
    rows = np.concatenate([[axis], odd, np.repeat(rng.standard_normal((2, 8)), 30, axis=0), 1e-30 * rng.standard_normal((17, 8))])
    table = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "id LONG, feature ARRAY<DOUBLE>")
    unit = rows / np.abs(rows).max(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    score = np.round(unit @ unit.T, 12)
    expected = set()
    for i, near in enumerate(score):
        order = sorted((-x, j) for j, x in enumerate(near) if j != i and x >= 0.4)
        expected |= {(i, j, at + 1, len(order)) for at, (_, j) in enumerate(order[:6])}
    kind, tasks = type(table), []
    run = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, *a: tasks.append(self.rdd.getNumPartitions()) or run(self, *a))
    got = N.similar_vectors(table, 8, 0.4, k=6, block=10).collect()
    assert {(r.id, r.candidate_of, r.rank, r.n_similar) for r in got} == expected and {r.candidate_of for r in got if r.id == 0} >= {1, 2}
    assert 3 not in {r.candidate_of for r in got if r.id == 0} and tasks == [9]  # nine blocks, each in one task


PAGES = [
    "<p>one<p>two <b>bold</b><br>more",
    "<body><ul><li>a<ul><li>x</li></ul>rest<li>b</ul>after<div>in <p>p</p> out</div>",
    "bare &lt;text&gt; a < b",
    "<div><table><tr><td>c1<td>c2</td> gap</tr></table><pre> code </pre>tail<hr>end",
    "<script>var p = '<p>no</p>';</script><!-- <li>no --><h1>T</h1>",
    None,
]


def test_every_visible_text_is_in_one_block(spark):
    pages = spark.createDataFrame(list(enumerate(PAGES)), "page_id BIGINT, html STRING")
    got = {}
    for r in L.block_table(pages, "page_id", "html").orderBy("page_id", "pos").collect():
        got.setdefault(r.page_id, []).append((r.tag, r.text))
    assert got[0] == [("p", "one"), ("p", "two bold more")]
    assert got[1] == [("li", "a"), ("li", "x"), ("li", "rest"), ("li", "b"), ("body", "after"), ("div", "in"), ("p", "p"), ("div", "out")]
    assert got[2] == [("body", "bare <text> a < b")]
    assert got[3] == [("td", "c1"), ("td", "c2"), ("table", "gap"), ("pre", "code"), ("div", "tail"), ("div", "end")]
    assert got[4] == [("h1", "T")] and 5 not in got
    free = T.clean_text(H.tag_text(H.document_body(H.drop_noise(F.col("html"))))).alias("free")
    for r in pages.select("page_id", free, H.plain_text(F.col("html")).alias("text")).where("html is not null").collect():
        assert r.text.replace("\n", " ") == r.free == " ".join(t for _, t in got[r.page_id])


def test_given_pages_keep_all_their_text(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    free = T.clean_text(H.tag_text(H.document_body(H.drop_noise(F.col("html")))))
    assert pages.where(F.replace(H.plain_text(F.col("html")), F.lit("\n"), F.lit(" ")) != free).count() == 0


def test_markup_without_end_tags_takes_linear_time(spark):
    pages = spark.createDataFrame([(1, "<div><p>w" * 50_000)], "page_id BIGINT, html STRING")
    rows = L.block_table(pages, "page_id", "html").groupBy("tag").count().collect()
    assert [(r.tag, r["count"]) for r in rows] == [("p", 50_000)]


def test_anchors_without_end_tags(spark):
    html = '<a href="/1">one <a href="/2">two</a> x <a name="n"><li>three <a href=/4><div>in a block</div></a>'
    rows = L.link_inventory(spark.createDataFrame([(1, html), (2, None), (3, "no link")], "page_id BIGINT, html STRING"), "page_id", "html")
    assert [(r.pos, r.href, r.label) for r in rows.orderBy("pos").collect()] == [
        (1, "/1", "one"), (2, "/2", "two"), (3, "", ""), (4, "/4", "in a block"),
    ]


def test_links_are_rewritten_however_they_are_quoted(spark):
    body = "<a data-href='no' href=knowledge://b#x>one</a><img alt=\"p\" SRC='asset://f'><a href = \"knowledge://gone\">three</a>"
    rows = spark.createDataFrame([("a", body)], "id STRING, body STRING")
    paths = spark.createDataFrame([("b", "b.html")], "target_id STRING, path STRING")
    done, issues = R.rewrite_bundle_links(rows, paths, spark.createDataFrame([("f", "f.png")], "target_id STRING, path STRING"))
    assert done.first().body == (
        "<a data-href='no' href=\"b.html#x\">one</a><img alt=\"p\" src=\"../assets/f.png\"><a href = \"knowledge://gone\">three</a>"
    )
    assert [r.issue for r in issues.collect()] == ["unresolved knowledge link gone"]
    urls = spark.createDataFrame([("b.html", "https://d.example.com/1?a&b")], "filename STRING, url STRING")
    files = spark.createDataFrame([], "id STRING, filename STRING, asset_url STRING")
    done, missed = R.rewrite_answer_links(spark.createDataFrame([("a", "<a href=kb/b.html#s>x</a>")], "id STRING, body STRING"), urls, files)
    assert done.first().body == '<a href="https://d.example.com/1?a&amp;b#s">x</a>' and missed.count() == 0


def test_review_reads_a_long_run_of_blanks_in_linear_time(spark):
    blank = " \t　\x85 " * 40_000
    bodies = {"mid": f"a{blank}b", "blank": blank, "none": "", "one": "　x", "null": None}
    articles = spark.createDataFrame([*bodies.items()], "id STRING, body STRING")
    nothing = spark.createDataFrame([], "id STRING, warning STRING, asset_id STRING, target_id STRING")
    start = time.perf_counter()
    got = A.review_findings(articles, nothing.select("id", "warning"), nothing.select("id", "asset_id"), nothing.select("id"), nothing.select("id", "target_id"))
    assert sorted(map(tuple, got.collect())) == [("blank", "empty_body"), ("none", "empty_body")]
    assert time.perf_counter() - start < 30


def test_tokens_are_cut_whatever_their_case_and_nesting(spark):
    body = (
        "x < y<A>a</a><abbr>t<a href='1'>b</a><AC:LINK a>l<a>m</AC:Link ><ac:image/>p</ac:image><ac:macro-x>"
        "<ac:macro n='<'>1<ac:structured-macro/>2<ac:macro>3</ac:macro>4</ac:structured-macro ></ac:macro>z<ac:macro>open"
    )
    got = spark.createDataFrame([(body,)], "body STRING").select(M.cut(F.col("body")).alias("c")).head().c
    assert got[1::2] == [
        "<A>", "<a href='1'>", "<AC:LINK a>l<a>m</AC:Link >",
        "<ac:macro n='<'>1<ac:structured-macro/>2<ac:macro>3</ac:macro>4</ac:structured-macro >", "<ac:macro>open",
    ]
    assert "".join(got) == body
