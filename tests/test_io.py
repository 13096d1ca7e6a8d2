"""Scans of one-file-per-record folders, sinks and streams on temporary folders."""

import gzip
import json
import uuid
from hashlib import sha256
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.reports import newest_versions, snapshot_dedup
from corpusloom.queries import collect
from corpusloom.queries.scans import _page_folders
from corpusloom.queries.views import Views
from corpusloom.sources import scans as R
from corpusloom.sources import sinks as W
from corpusloom.operators import validate as V
from corpusloom.plans import crawl as C
from corpusloom.plans.crawl import crawl
from corpusloom.streaming import incremental as J


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text if isinstance(text, str) else json.dumps(text), encoding="utf-8")


def test_mirror_layout(spark, tmp_path):
    put(tmp_path / "pages/1/page.json", {"id": "1", "title": "A", "parentId": None, "extra": {"k": 1}, "body": {"storage": {"value": "<p>"}}})
    put(tmp_path / "pages/1/body.storage.html", "<p>one\ntwo</p>")
    put(tmp_path / "pages/1/attachments.json", [{"id": "a", "title": "x.png", "download_status": "available"}, {"id": "b"}])
    put(tmp_path / "pages/2/page.json", {"id": "2", "body": "odd"})
    pages = {r.id: r for r in R.pages(spark, f"{tmp_path}/pages/*/page.json", True).collect()}
    assert pages["1"].parent_id is None and pages["1"].body == "<p>" and pages["2"].body == ""
    kept = R.pages(spark, f"{tmp_path}/pages/*/page.json", True).select(F.try_variant_get("raw", "$.extra.k", "int")).collect()
    assert {r[0] for r in kept} == {1, None}
    assert [tuple(r) for r in R.bodies(spark, f"{tmp_path}/pages/*/body.storage.html").collect()] == [("1", "<p>one\ntwo</p>")]
    rows = R.attachments(spark, f"{tmp_path}/pages/*/attachments.json", True).collect()
    assert [(r.page_id, r.id, r.status) for r in sorted(rows, key=lambda r: r.seq)] == [("1", "a", "available"), ("1", "b", None)]


def test_bodies_of_a_folder_of_pages(spark, tmp_path):
    put(tmp_path / "pages/one two/body.html", "<p>one\ntwo</p>")
    put(tmp_path / "pages/2/body.html", "x")
    put(tmp_path / "pages/2/page.json", {"id": "2"})
    rows = sorted(tuple(r) for r in R.bodies(spark, f"{tmp_path}/pages", "*.html").collect())
    assert rows == [("2", "x"), ("one two", "<p>one\ntwo</p>")]


def test_page_folders_are_shared_by_tasks(spark, tmp_path):
    spark.range(300).selectExpr("id as page_id", "'<p>' || id as html").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    view = Views(spark, str(tmp_path))
    path = _page_folders(view, "shared")
    names = [f.name.split("-")[1] for f in Path(path.removeprefix("file:")).rglob("part-*.txt")]
    assert len(names) == 300 and len(set(names)) > 1
    rows = collect()[0]["scan_bodies"](spark, str(tmp_path)).collect()
    assert {(r.page_id, r.sha256) for r in rows} == {(str(i), sha256(f"<p>{i}".encode()).hexdigest()) for i in range(300)}


def test_pages_that_share_an_id_share_a_file(spark, tmp_path):
    rows = [(1, "a é\r\n"), (1, None), (2, ""), (None, "n"), (3, "x" * 100_000)]
    spark.createDataFrame(rows, "page_id BIGINT, html STRING").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    path = _page_folders(Views(spark, str(tmp_path)), "shared").removeprefix("file:")
    files = {f.parent.name: f.read_bytes().decode() for f in Path(path).rglob("*") if f.is_file()}
    assert files.pop("page=1") in ("a é\r\n\n\n", "\na é\r\n\n")
    assert files == {"page=2": "\n", "page=3": "x" * 100_000 + "\n", "page=__HIVE_DEFAULT_PARTITION__": "n\n"}


def test_bodies_are_the_same_by_any_reader(spark, tmp_path):
    for i, text in enumerate(("é\r\nx\n", "\ufeffa\x00b", "\n\n")):
        for end in ("txt", "text"):
            (tmp_path / f"pages/a+{i} %41").mkdir(parents=True, exist_ok=True)
            (tmp_path / f"pages/a+{i} %41/body.{end}").write_bytes(text.encode())
    (tmp_path / "pages/zip").mkdir()
    (tmp_path / "pages/zip/body.text.gz").write_bytes(gzip.compress(b"packed"))
    plain, other = (sorted(map(tuple, R.bodies(spark, f"{tmp_path}/pages", f"*.{end}").collect())) for end in ("txt", "text"))
    assert plain == other and len(plain) == 3
    assert [tuple(r) for r in R.bodies(spark, f"{tmp_path}/pages", "*.gz").collect()] == [("zip", "packed")]


def test_many_folders_are_listed_and_read_by_few_tasks(spark, tmp_path):
    spark.range(600).selectExpr("id as page_id", "'<p>' || id as html").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    path = _page_folders(Views(spark, str(tmp_path)), "many")
    key, jobs = "spark.sql.sources.parallelPartitionDiscovery.parallelism", spark.sparkContext.statusTracker()
    spark.conf.set(key, 700)
    try:
        for read in (lambda: R.bodies(spark, path, "*.txt"), lambda: R.binaries(spark, path)):
            group = uuid.uuid4().hex
            spark.sparkContext.setJobGroup(group, "listing")
            assert read().count() == 600
            stages = [jobs.getStageInfo(s) for j in jobs.getJobIdsForGroup(group) for s in jobs.getJobInfo(j).stageIds]
            assert 0 < max(s.numTasks for s in stages if s) <= R.FILE_WAVES * spark.sparkContext.defaultParallelism
        assert spark.conf.get(key) == "700"
    finally:
        spark.conf.unset(key)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_inventory_with_byte_order_mark(spark, tmp_path):
    put(tmp_path / "pages.csv", "﻿Page ID,Title\n 7 ,\n8,\"a \"\"b\"\"\nc\"\n")
    rows = R.inventory_csv(spark, f"{tmp_path}/pages.csv").orderBy("Page ID").collect()
    assert [tuple(r) for r in rows] == [("7", None), ("8", 'a "b"\nc')]


def test_packages_state_and_responses(spark, tmp_path):
    put(tmp_path / "p/one two/article.html", "<a>x</a>")
    put(tmp_path / "p/three/article.html", "y")
    put(tmp_path / "p/three/metadata.json", {"title": "T", "source_url": "u"})
    rows = {r.folder: (r.title, r.source_url) for r in R.package_folders(spark, f"{tmp_path}/p").collect()}
    assert rows == {"one two": ("one two", ""), "three": ("T", "u")}
    put(tmp_path / "s.json", {"category_id": "c", "articles": {"a": {"zoho_id": "1", "pending": True}, "b": {}}})
    state = {r.id: (r.category_id, r.remote_id, r.pending) for r in R.state(spark, f"{tmp_path}/s.json", True).collect()}
    assert state == {"a": ("c", "1", True), "b": ("c", None, None)}


def test_objects_are_replaced_by_id(spark, tmp_path):
    path = f"{tmp_path}/objects"
    df = spark.createDataFrame([("a", "x", 1), ("older", "x", 1), ("b", "y", 1)], "id STRING, connector STRING, v INT")
    W.write_objects(df, path)
    W.write_objects(df.filter("id = 'a'").withColumn("v", F.lit(2)), path)
    assert {(r.id, r.v) for r in spark.read.parquet(path).collect()} == {("a", 2), ("older", 1), ("b", 1)}


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    path = f"{tmp_path}/objects"
    df = spark.createDataFrame([(f"id-{i}", "x", 1) for i in range(400)], "id STRING, connector STRING, v INT").coalesce(1)
    W.write_objects(df, path)
    before = {str(f) for f in (tmp_path / "objects").rglob("part-*")}
    W.write_objects(df.limit(10).withColumn("v", F.lit(2)), path)
    after = {str(f) for f in (tmp_path / "objects").rglob("part-*")}
    assert len(before) == 64 and len(before - after) <= 10
    assert spark.read.parquet(path).groupBy("v").count().orderBy("v").collect() == [(1, 390), (2, 10)]


def test_crawl_job_keeps_older_objects_and_isolates_bad_pages(spark, tmp_path):
    out = f"{tmp_path}/out"
    page = "id STRING, parent_id STRING, title STRING, position BIGINT, status STRING, body STRING, version STRING, url STRING, space STRING, webui STRING, base STRING, created_at STRING, updated_at STRING, author_id STRING"
    row = lambda i, up, title, body: (i, up, title, 0, "current", body, "1", "", "s", "/x", "https://w.example.com", "2026-01-01T00:00:00Z", None, "a")
    pages = spark.createDataFrame(
        [
            row("1", None, "Start", '<p>see <ac:link><ri:page ri:content-title="Second"/></ac:link></p>'), row("2", "1", "Second", "<p>two</p>"),
            row("3", "1", "Lost", "<p>x</p>"), row("9", None, "Apart", "<p>y</p>"), row("4", "2", "a" * 60_000, "<p>long title</p>"),
        ], page,
    )
    file = "page_id STRING, id STRING, title STRING, filename STRING, seq BIGINT, status STRING, error STRING, local_path STRING, media_type STRING, size_bytes BIGINT, file_size BIGINT, sha256 STRING, url STRING"
    files = spark.createDataFrame([("1", "f", "f.png", "", 1, "available", "", "attachments/f", "image/png", 3, 3, "0" * 64, ""), ("2", "g", "g.png", "", 1, "failed", "HTTP 404", "", None, 0, 0, "", "")], file)
    held = spark.createDataFrame([("2", "1", True)], "page_id STRING, version STRING, has_body BOOLEAN")
    errors = spark.createDataFrame([("3", "HTTP 500", "HTTPError"), ("9", "HTTP 500", "HTTPError")], "page_id STRING, message STRING, type STRING")
    listed = spark.createDataFrame([], "title STRING, url STRING")
    run = lambda p, root: crawl(p, files, held, listed, out, root_id=root, space_id="s", connector="w", base_url="https://w.example.com", generated_at="now", page_errors=errors).first()
    first = run(pages, "1")
    assert (first.object_count, first.asset_count, first.requested_pages, first.resumed_pages, first.failure_count, first.crawl_successful) == (3, 1, 4, 1, 2, False)
    objects = {r.id: json.loads(r.json) for r in spark.read.parquet(f"{out}/objects").collect()}
    assert set(objects) == {"w-1", "w-2", "w-4"} and objects["w-1"]["content"]["body"] == '<p>see <a href="knowledge://w-2">Second</a></p>'
    assert objects["w-1"]["extensions"]["w"]["author_id"] == "a" and objects["w-1"]["taxonomy"]["tags"] == []
    assert {(r.page_id, r.type) for r in spark.read.parquet(f"{out}/failures").collect()} == {("3", "HTTPError"), ("2", "AttachmentDownloadError")}
    assert [r.target_id for r in spark.read.parquet(f"{out}/members").where("id = 'w-1'").orderBy("position").collect()] == ["w-attachment-f", "w-2"]
    second = run(pages.withColumn("title", F.when(F.col("id") == "2", "Renamed").otherwise(F.col("title"))), "2")
    assert second.object_count == 2 and V.violations(spark.read.json(f"{out}/manifest"), "manifest").count() == 0
    titles = {r.id: r.title for r in spark.read.parquet(f"{out}/objects").collect()}
    assert (titles["w-1"], titles["w-2"], len(titles)) == ("Start", "Renamed", 3)


def test_a_crawl_drops_its_scratch_tables_and_shuffles_no_body_for_the_inventory(spark, tmp_path, monkeypatch):
    words = "id parent_id title status body version url space webui base created_at updated_at author_id".split()
    rows = [{w: "x" for w in words} | {"id": str(i), "parent_id": "0" if i else None, "body": f"<p>{i} <ac:link><ri:page ri:content-title='x'/></ac:link></p>", "position": i} for i in range(9)]
    pages = spark.createDataFrame(rows, ", ".join(f"{w} string" for w in words) + ", position bigint")
    texts = "page_id id title filename status error local_path media_type sha256 url".split()
    files = spark.createDataFrame([], ", ".join(f"{w} string" for w in texts) + ", seq bigint, size_bytes bigint, file_size bigint")
    held = spark.createDataFrame([], "page_id string, version string, has_body boolean")
    plans, scratch, key = [], [], "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    monkeypatch.setattr(C, "write_inventory", lambda df, path: plans.append((df, spark.conf.get(key))) or W.write_inventory(df, path))
    monkeypatch.setattr(C, "scratch_path", lambda spark, name: scratch.append(f"{tmp_path}/{name}-{len(scratch)}") or scratch[-1])
    before = spark.conf.get(key, None)
    about = {"root_id": "0", "space_id": "s", "connector": "w", "base_url": "https://w.example.com", "generated_at": "now"}
    assert crawl(pages, files, held, spark.createDataFrame([], "title string, url string"), f"{tmp_path}/out", **about).first().object_count == 9
    left = [spark.read.parquet(path).columns for path in scratch if Path(path).exists()]
    assert scratch and not {"json", "body", "_new"} & {c for columns in left for c in columns}
    assert plans[0][1] == "true" and spark.conf.get(key, None) == before
    # Checksums are made below the joins.
    above, *below = plans[0][0]._jdf.queryExecution().optimizedPlan().toString().split("Join")
    assert "sha2(" not in above and "sha2(" in "".join(below)
    sums = {r["Page ID"]: r["Content SHA256"] for r in spark.read.csv(f"{tmp_path}/out/inventory/csv", header=True).collect()}
    assert sums == {r["id"]: sha256(r["body"].encode()).hexdigest() for r in rows}


def test_unreadable_records_stop_the_scan_and_are_listed(spark, tmp_path):
    (tmp_path / "state").mkdir()
    (tmp_path / "state/s.json").write_text('{"category_id": "c", "articles": {"a": {}}}\n{"articles": [broken\n{"articles": [1]}\n')
    with pytest.raises(Exception, match="no object at"):
        R.state(spark, f"{tmp_path}/state").collect()
    bad = R.rejected(spark, f"{tmp_path}/state", "$.articles", "OBJECT").collect()
    assert sorted(r.json for r in bad) == ['{"articles": [1]}', '{"articles": [broken']


def test_url_list_keeps_the_order_of_many_files(spark, tmp_path):
    lines = [[f"u{i}-{j}" for j in range(3 + 40 * (i % 2))] for i in range(6)]
    for i, part in enumerate(lines):
        (tmp_path / f"{i}.txt").write_text("\n".join([*part, " ", ""]))
    expected = [u for part in lines for u in part]
    assert [r.url for r in R.url_list(spark, str(tmp_path)).orderBy("seq").collect()] == expected
    assert [r.url for r in R.url_list(spark, str(tmp_path), 5).orderBy("seq").collect()] == expected[:5]


def snapshot_files(spark, folder, rows):
    for i, part in enumerate(rows):
        spark.createDataFrame(part, "page_id STRING, version BIGINT, ts STRING, status STRING, seq BIGINT").coalesce(1).write.mode("append").json(folder)


ROWS = [
    [("p", 1, "2026-01-01T00:00:00Z", "mirrored", 1), ("q", 1, "2026-01-01T00:10:00Z", "mirrored", 2)],
    [("p", 2, "2026-01-01T01:00:00Z", "mirrored", 3), ("p", 2, "2026-01-01T01:01:00Z", "resumed", 4)],
    [("p", 1, "2026-01-01T00:00:00Z", "mirrored", 1)],  # a replay
]


def newest(df):
    return {(r.page_id, r.version, r.seq) for r in df.collect()}


def test_incremental_mirror_equals_batch(spark, tmp_path):
    source, table = f"{tmp_path}/in", f"{tmp_path}/table"
    for part in ROWS:  # every start is a restart from the checkpoint
        snapshot_files(spark, source, [part])
        J.incremental_mirror(J.snapshots(spark, source), table, f"{tmp_path}/cp").awaitTermination()
    batch = newest_versions(spark.read.schema(J.SNAPSHOT_DDL).json(source))
    assert newest(J.mirrored_pages(spark, table)) == newest(batch)
    changes = spark.read.parquet(table)
    assert sorted((r.page_id, r.version, r.action) for r in changes.collect()) == [
        ("p", 1, "mirrored"), ("p", 2, "mirrored"), ("p", 2, "resumed"), ("q", 1, "mirrored"),
    ]


def test_incremental_mirror_work_grows_with_the_batch(spark, tmp_path):
    source, table = f"{tmp_path}/in", f"{tmp_path}/table"
    first = [(f"page-{i}", 1, "2026-01-01T00:00:00Z", "mirrored", i) for i in range(300)]
    second = [("page-7", 2, "2026-01-01T00:00:00Z", "mirrored", 301), ("page-8", None, "2026-01-01T00:00:00Z", "mirrored", 302), ("new", None, None, None, 303)]
    written = []
    for part in (first, second, second):  # the last one is a replay of the whole batch
        snapshot_files(spark, source, [part])
        J.incremental_mirror(J.snapshots(spark, source), table, f"{tmp_path}/cp").awaitTermination()
        written.append(spark.read.parquet(table).count())
    assert written == [300, 303, 306]
    got = newest(J.mirrored_pages(spark, table))
    assert len(got) == 301 and {("page-7", 2, 301), ("page-8", 1, 8), ("new", None, 303)} <= got


def test_windows_and_repeats(spark, tmp_path):
    source = f"{tmp_path}/in"
    snapshot_files(spark, source, ROWS)
    stream = J.snapshots(spark, source)
    for name, df, mode in (("repeats", J.without_repeats(stream), "append"), ("windows", J.outcome_counts(stream), "complete")):
        query = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
        query.awaitTermination()
    batch = snapshot_dedup(spark.read.schema(J.SNAPSHOT_DDL).json(source))
    assert spark.table("repeats").count() == batch.count() == 3
    assert spark.table("windows").agg(F.sum("outcomes")).collect()[0][0] == 5


def test_stream_gate(spark, tmp_path):
    good = {
        "schema_version": "1.0", "id": "x", "title": "T", "slug": "t", "status": "draft", "content": {"format": "html", "body": ""},
        "source": {"connector": "c", "external_id": "1"}, "timestamps": {"ingested_at": "n"},
    }
    put(tmp_path / "in/a.txt", json.dumps(good) + "\n" + json.dumps({"id": "bad"}))
    stream = spark.readStream.text(f"{tmp_path}/in").withColumnRenamed("value", "json")
    J.validate_stream(stream, "knowledge", f"{tmp_path}/ok", f"{tmp_path}/bad", f"{tmp_path}/cp").awaitTermination()
    assert spark.read.json(f"{tmp_path}/ok").count() == 1
    assert {r.object_id for r in spark.read.json(f"{tmp_path}/bad").collect()} == {"bad"}
