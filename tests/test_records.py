"""Versions, batches, pairs, files and the stream's table by literal rows."""

import json
import shutil

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as t

from quillmill.operators import batches, pairs
from quillmill.sources import files
from quillmill.sources.versions import Versions
from quillmill.streaming import events


def test_versions_count_once_they_are_whole(spark, tmp_path):
    held = Versions(spark, str(tmp_path / "t"))
    assert held.latest() is None and held.current() is None
    assert held.commit(None, spark.range(3)) == 0 and held.commit(0, spark.range(4)) == 1
    with pytest.raises(RuntimeError):
        held.commit(0, spark.range(9))  # version 1 is there
    (tmp_path / "t" / "version=2").mkdir()  # a write that crashed
    assert held.latest() == 1 and held.current().count() == 4
    assert held.commit(1, spark.range(5)) == 2 and held.read(0).count() == 3
    with pytest.raises(FileNotFoundError):
        held.read(7)


def test_a_batch_goes_through_its_phases(spark, tmp_path):
    tasks = spark.createDataFrame([(f"q{i:03d}" + "x" * (70 if i == 4 else 0), f"ask {i}") for i in range(25)], "question_id string, prompt string")
    batch = batches.Batch(spark, str(tmp_path / "b"))
    assert batch.phase() is None
    with pytest.raises(RuntimeError):
        batch.submit(batches.outbox(str(tmp_path / "out")))
    batch.prepare(tasks, ["question_id"], 10, done=spark.createDataFrame([("q000",)], "question_id string"))
    batch.prepare(tasks, ["question_id"], 10, done=spark.createDataFrame([("q000",)], "question_id string"))  # a prepared batch may be prepared anew
    assert batch.phase() == "prepared" and sorted(r["n"] for r in batch.manifest.current().collect()) == [4, 10, 10]
    send, sent = batches.outbox(str(tmp_path / "out")), []

    def breaks(requests, chunk):
        if chunk == 1 and len(sent) == 1:
            raise OSError("down")
        sent.append(chunk)
        return send(requests, chunk)

    with pytest.raises(OSError):
        batch.submit(breaks)
    assert batch.phase() == "submitted" and sent == [0]
    with pytest.raises(RuntimeError):
        batch.prepare(tasks, ["question_id"])
    sent.append(None)
    assert batch.submit(breaks) == 2 and sent == [0, None, 1, 2]
    assert batch.submit(breaks) == 0  # nothing is sent twice
    out = spark.read.json(str(tmp_path / "out" / "*")).select("short_id", F.regexp_extract(F.col("_metadata.file_path"), "out/([^/]+)/", 1).alias("batch_id"))
    name, status = F.col("short_id"), F.when(F.col("short_id") == "q001", "expired").otherwise("succeeded")
    content = F.when(name == "q002", "no").when(name == "q003", '{"stem": null}').otherwise('```json\n{"stem": "s"}\n```')
    results = out.select("batch_id", "short_id", status.alias("status"), content.alias("content")).unionByName(spark.createDataFrame([("batch-000000", "other", "succeeded", '{"stem": "s"}')], "batch_id string, short_id string, status string, content string"))
    assert not batch.collect(results, out.select("batch_id").where("batch_id <> 'batch-000002'"), "stem string") and batch.phase() == "submitted"
    for _ in range(2):
        assert batch.collect(results, out.select("batch_id").distinct(), "stem string") and batch.phase() == "complete"
    told = {r["question_id"]: (r["error"], r["answer"] and r["answer"]["stem"]) for r in batch.answers().collect()}
    assert len(told) == 25 and {k: v for k, v in told.items() if v[0]} == {"q001": ("batch_expired", None), "q002": ("json_parse", None), "q003": ("json_parse", None), "other": ("not in manifest", None)}
    assert told["q004" + "x" * 70] == (None, "s")
    batch.prepare(tasks, ["question_id"], 10)
    assert batch.phase() == "prepared" and batch.tasks().count() == 25


def test_many_chunks_are_sent_in_one_step(spark, tmp_path):
    tasks = spark.createDataFrame([(f"q{i:03d}", f"ask {i}") for i in range(50)], "question_id string, prompt string")
    batch, folder = batches.Batch(spark, str(tmp_path / "b")), str(tmp_path / "out")
    batch.prepare(tasks, ["question_id"], 2)

    def breaks(requests, chunk):
        if chunk == 2:
            raise OSError("down")
        return f"own-{chunk}"

    def down(requests):
        raise OSError("down")

    for send, submit in ((breaks, batch.submit), (down, batch.submit_whole)):
        with pytest.raises(OSError):
            submit(send)
    at = batch.manifest.latest()
    assert batch.submit_whole(batches.whole_outbox(folder)) == 23 and batch.manifest.latest() == at + 1
    assert batch.submit_whole(down) == 0 and batch.phase() == "submitted"  # nothing is sent twice
    assert {r["chunk"]: r["batch_id"] for r in batch.manifest.current().collect()} == {0: "own-0", 1: "own-1"} | {k: f"batch-{k:06d}" for k in range(2, 25)}
    out = spark.read.json(folder)
    assert sorted((r["short_id"], r["batch_id"]) for r in out.collect()) == [(f"q{i:03d}", f"batch-{i // 2:06d}") for i in range(4, 50)]


def test_batch_phases_takes_no_step_for_each_chunk(spark, monkeypatch):
    from quillmill.plans.records import batch_phases

    commits, commit = [], Versions.commit
    monkeypatch.setattr(Versions, "commit", lambda self, *a: commits.append(a[0]) or commit(self, *a))
    assert batch_phases(spark, "/root/testdata/sf0.01").select("chunk").distinct().count() == 2 and len(commits) == 3  # prepared, submitted, complete


def test_pairs_with_reasons_and_snippets(spark):
    texts = [
        (1, "Anode vs. cathode here. ANODE versus Cathode"), (2, "differentiate cathode from anode"), (3, "between anode and cathode"), (4, "more vs less, is vs are, ab vs cd, this vs anode, always vs anode, agonist vs antagonist, anode vs anode, iv vs dv"),
        (5, "x" * 60 + " mass (rather than weight) " + "y" * 200), (6, "weight vs mass"), (7, "once vs twice"), (8, None), (9, ""),
    ]
    found = pairs.found_pairs(spark.createDataFrame(texts, "k int, text string"), "k", "text")
    told = {(r["a"], r["b"]): r for r in pairs.mined(found, "k").collect()}
    assert set(told) == {("anode", "cathode"), ("mass", "weight")}
    first = told["anode", "cathode"]
    assert (first["n"], first["status"]) == (4, "surfaced") and first["patterns"] == {"x_vs_y": 1, "x_versus_y": 1, "differentiate_x_from_y": 1, "between_x_and_y": 1}
    assert first["examples"] == [texts[0][1], texts[0][1], texts[1][1]]
    second = told["mass", "weight"]
    assert (second["n"], second["status"], second["examples"][1]) == (2, "near_miss", "weight vs mass")
    assert second["examples"][0] == texts[4][1][11:165].strip()
    assert {r["reason"]: r["n"] for r in pairs.rejections(found).collect()} == {"directional_noise": 1, "too_short": 3, "generic_noise": 1, "universal_quantifier": 1, "already_known": 1, "same_token": 1}


def test_lines_are_numbered_across_splits(spark, tmp_path):
    for name, n in (("a.csv", 900), ("b.csv", 3), ("c.csv", 0)):
        (tmp_path / name).write_text("".join(f"line {i} of {name}\n" for i in range(n)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        lines = files.scan_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 1
        assert sorted((r["file_path"][-5:], r["at"], r["line"]) for r in lines.collect()) == sorted((f, i, f"line {i} of {f}") for f, n in (("a.csv", 900), ("b.csv", 3)) for i in range(n))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_chapters_of_a_positional_file(spark, tmp_path):
    (tmp_path / "s.csv").write_text("head\nhead\nc1, Old ,u1\nc2,Two,u2\nshort\nc1,New,u3\n")
    rows = files.scan_positional(spark, str(tmp_path), 2, 3, {"chapter": 0, "title": 1, "uid": 2}, with_file=True)
    got = {r["chapter"]: (r["title"], r["n_anchors"], [a["uid"] for a in r["anchors"]]) for r in files.grouped_chapters(rows, ["chapter"], "title", ["uid"]).collect()}
    assert got == {"c1": ("New", 2, ["u1", "u3"]), "c2": ("Two", 1, ["u2"])}


def test_questions_in_every_shape_and_what_is_put_aside(spark, tmp_path):
    content = {
        "list": [{"question_id": "a", "tier": 2}, 5, {"tier": "x"}, None], "wrapped": {"questions": [{"question_id": "b"}]}, "mapping": {"z": {"question_id": "c"}, "m": {"question_id": "d", "options": [{"letter": "A"}]}},
        "scalar": 7, "empty": [], "questions": {"questions": {"question_id": "e"}}, "text": "x",
    }
    for name, value in content.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(value))
    (tmp_path / "broken.json").write_text('[{"question_id": ')
    (tmp_path / "nothing.json").write_text("")
    (tmp_path / "c.audit.json").write_text('[{"question_id": "no"}]')
    schema = t.StructType([t.StructField("question_id", t.StringType()), t.StructField("tier", t.IntegerType()), t.StructField("options", t.ArrayType(t.StructType([t.StructField("letter", t.StringType())])))])
    rows, aside = files.scan_questions(spark, str(tmp_path), schema)
    name = lambda r: r["file_path"].rpartition("/")[2][:-5]
    assert sorted(((name(r), r["at"], r["key"], r["question_id"], r["tier"], r["options"] and r["options"][0]["letter"]) for r in rows.collect()), key=str) == sorted([
        ("list", 0, None, "a", 2, None), ("list", 2, None, None, None, None), ("wrapped", 0, None, "b", None, None), ("mapping", 0, "m", "d", None, "A"), ("mapping", 1, "z", "c", None, None), ("questions", 0, "questions", "e", None, None),
    ], key=str)
    assert sorted(((name(r), r["at"], r["reason"]) for r in aside.collect()), key=str) == sorted([("list", 1, "not_a_question"), ("list", 3, "not_a_question"), ("scalar", None, "shape"), ("text", None, "shape"), ("broken", None, "unreadable"), *([("nothing", None, "unreadable")] if any(name(r) == "nothing" for r in aside.collect()) else [])], key=str)


def test_the_streams_table_rewrites_only_what_a_batch_touches(spark, tmp_path):
    log, kept = str(tmp_path / "log"), str(tmp_path / "kept")
    schema = t.StructType([t.StructField("k", t.LongType()), t.StructField("v", t.StringType()), t.StructField("at", t.LongType())])

    def run():
        stream = events.read_log(spark, log, schema, 1)
        events.keep_latest(stream, ["k"], "at", kept, str(tmp_path / "state"), buckets=16).trigger(availableNow=True).start().awaitTermination()
        return {r["k"]: r["v"] for r in events.latest(spark, kept, schema).collect()}

    add = lambda rows: files.append_events(spark.createDataFrame(rows, schema).coalesce(1), log)
    assert events.latest(spark, kept, schema).count() == 0
    add([(k, "old", 10) for k in range(40)])
    assert run() == dict.fromkeys(range(40), "old")
    add([(3, "new", 11), (4, "late", 9)])
    assert run() == dict.fromkeys(range(40), "old") | {3: "new"}
    assert len([*(tmp_path / "kept" / "data" / "version=1").glob("bucket=*")]) <= 2
    add([(50, "more", 1)])
    shutil.rmtree(tmp_path / "kept" / "manifest" / "version=1")
    with pytest.raises(Exception, match="version=1 is missing"):
        run()
