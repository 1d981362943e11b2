import json
import os

import pytest
from pyspark.sql import functions as F

from quernel.operators import incremental
from quernel.sources import readers, sinks
from quernel.streaming import jobs


def test_enrichment_survives_a_failing_provider(spark):
    df = spark.createDataFrame([(1, "One. Two."), (2, None), (3, "")], "id int, p string")
    assert {r.id: r.out for r in incremental.enrich(df, "p", "out").collect()} == {1: "One.", 2: "", 3: ""}

    def fails(prompts):
        raise RuntimeError("no model")

    assert {(r.out, r.out_error) for r in incremental.enrich(df, "p", "out", fails).collect()} == {(None, "no model")}


def test_levels_up(spark):
    rows = [("r", "a/x.py", "def f(...)", "Sorts rows. More."), ("r", "a/y.py", "def g(...)", "Counts."), ("r", "z.py", "def h(...)", None)]
    out = incremental.aggregate_levels(spark.createDataFrame(rows, "repo_name string, file string, signature string, business_summary string"))
    assert {(r.module, r.n) for r in out["modules"].collect()} == {("a", 2), ("(root)", 1)}
    assert {r.file: r.file_summary for r in out["files"].collect()}["a/x.py"] == "- def f(."


def test_every_line_goes_up(spark):
    rows = [("r", "big", f"f{i:02}", "x") for i in range(11)] + [("r", "small", "g", "y")]
    items = spark.createDataFrame(rows, "repo_name string, file string, signature string, business_summary string")
    up = lambda provider: incremental.summaries_up(items, ["repo_name", "file"], "business_summary", "s", provider, most=3)
    got = {r.file: (r.n, r.s) for r in up(lambda p: "<" + p.str.replace("\n", ",") + ">").collect()}
    lines = [f"- f{i:02}: x" for i in range(11)]
    first = ["<" + ",".join(lines[i : i + 3]) + ">" for i in range(0, 11, 3)]
    assert got == {"big": (11, f"<<{','.join(first[:3])}>,<{first[3]}>>"), "small": (1, "<- g: y>")}

    def failing(prompts):
        return prompts.map(lambda p: None if "f04" in p else "told")

    assert {r.file: r.s for r in up(failing).collect()} == {"big": None, "small": "told"}


def test_stage_cache(spark, tmp_path):
    stages = incremental.Stages(spark, str(tmp_path))
    made = []

    def make():
        made.append(1)
        return spark.range(3)

    assert stages.get("a", make).count() == 3 and stages.get("a", make).count() == 3 and len(made) == 1
    assert incremental.Stages(spark, str(tmp_path), force=True).get("a", make).count() == 3 and len(made) == 2


def test_latest(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, n int, v string")
    assert {tuple(r) for r in incremental.latest(df, ["k"], "n").collect()} == {("a", 2, "y"), ("b", 1, "z")}


def test_resumed_stream_does_each_key_once(spark, tmp_path):
    source, out, ckpt = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    df = spark.createDataFrame([(i, f"Text {i}. More.") for i in range(10)], "id int, p string")
    df.where("id < 6").coalesce(1).write.parquet(source)
    for _ in range(2):
        jobs.enrich_stream(jobs.read_table(spark, source), "id", "p", "reply", out, ckpt).awaitTermination()
    df.where("id >= 4").coalesce(1).write.mode("append").parquet(source)
    jobs.enrich_stream(jobs.read_table(spark, source), "id", "p", "reply", out, ckpt).awaitTermination()
    rows = spark.read.parquet(out).collect()
    assert sorted(r.id for r in rows) == list(range(10)) and all(r.reply == f"Text {r.id}." for r in rows)


def test_admission(spark, tmp_path):
    df = spark.createDataFrame([("k", i, 1000 * i, 1) for i in range(4)] + [("j", 9, 0, 1)], "key string, id int, at long, tokens long")
    want = {(0, 0), (1, 0), (2, 8000), (3, 8000), (9, 0)}
    assert {(r.id, r.wait_ms) for r in jobs.admit(df, "key", "id", "at", "tokens", 2, 100, seconds=10, keep=1.0).collect()} == want
    source = str(tmp_path / "in")
    df.where("id in (0, 1, 9)").coalesce(1).write.parquet(source)
    df.where("id in (2, 3)").coalesce(1).write.mode("append").parquet(source)
    stream = jobs.admit(jobs.read_table(spark, source), "key", "id", "at", "tokens", 2, 100, seconds=10, keep=1.0)
    query = stream.writeStream.format("memory").queryName("admitted").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    assert {(r.id, r.wait_ms) for r in spark.table("admitted").collect()} == want


def test_usage_stream(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.sql("select timestamp'2025-01-01 00:00:10' ts, 'a' k, 2.0D v union all select timestamp'2025-01-01 00:00:50', 'a', 3.0D").write.parquet(source)
    stream = jobs.usage_stream(jobs.read_table(spark, source, 10), "ts", ["k"], ["v"], 60, 60)
    query = stream.writeStream.format("memory").queryName("used").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert [(r.events, r.v) for r in spark.table("used").collect()] == [(2, 5.0)]


def test_sources(spark, tmp_path):
    os.makedirs(tmp_path / "repo/a")
    (tmp_path / "repo/a/x.py").write_text("é = 1\n", encoding="utf-8")
    (tmp_path / "repo/a/bad.py").write_bytes(b"\xff\xfe")
    (tmp_path / "repo/y.txt").write_text("no")
    rows = {r.relative_path: r.content for r in readers.repository(spark, str(tmp_path / "repo"), "r").collect()}
    assert rows == {"a/x.py": "é = 1\n", "a/bad.py": None}
    (tmp_path / "map.json").write_text(json.dumps({"a.b": {"id": "a.b", "component_type": "class", "depends_on": ["c"]}, "c": {"component_type": "function"}}))
    got = {r.id: r for r in readers.component_map(spark, str(tmp_path / "map.json")).collect()}
    assert got["a.b"].depends_on == ["c"] and got["c"].depends_on == [] and got["c"].docstring == "" and got["c"].start_line == 0
    (tmp_path / "out.jsonl").write_text('{"component_id": "a"}\n\nnot json\n{"other": 1}\n{"component_id": "a"}\n')
    assert [r.component_id for r in readers.done_keys(spark, str(tmp_path / "out.jsonl")).collect()] == ["a"]
    with pytest.raises(Exception):
        readers.json_lines(spark, str(tmp_path / "out.jsonl"), "component_id string", strict=True).collect()
    assert readers.config(str(tmp_path / "absent.yaml")) == {}
    df = spark.createDataFrame([("aGk=",), ("%%%",), (None,)], "b string")
    assert [r.x for r in df.select(readers.decoded("b").alias("x")).collect()] == ["hi", "", ""]


def test_sinks(spark, tmp_path):
    pages = spark.createDataFrame([("r", "a/b.md", "é"), ("r", "c.md", None)], "repo_name string, path string, content string")
    assert {tuple(r) for r in sinks.write_pages(pages, str(tmp_path / "out")).collect()} == {("a/b.md", 2), ("c.md", 0)}
    assert (tmp_path / "out/a/b.md").read_text(encoding="utf-8") == "é"
    with pytest.raises(Exception):
        sinks.write_pages(pages.withColumn("path", F.lit("../x")), str(tmp_path / "out")).collect()
    assert sinks.manifest(pages).first().pages == ["a/b.md", "c.md"]
    sinks.append_rows(pages, str(tmp_path / "rows"))
    sinks.append_rows(pages, str(tmp_path / "rows"))
    assert spark.read.json(str(tmp_path / "rows")).count() == 4


def test_directory_scan(spark, tmp_path):
    from quernel.operators import trees

    os.makedirs(tmp_path / "a/b")
    os.makedirs(tmp_path / ".git")
    (tmp_path / "a/b/x.py").write_text("")
    (tmp_path / "a/y.pyc").write_text("")
    got = {(r.path, r.type, r.extension) for r in trees.scan_directory(spark, str(tmp_path)).collect()}
    assert got == {("", "directory", None), ("a", "directory", None), ("a/b", "directory", None), ("a/b/x.py", "file", "py")}
    assert trees.scan_directory(spark, str(tmp_path), max_depth=1).where("path = 'a/b'").count() == 0


def test_running_sums_split_a_key(spark):
    from quernel.operators import windows

    rows = [("hot", i % 997, i) for i in range(3000)] + [("cold", 1, 1), (None, 5, 5)]
    df = spark.createDataFrame(rows, "k string, v long, o long").repartition(7)
    got = {(r.k, r.o): r.s for r in windows.running_sums(df, ["k"], [F.col("o").asc()], F.col("v"), "s").collect()}
    total, want = 0, {("cold", 1): 1, (None, 5): 5}
    for k, v, o in rows[:3000]:
        total += v
        want[k, o] = total
    assert got == want
    assert {r.batch for r in windows.batch_numbers(df.where("k = 'hot'"), ["k"], ["o"], 1000).collect()} == {1, 2, 3}
