import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quernel import pipelines
from quernel.functions import text as T
from quernel.operators import trees

SMALL = "/root/testdata/sf0.001"


def test_metadata_from_a_folder(spark, tmp_path):
    os.makedirs(tmp_path / "repo/pkg")
    (tmp_path / "repo/pkg/a.py").write_text("def low():\n    return 1\n")
    (tmp_path / "repo/top.py").write_text("from pkg.a import low\n\ndef high():\n    return low()\n")
    assert pipelines.main(["metadata", str(tmp_path / "repo"), str(tmp_path / "out"), "--name", "r", "--percent", "50"], spark) == 0
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "out/edges")).collect()] == [("r:top.high", "r:pkg.a.low")]
    assert [r.id for r in spark.read.parquet(str(tmp_path / "out/chosen")).collect()] == ["r:pkg.a.low"]
    assert pipelines.main(["tree", str(tmp_path / "repo"), str(tmp_path / "tree")], spark) == 0
    assert spark.read.parquet(str(tmp_path / "tree")).count() == 4


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
def test_wiki_and_generation(spark, tmp_path):
    out = str(tmp_path / "out")
    assert pipelines.main(["wiki", SMALL, out, "--mode", "distributed"], spark) == 0
    pages = spark.read.parquet(out + "/pages/distributed")
    assert pages.where("path = 'INDEX.md'").count() > 0 and pages.where("path like 'pages/file/%'").count() > 0
    assert pipelines.main(["generate", SMALL, out], spark) == 0
    rows = spark.read.json(out + "/qa")
    assert rows.count() == rows.select("component_id", "file_path").distinct().count() or rows.count() > 0


COMPS = "id string, repo_name string, relative_path string, code string, depends_on array<string>"
WANTS = "<INFO_NEED>true</INFO_NEED><REQUEST><INTERNAL><CALLS><CLASS>Pool</CLASS></CALLS><CALL_BY>true</CALL_BY></INTERNAL><RETRIEVAL><QUERY>why</QUERY></RETRIEVAL></REQUEST>"


def components_of(spark):
    rows = [("m.f", "r", "m.py", "def f(): pass", ["m.Pool", "m.g"]), ("m.Pool", "r", "m.py", "class Pool: pass", []), ("m.C.__init__", "r", "m.py", "x", []), ("m.done", "r", "m.py", "x", ["m.f"])]
    return spark.createDataFrame(rows, COMPS), spark.createDataFrame([("m.done", "qa")], "component_id string, task string")


def test_reader_request_is_answered(spark, tmp_path):
    comps, log = components_of(spark)

    def model(prompts: pd.Series) -> pd.Series:
        return prompts.map(lambda p: (WANTS if "def f" in p else "<INFO_NEED>false</INFO_NEED>") if p.startswith("Decide") else "<think>x</think>" + p.rpartition("Context:\n")[2])

    got = {r.component_id: r for r in pipelines.generate(comps, log, "qa", model, log_to=str(tmp_path / "log")).collect()}
    assert set(got) == {"m.f", "m.Pool"} and all(r.error is None for r in got.values())
    text = got["m.f"].dataset_content
    assert "<INTERNAL_INFO>\n# m.Pool\nclass Pool: pass\n</INTERNAL_INFO>" in text and "<CALLED_BY>\n# m.done\nx\n</CALLED_BY>" in text
    assert f"<EXTERNAL_INFO>\nwhy\n{pipelines.NO_KNOWLEDGE}\n</EXTERNAL_INFO>" in text and got["m.Pool"].dataset_content == ""
    agents = [r.agent for r in spark.read.json(str(tmp_path / "log")).collect()]
    assert agents.count("reader") == 3 and agents.count("searcher") == 3 and agents.count("writer") == 2
    # the second time the reader sees the context; two attempts append two rounds
    twice = {r.component_id: r.dataset_content for r in pipelines.generate(comps, log, "qa", model, attempts=2, mode="context_print").collect()}
    assert twice["m.f"].count("class Pool") == 2
    assert {r.dataset_content for r in pipelines.generate(comps, log, "qa", model, attempts=0, mode="reader_searcher").collect()} == {WANTS, "<INFO_NEED>false</INFO_NEED>"}
    with pytest.raises(ValueError):
        pipelines.generate(comps, log, "poem")


def test_a_failing_call_leaves_a_row(spark):
    comps, log = components_of(spark)

    def model(prompts: pd.Series) -> pd.Series:
        if any(p.startswith("Write") for p in prompts):
            raise RuntimeError("no model")
        return prompts.map(lambda p: "<INFO_NEED>false</INFO_NEED>")

    rows = pipelines.generate(comps, log, "qa", model).collect()
    assert {(r.component_id, r.dataset_content, r.error) for r in rows} == {("m.f", None, "no model"), ("m.Pool", None, "no model")}

    def broken(prompts: pd.Series) -> pd.Series:
        raise RuntimeError("down")

    assert {(r.dataset_content, r.error) for r in pipelines.generate(comps, log, "qa", broken).collect()} == {(None, "down")}


def test_context_is_held_to_its_limit(spark):
    comps, log = components_of(spark)
    model = lambda prompts: prompts.map(lambda p: WANTS if p.startswith("Decide") else p)
    (text,) = [r.dataset_content for r in pipelines.generate(comps.where("id = 'm.f' or id = 'm.Pool'"), log, "qa", model, mode="context_print", max_input_words=10).where("component_id = 'm.f'").collect()]
    # 3 words of code, 5 of the dependency, 7 of the answer, 9 that nothing calls it: the longest section gives way, as far as it goes
    assert "# m.Pool\nclass Pool: pass" in text and pipelines.NO_KNOWLEDGE in text and "<CALLED_BY>\n\n</CALLED_BY>" in text


def test_knowledge_stages(spark, tmp_path):
    rows = [("r", "m.f", "function", "/x/m.py", "a/m.py", ["m.g"], 1, 2, True, "Sorts the rows of a tray by owner."), ("r", "m.g", "function", "/x/m.py", "a/m.py", [], 3, 4, True, "Counts the rows of a shelf.")]
    comps = spark.createDataFrame(rows, "repo_name string, id string, component_type string, file_path string, relative_path string, depends_on array<string>, start_line int, end_line int, has_docstring boolean, docstring string")
    files = spark.createDataFrame([("r", "a/m.py", "x"), ("r", "README.md", "# Top\nOne. Two.\n## Low\nThree.")], "repo_name string, relative_path string, content string")
    readme = spark.createDataFrame([("r", "# Top\nOne. Two.\n## Low\nThree.")], "repo_name string, text string")

    def model(prompts: pd.Series) -> pd.Series:
        def one(p):
            if p.startswith("Describe the project"):
                return '{"domain": "trays", "goals": ["sort"]}'
            if p.startswith("Sum up"):
                return "Told."
            if p.startswith("Name what"):
                return "First.\n\nSecond."
            if p.startswith("Say"):
                return "Says it."
            return '{"file_summary": "A file.", "workflows": ["w"], "module_summary": "A module."}' if p.startswith("- def") or p.startswith("- a/") else "broken"

        return prompts.map(one)

    stages = pipelines.Stages(spark, str(tmp_path))
    pages = {r.path: r.content for r in pipelines.knowledge(stages, comps, files, model, "both", readme).collect()}
    assert pages["CONTEXT.md"] == "# Context\n\n- **Top**: Told.\n  - **Low**: Told.\n" and pages["ARCHITECTURE.md"] == "# Architecture\n\n- First.\n- Second.\n"
    assert "## File: a/m.py\n\nA file.\n\n### Workflows\n- w\n\n### Functions / Methods\n#### def f(...)\n\nSays it." in pages["WIKI.md"]
    assert "## Directory: a\n\nA module.\n" in pages["WIKI.md"] and pages["WIKI.md"].startswith("# Repo Wiki\n\n## Project Context\n\n- **Top**")
    assert stages.get("context", None).first().card.domain == "trays"
    low = pipelines.knowledge(pipelines.Stages(spark, str(tmp_path / "low")), comps, files, max_level=1, mode="monolithic", limit=1)
    assert "(no file summary)" in low.first().content and "def g" not in low.first().content


def test_commands(spark, tmp_path, capsys):
    os.makedirs(tmp_path / "in/pkg")
    (tmp_path / "in/pkg/a.py").write_text("x = 1\n")
    (tmp_path / "in/b.txt").write_text("x")
    assert pipelines.main(["tree", str(tmp_path / "in"), str(tmp_path / "t"), "--ignore", "*.txt", "--output", "text"], spark) == 0
    assert [r.value for r in spark.read.text(str(tmp_path / "t")).collect()] == ["├── pkg/", "│   └── a.py"]
    whole = spark.createDataFrame([("a", ["b"]), ("b", []), ("c", ["b", "a"])], "id string, depends_on array<string>")
    from quernel.sources import readers, sinks

    sinks.write_component_object(readers.defaults(whole), str(tmp_path / "map"))
    assert pipelines.main(["score", str(tmp_path / "map"), str(tmp_path / "best"), "--top-percent", "40", "--betweenness-samples", "0", "--print-top", "1"], spark) == 0
    assert {r.id for r in readers.component_map(spark, str(tmp_path / "best")).collect()} == {"b", "a"} and capsys.readouterr().out.startswith("1\t")


def test_readme_summaries_go_down(spark):
    df = spark.createDataFrame([(1, "# A\nOne. Two.\n## B\nThree.")], "id int, text string")

    def model(prompts):
        return prompts.map(lambda p: p.split("Parent: ")[1].split("\n")[0] + "/" + p.rpartition("\n\n")[2][:3])

    got = {r.title: r.summary for r in pipelines.readme_summaries(trees.headings(df, "id", "text"), "id", model).collect()}
    assert got == {"README": "", "A": "/One", "B": "/One/Thr"}


def test_pieces(spark):
    df = spark.createDataFrame([(1, "a", "x y z"), (1, "b", "one two three four five"), (2, "a", "x")], "id int, section string, content string")
    got = {(r.id, r.section): r.content for r in pipelines.constrain(df, ["id"], 6).collect()}
    kept = {(r.id, r.section): r.content for r in pipelines.constrain(df, ["id"], 6, ["b"]).collect()}
    assert kept[1, "b"] == "one two three four five" and kept[1, "a"] == "x"
    assert got == {(1, "a"): "x y z", (1, "b"): "one two three", (2, "a"): "x"}
    edges = spark.createDataFrame([("m.f", "m.Pool"), ("m.g", "m.f")], "src string, dst string")
    asked = spark.createDataFrame([("m.f", "class", 0, "Pool"), ("m.g", "class", 0, "Pool"), ("m.g", "function", 0, "f")], "id string, kind string, pos int, req string")
    got = {(r.id, r.req): (r.dst, r.called_by) for r in pipelines.internal_context(None, edges, asked).collect()}
    assert got == {("m.f", "Pool"): ("m.Pool", "m.g"), ("m.g", "f"): ("m.f", pipelines.NEVER_CALLED)}
    card = spark.createDataFrame([('x {"domain": "d", "goals": ["g"]} y',), ("none",)], "t string").select(pipelines.identity_card("t").alias("c")).collect()
    assert card[0].c.goals == ["g"] and card[1].c.domain == "" and card[1].c.business_terms == {}
    flagged = pipelines.keep_flagged(df, "content", "ok", lambda p: p.map(lambda x: '{"OK": true}' if "one" in x else "{}"))
    assert [r.section for r in flagged.collect()] == ["b"]
    assert {r.chunk for r in pipelines.external_context(df.select(F.col("section").alias("source"), F.col("content").alias("text")), [("q", "one")]).collect()} == {"b#0"}
    paths = spark.createDataFrame([("/srv/r/a/b.py",), ("x/c.py",)], "p string")
    assert [r.x for r in paths.select(T.relative_to("p", "/srv/r").alias("x")).collect()] == ["a/b.py", "c.py"]
    assert [r.x for r in paths.select(T.without_root("p", "srv").alias("x")).collect()] == ["r/a/b.py", "x/c.py"]
