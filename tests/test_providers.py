import pandas as pd
import pytest

from quernel.functions import vocabulary
from quernel.operators import incremental, providers, retrieval
from quernel.sources import sinks


def test_dialects():
    sent = []

    def transport(url, headers, body):
        sent.append((url, headers, body))
        return {"choices": [{"message": {"content": "a"}}], "content": [{"text": "b"}], "candidates": [{"content": {"parts": [{"text": "c"}, {"text": "d"}]}}]}

    base = {"api_base": "http://h/v1/", "model": "m", "api_key": "k", "system": "s", "max_output_tokens": 7}
    got = {kind: providers.http_provider(base | {"type": kind}, transport)(pd.Series(["p", None])).tolist() for kind in providers.DIALECTS}
    assert got == {"openai": ["a", "a"], "huggingface": ["a", "a"], "claude": ["b", "b"], "gemini": ["cd", "cd"]}
    urls = {u for u, _, _ in sent}
    assert urls == {"http://h/v1/chat/completions", "http://h/v1/messages", "http://h/v1/models/m:generateContent"}
    claude = next(b for u, _, b in sent if u.endswith("messages"))
    assert claude["system"] == "s" and claude["messages"] == [{"role": "user", "content": "p"}] and claude["max_tokens"] == 7
    assert next(b for u, _, b in sent if u.endswith("completions"))["messages"][0] == {"role": "system", "content": "s"}


def test_registry():
    assert providers.create({}) is incremental.offline and providers.create({"type": "ECHO"}) is incremental.echo
    providers.register("own", lambda settings: lambda prompts: prompts + settings["tail"])
    assert providers.create({"type": "own", "tail": "!"})(pd.Series(["a"])).tolist() == ["a!"]
    with pytest.raises(ValueError):
        providers.create({"type": "none such"})


def test_settings():
    config = {"llm": {"max_input_tokens": 9, "max_output_tokens": 3}, "agents": {"reader": {"max_input_tokens": 5}, "writer": {"llm": {"max_tokens": 4}}}}
    assert providers.token_limits(config, "reader") == (5, 3)
    assert providers.token_limits(config, "writer") == (9, 4)
    assert providers.token_limits({}, "x") == (None, None) and providers.setting({"a": 1}, "x", "b", "a") == 1


def test_conversations(spark):
    schema = "conversation string, turn int, role string, content string"
    turns = spark.createDataFrame([("a", 0, "system", "s"), ("a", 1, "human", "q"), ("b", 4, "tool", "x")], schema)
    new = spark.createDataFrame([("a", "ai", "r"), ("c", "user", None)], "conversation string, role string, content string")
    held = providers.remember(turns, new)
    assert {tuple(r) for r in held.collect()} == {("a", 0, "system", "s"), ("a", 1, "human", "q"), ("b", 4, "tool", "x"), ("a", 2, "ai", "r"), ("c", 0, "user", None)}
    prompts = {r.conversation: r.prompt for r in providers.prompts_of(held).collect()}
    assert prompts == {"a": "System: s\nHuman: q\nAssistant: r\nAssistant: ", "b": "Assistant: ", "c": "Human: \nAssistant: "}
    anew = providers.refreshed(held, spark.createDataFrame([("a", 0, "system", "t")], schema))
    assert {tuple(r) for r in anew.where("conversation = 'a'").collect()} == {("a", 0, "system", "t")} and anew.count() == 3


def test_answers_keep_errors(spark):
    def model(prompts):
        if "bad" in prompts.iloc[0]:
            raise RuntimeError("down")
        return "<think>x</think>" + prompts

    df = spark.createDataFrame([(1, "good"), (2, "bad"), (3, "fine")], "id int, query string")
    got = {r.id: tuple(r.answer) for r in retrieval.answer_each(df, "query", model).collect()}
    assert got == {1: ("good", None), 2: ("Error: down", "down"), 3: ("fine", None)}


def test_recursive_pieces(spark):
    text = "Start.\n# One\n" + "alpha beta gamma delta. " * 12 + "\n\nShort part.\n## Two\n" + "x" * 150 + "\n### Three\nend"
    pieces = retrieval.recursive_pieces(text, 100, 20)
    assert all(0 < len(p) <= 100 for p in pieces) and pieces[0].startswith("Start.") and pieces[-1].endswith("end")
    assert any(p.startswith("## Two") for p in pieces) and any(p.startswith("### Three") for p in pieces)
    words = [w for p in pieces for w in p.split()]
    assert set(text.replace("x" * 150, "").split()) <= set(words) and sum(p.count("x") for p in pieces) >= 150
    # pieces of one run of words overlap by whole words
    run = retrieval.recursive_pieces("a1 a2 a3 a4 a5 a6 a7 a8", 11, 4)
    assert run == ["a1 a2 a3 a4", "a4 a5 a6 a7"[0:11], "a7 a8"] or all(x.split()[-1] == y.split()[0] for x, y in zip(run, run[1:]))
    assert retrieval.recursive_pieces("") == [] and retrieval.recursive_pieces(None) == [] and retrieval.recursive_pieces("short") == ["short"] and retrieval.recursive_pieces(" \n ") == []
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "id int, text string")
    assert [r.text for r in retrieval.recursive_chunks(df, "id", "text", 100, 20).orderBy("idx").collect()] == pieces


@pytest.mark.skipif(not vocabulary.os.path.exists(vocabulary.vocabulary_path()), reason="no vocabulary")
def test_vocabulary(spark):
    encoder = vocabulary.Encoder(spark)
    texts = ["It's a tray.", "", None, "按到达顺序合并", "word " * 300]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    rows = df.select("id", vocabulary.token_count(encoder, "t").alias("n"), vocabulary.truncate_tokens(encoder, "t", 3).alias("head"), vocabulary.truncate_tokens(encoder, "t", 0).alias("none")).collect()
    for r in rows:
        ids = encoder.ids(texts[r.id] or "")
        assert r.n == len(ids) and r.none == "" and r.head == (encoder.encoding.decode(ids[:3]) if len(ids) > 3 else texts[r.id] or "")


def test_summary_fields(spark):
    replies = ['```json\n{"file_summary": "S", "key_terms": ["a", 1, null]}\n```', '{"file_summary": ""}', "no json", None, '{"key_terms": null, "workflows": ["w"]}']
    df = spark.createDataFrame(list(enumerate(replies)), "id int, r string")
    got = {r.id: (r.file_summary, r.key_terms, r.workflows) for r in incremental.summary_fields(df, "r", "file").collect()}
    unread, none = "(file summary unavailable)", "(no file summary)"
    assert got == {0: ("S", ["a", "1"], []), 1: (none, [], []), 2: (unread, [], []), 3: (unread, [], []), 4: (none, [], ["w"])}


def test_growing_tables(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "name string, n int")
    path = str(tmp_path / "meta")
    assert sinks.append_new(rows, path, "name") == 2
    assert sinks.append_new(spark.createDataFrame([("b", 9), ("c", 5)], "name string, n int"), path, "name") == 1
    assert sorted(r.name for r in spark.read.parquet(path).collect()) == ["a", "b", "c"]
    pages = spark.createDataFrame([("r", "INDEX.md", "x")], "repo_name string, path string, content string")
    sinks.replace_pages(pages, str(tmp_path / "pages"), "both")
    sinks.replace_pages(pages, str(tmp_path / "pages"), "distributed")
    assert sinks.exists(spark, str(tmp_path / "pages/distributed")) and not sinks.exists(spark, str(tmp_path / "pages/both"))
    sinks.log_replies(spark.createDataFrame([(None, "x")], "component_id string, content string"), str(tmp_path / "log"), "reader")
    (r,) = spark.read.json(str(tmp_path / "log")).collect()
    assert (r.component_id, r.agent, r.content) == ("unknown", "reader", "x")


def test_a_map_in_one_object(spark, tmp_path):
    from quernel.sources import readers

    rows = spark.createDataFrame([('b"x', ["a"], None), ("a", [], "doc")], "id string, depends_on array<string>, docstring string")
    for name, df in (("some", rows), ("none", rows.limit(0))):
        sinks.write_component_object(df, str(tmp_path / name))
        (text,) = spark.read.text(str(tmp_path / name), wholetext=True).collect()
        import json

        assert sorted(json.loads(text.value)) == sorted(r.id for r in df.collect())
    got = {r.id: (r.depends_on, r.docstring) for r in readers.component_map(spark, str(tmp_path / "some")).collect()}
    assert got == {'b"x': (["a"], ""), "a": ([], "doc")}
