import datetime

from quernel.llm import documented
from quernel.llm.telling import telling

GRAPH = "repo_name string, id string, component_type string, relative_path string, docstring string, start_line int, scan_time timestamp_ntz, ingested_at timestamp_ntz, deleted_at timestamp_ntz, code string"
FILES = "repo_name string, relative_path string, content string, docstring string"


def day(n):
    return datetime.datetime(2025, 1, n)


SOURCE = '''from typing import overload

# comments don't count
class Pool:
    def sort_rows(self, rows):
        """Oldest row wins."""
        return rows

    def plain(self, value):
        # Oldest row wins.
        return value

@overload
def pick(a: int) -> int:
    """Takes the nearest berth."""
    ...

def pick(a, b=None):
    return a
'''
BROKEN = 'def half(x):\n    """Halves stale counts."""\n    print x\n'


def test_pairs(spark):
    row = lambda i, kind, doc, path="a/m.py", line=0, scan=2, gone=None, repo="r": (repo, i, kind, path, doc, line, day(scan), day(scan), gone, "clash")
    graph = spark.createDataFrame(
        [
            row("a.m.Pool.sort_rows", " Method", None),
            row("a.m.Pool.sort_rows", " Method", None),
            row("a.m.Pool.plain", "method", "  "),
            row("a.m.pick", "FUNCTION", None, line=14),
            row("a.m.Pool", "class", "Keeps rows in order."),
            row("a.m.gone", "function", "Keeps rows in order.", gone=day(9)),
            row("a.m.again", "function", "TODO", scan=3),
            row("a.m.again", "function", "Keeps rows in order.", scan=1),
            row("b.half", "function", "", path="b.py"),
            row("c.lost", "function", "Keeps rows in order.", path="c.py"),
            row("d.empty", "function", "Keeps rows in order.", path="d.py"),
            row("a.m.undefined", "function", "Keeps rows in order."),
            row("x.y", "function", "Keeps rows in order.", path=None),
            row("a.m.anywhere", "function", "Keeps rows in order.", repo=None),
        ],
        GRAPH,
    )
    files = spark.createDataFrame([("r", "a/m.py", SOURCE, "x"), ("r", "a/m.py", SOURCE, "y"), ("r", "b.py", BROKEN, "x"), ("r", "c.py", None, "x"), ("r", "d.py", " \n", "x")], FILES)
    got = {r.id: r for r in documented.pairs(graph, files).collect()}
    assert set(got) == {"a.m.Pool.sort_rows", "a.m.pick", "b.half", "a.m.undefined"}
    assert got["a.m.pick"].documentation == "Takes the nearest berth." and got["b.half"].code.startswith("def half")
    assert got["a.m.undefined"].code is None and got["a.m.Pool.sort_rows"].signature == "sort_rows(self,rows)"
    assert {r.id for r in documented.pairs(graph, files, with_code=False).collect()} == set(got)
    assert documented.pairs(graph.limit(0), files.limit(0)).count() == 0


def test_overload_by_signature(spark):
    source = 'def pick(a: int):\n    """Takes the nearest berth."""\n    ...\n\ndef pick(a: str):\n    return a\n'
    graph = spark.createDataFrame([("r", "m.pick", "function", "m.py", None, None, day(1), day(1), None, "")], GRAPH)
    files = spark.createDataFrame([("r", "m.py", source, "")], FILES)
    (r,) = documented.pairs(graph, files).collect()
    assert r.documentation == "Takes the nearest berth." and "return a" in r.code


def test_stub_and_definition_in_two_files(spark):
    stub = 'def pick(a: int) -> int:\n    """Takes the nearest berth."""\n    ...\n\ndef pick(a: int, b: str) -> int:\n    """Takes the berth b."""\n    ...\n\ndef lone(x: int) -> int:\n    """Halves stale counts."""\n    ...\n'
    code = "def pick(a, b):\n    return b\n\ndef pick(a):\n    return a\n"
    row = lambda i, path, line=None: ("r", i, "function", path, None, line, day(1), day(1), None, "")
    graph = spark.createDataFrame([row("p.m.pick", "p/m.py", 4), row("p.m.lone", "p/m.pyi"), row("p.n.pick", "p/n.py")], GRAPH)
    files = spark.createDataFrame([("r", "p/m.py", code, ""), ("r", "p/m.pyi", stub, ""), ("r", "p/n.py", code, "")], FILES)
    got = {r.id: r for r in documented.pairs(graph, files).collect()}
    assert set(got) == {"p.m.pick", "p.m.lone"}
    assert got["p.m.pick"].documentation == "Takes the nearest berth." and "return a" in got["p.m.pick"].code
    assert "..." in got["p.m.lone"].code
    assert {r.id for r in documented.pairs(graph, files, across_files=False).collect()} == {"p.m.lone"}
    # a component of the stub has the code of the definition with its signature
    graph = spark.createDataFrame([row("p.m.pick", "p/m.pyi", 5)], GRAPH)
    (r,) = documented.pairs(graph, files).collect()
    assert r.documentation == "Takes the berth b." and "return b" in r.code


def test_files_are_parsed_once(spark):
    graph = spark.createDataFrame([], GRAPH)
    files = spark.createDataFrame([("r", "m.py", SOURCE, "")], FILES)
    plan = documented.pairs(graph, files)._jdf.queryExecution().toString()
    assert plan.count("MapInPandas") == 0  # the symbol table comes out of a checkpoint


def test_telling():
    for doc in ("Idempotent; safe to call twice.", "Trie les casiers par âge.", "按到达顺序合并退款单。", "Counts in UTC days.", "TODO\nOldest row wins.", "Sort rows: oldest first.", ":param value: the hatch log to start from", "x" * 50_000):
        assert telling(doc, "sort_rows", ("value", "rows")), doc
    for doc in (None, "", " \n", "​", "...", "Sort rows.", "Sorts the rows", "sort_rows()", "TODO: write docs", "pylint: disable=missing-docstring", "noqa", "Args:\n    value:\n    rows:\n\nReturns:\n", ":param value: value\n:returns: result", "See above.", "N/A", "À compléter.", "暂无说明", "Описание позже.", "Value and rows.", "====\nTODO\n====", "Deprecated."):
        assert not telling(doc, "sort_rows", ("value", "rows")), doc
    assert not telling("Checks the tray.", "is_tray") and not telling("Retrys the pump.", "retry_pump")
