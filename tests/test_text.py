import pytest
from pyspark.sql import functions as F

from quernel.functions import text as T
from quernel.operators import retrieval, trees, windows


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'int' if isinstance(v, int) else 'string'}" for k, v in values.items()))
    return df.select(column.alias("x")).first().x


def test_strip_examples(spark):
    doc = "Reads rows.\n\nExample:\n```\nArgs: no\n```\nmore\nArgs:\n  x: rows\n"
    assert one(spark, T.strip_examples("d"), d=doc) == "Reads rows.\n\nArgs:\n  x: rows"
    assert one(spark, T.strip_examples("d"), d="Examples: a\nb") == ""
    assert one(spark, T.strip_examples("d"), d="") == ""


def test_trivial(spark):
    def check(sig, kind, doc):
        return one(spark, T.trivial("s", "k", "d"), s=sig, k=kind, d=doc)

    assert check("def get_at(...)", "method", "") and not check("def get(...)", "method", "")
    assert not check("class X", "class", "") and check("def __repr__(...)", "method", "x" * 200)
    assert check("def f(...)", "function", "Returns it.") and not check("def f(...)", "function", "Counts rows.")
    assert not check("def is_open(...)", "method", "y" * 80)


def test_chunk_counts(spark):
    for n, k in ((0, 0), (1, 1), (1200, 1), (1201, 2), (2250, 2), (2251, 3)):
        got = one(spark, T.chunks("t"), t="é" * n)
        assert len(got) == k and (not k or sum(len(c) for c in got) - 150 * (k - 1) == n)
    with pytest.raises(ValueError):
        T.chunks("t", 10, 10)


def test_json_replies(spark):
    reply = lambda t: one(spark, T.json_reply("t"), t=t)
    assert reply('```json\n{"a": 1}\n```') == '{"a": 1}'
    assert reply("It is {'a': True, 'b': None}.") == '{"a": true, "b": null}'
    assert reply("garbage") is None and reply("{broken") is None and reply("{a b}") is None
    assert reply("{} and {}") is None and reply('{"a": 1}, {"b": 2}') is None


def test_requests(spark):
    good = "x <REQUEST><INTERNAL><CALLS><CLASS>A, B</CLASS><METHOD></METHOD></CALLS><CALL_BY>TRUE</CALL_BY></INTERNAL><RETRIEVAL><QUERY>q</QUERY></RETRIEVAL></REQUEST>"
    r = one(spark, T.request("t"), t=good)
    assert (r.classes, r.functions, r.methods, r.call_by, r.queries) == (["A", "B"], [], [], True, ["q"])
    for bad in ("", "<REQUEST><INTERNAL></REQUEST>", "<REQUEST><INTERNAL><CALLS><CLASS>A<\\CLASS></CALLS></INTERNAL></REQUEST>"):
        r = one(spark, T.request("t"), t=bad)
        assert (r.classes, r.methods, r.call_by) == ([], [], False), bad


def test_routes(spark):
    for path, want in (("a.B.c", "method"), ("a.B.__init__", "method"), ("a.B", "class"), ("a.b", "function"), ("B.c", "function"), ("a", None)):
        assert one(spark, T.route("p"), p=path) == want


def test_similar_code(spark):
    assert one(spark, T.similar_code("a", "b"), a="class X:\n  1", b="class X(Y):") and not one(spark, T.similar_code("a", "b"), a="class X:", b="class Z:")
    assert one(spark, T.similar_code("a", "b"), a="def f():\n\n  return 1", b="def f():\nreturn 2")
    assert not one(spark, T.similar_code("a", "b"), a="def f(): pass", b="") and not one(spark, T.similar_code("a", "b"), a="", b="")


def test_paths(spark):
    for path, want in (("a/b.py", "py"), ("a/.env2", "none"), ("Makefile", "none"), ("x.tar.gz", "gz")):
        assert one(spark, T.extension("p"), p=path) == want
    for path, bad in (("a/__pycache__/b.py", True), ("a/b.pyc", True), (".git", True), ("a/git.py", False)):
        assert one(spark, T.ignored("p"), p=path) is bad


def plain_headings(text):
    import re

    nodes, stack = [[0, None, "README", []]], [0]
    for line in text.splitlines():
        m = re.match(r"^(#{1,6})\s+(.*)$", line)
        if not m:
            nodes[stack[-1]][3].append(line)
            continue
        level = len(m[1])
        while nodes[stack[-1]][0] >= level:
            stack.pop()
        nodes.append([level, stack[-1], m[2].strip(), []])
        stack.append(len(nodes) - 1)
    return [(i, p, lv, t, "\n".join(raw).strip()) for i, (lv, p, t, raw) in enumerate(nodes)]


def test_headings(spark):
    text = "intro\n# A\ntext\n\n### C\nmore\n## B\n```\n# code\n```\n# D\n#not\n####### no"
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "id int, text string")
    heads = trees.headings(df.where("id = 1"), "id", "text").orderBy("ord")
    got = [tuple(r)[1:] for r in heads.drop("depth").collect()]
    assert got == plain_headings(text)
    parents = {r.ord: r.parent_ord for r in heads.collect()}

    def above(n):
        return 0 if parents[n] is None else 1 + above(parents[n])

    assert [r.depth for r in heads.collect()] == [above(n) for n in sorted(parents)]
    assert [r.title for r in trees.headings(df.where("id = 1"), "id", "text", fence_aware=True).orderBy("ord").collect()] == ["README", "A", "C", "B", "D"]
    assert trees.headings(df, "id", "text").where("id > 1").count() == 1
    assert trees.outline(trees.headings(df, "id", "text"), "id").first().text.startswith("- A\n    - C\n  - B\n- code")


def test_tree_text(spark):
    df = spark.createDataFrame([("r", p) for p in ("b.py", "a/x.py", "a/c/y.py", "a/__pycache__/z.pyc", "", None)], "repo string, path string")
    tree = trees.paths_to_tree(df, ["repo"], "path")
    assert trees.tree_text(tree, ["repo"]).first().text.split("\n") == ["├── a/", "│   ├── c/", "│   │   └── y.py", "│   └── x.py", "└── b.py"]


def test_window_edges(spark):
    df = spark.sql("select id, 'k' k, timestamp_ntz'2025-01-01 00:00:00' + make_interval(0,0,0,0,0,0,s) ts, 1.0D v from values (1, 0.0), (2, 59.999), (3, 60.0), (4, 60.001) t(id, s)")
    got = {r.id: r.events_in_window for r in windows.sliding_usage(df, ["k"], "ts", ["v"]).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 3}


def test_fitted_conversation(spark):
    words = lambda n: " ".join(f"w{i}" for i in range(n))
    rows = [(1, 1, "system", words(5)), (1, 2, "user", words(100)), (1, 3, "assistant", words(10)), (1, 4, "user", words(20))]
    df = spark.createDataFrame(rows, "conv int, turn int, role string, text string")
    got = windows.fit_conversation(df, "conv", "turn", "role", "text", 100).orderBy("turn").collect()
    assert [(r.turn, r.cut) for r in got] == [(1, False), (2, True), (3, False), (4, False)] and got[1].text.startswith("[...truncated...]")


def test_exact_search(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    m = rng.normal(size=(300, 8)).astype("float32")
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)] + [(900, None)], "vec_id long, embedding array<float>")
    asked = df.where("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id")
    got = {}
    for r in retrieval.similar(asked, df, 3).orderBy("place").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    for q in range(0, 300, 50):
        assert got[q] == np.argsort(-(m @ m[q]), kind="stable")[:3].tolist()


def test_budgeted_dedup(spark):
    df = spark.createDataFrame([("s", 0, "aa"), ("s", 1, "aa"), ("s", 2, "bbb"), ("s", 3, "c")], "s string, i int, t string")
    assert [r.i for r in windows.ordered_dedup(df, ["s"], ["i"], "t", 5).orderBy("i").collect()] == [0, 2]
    assert windows.longest_section(df.withColumn("n", F.length("t")), ["s"], "i", "n").first().i == 2


def test_windows_over_stretches_equal_a_plain_loop(spark):
    import random

    rng = random.Random(4)
    rows = [(i, rng.choice("ab"), rng.randrange(0, 2_000), rng.randrange(1, 9)) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, k string, s int, n int").selectExpr("id", "k", "n", "timestamp_ntz'1969-12-31 23:50:00' + make_interval(0,0,0,0,0,0,s) ts")
    used = windows.sliding_usage(df, ["k"], "ts", ["n"], 10)
    got = {r.id: (r.events_in_window, r.n_in_window) for r in used.collect()}
    for i, k, s, n in rows:
        near = [m for _, k2, s2, m in rows if k2 == k and s - 10 <= s2 <= s]
        assert got[i] == (len(near), sum(near))
    wait = {r.id: r.wait_s for r in windows.waits(used, "ts", {"n_in_window": 10}, ["k"], 10).collect()}
    for i, k, s, n in rows:
        near = [(s2, m) for _, k2, s2, m in rows if k2 == k and s - 10 <= s2 <= s]
        assert wait[i] == (10 - (s - min(near)[0]) if sum(m for _, m in near) > 9 else 0)
    cost = {r.id: r.running_tokens for r in windows.running_cost(df, ["k"], "ts", ["id"], "n", 1.0, seconds=60).collect()}
    for i, k, s, n in rows:
        assert cost[i] == sum(m for j, k2, s2, m in rows if k2 == k and (s2, j) <= (s, i))


def test_containing_anywhere(spark):
    from quernel.operators import lookups

    long = "pkg/" + "deep/" * 5 + "module_name.py"
    items = spark.createDataFrame([(1, f"/srv/x/{long}"), (2, "a/b.py"), (3, "none"), (4, None), (1, f"/srv/x/{long}"), (5, "xa/b.pyz")], "item int, place string")
    keys = spark.createDataFrame([(long, 3), ("module_name.py", 2), ("b.py", 1), ("a/b.py", 9), ("", 0), (None, 0), ("x" + long, 0)], "file string, ord int")
    got = sorted((r.item, r.file) for r in lookups.containing(items, keys, "place", "file", "ord", anywhere=True).collect())
    assert got == [(1, "module_name.py"), (2, "b.py"), (5, "b.py")]
    assert lookups.containing(items, keys.limit(0), "place", "file", "ord", anywhere=True).count() == 0


def test_code_signatures(spark):
    sig = lambda code, is_class=False: one(spark, T.code_signature("t", is_class), t=code)
    assert sig("def f(a: int, b=(1, 2)) -> int: return 1\n  x") == "def f(a: int, b=(1, 2)) -> int:"
    assert sig("  def f(a,\n b): pass") == "def f(a," and sig("x = 1") == "x = 1" and sig("def f() -> x") == "def f() -> x" and sig("") == ""
    assert sig("class A(B): pass", True) == "class A(B): pass"


def test_request_routes(spark):
    for path, want in (("Pool", "class"), ("Pool.sort", "method"), ("m.sort", "function"), ("sort", None), ("m._Pool", "function"), ("m._Pool.sort", "function")):
        assert one(spark, T.request_route("t"), t=path) == want, path
