import datetime
import json

from quernel.functions.lenient_json import _deep, as_text, parse, unwrap
from quernel.operators import nested, references

AT = datetime.datetime


def brute(tree, children, name):
    """Nodes by plain recursion: (path, parent, name)."""
    out = []

    def walk(x, path, parent):
        x = unwrap(x)
        if not isinstance(x, dict):
            return
        out.append((path, parent, as_text(x.get(name))))
        below = unwrap(x.get(children))
        for i, y in enumerate([below] if isinstance(below, dict) else below if isinstance(below, list) else []):
            walk(y, f"{path}/{i}", path)

    tree = unwrap(tree)
    for i, x in enumerate(tree if isinstance(tree, list) else [tree]):
        walk(x, str(i), "")
    return out


DEEP = '{"name":"d","contents":[' * 3000 + "]}" * 3000
RECORDS = [
    (1, '{"name":"a","type":"directory","contents":[{"name":"b"},7,{"name":null,"contents":{"name":1.50}}]}'),
    (1, '{"name":"a","type":"directory","contents":[{"name":"b"},7,{"name":null,"contents":{"name":1.50}}]}'),
    (2, json.dumps('{"name":"s","contents":"[{\\"name\\":\\"t\\"}]"}')),
    (3, '[{"name":"r0"},"x",{"name":"r2","contents":[[],{"name":true}]}]'),
    (4, '{"name":"cut"'),
    (5, None),
    (6, ""),
    (7, '{"name":NaN}'),
    (8, DEEP),
    (None, '{"name":"\\ud800"}'),
    (9, "null"),
]


def test_trees_equal_plain_recursion(spark):
    df = spark.createDataFrame([(i, t, "clash") for i, t in RECORDS], "record_id long, tree_json string, node_path string")
    got = {(r.record_id, r.node_path, r.parent_path, r.node_name) for r in nested.repository_nodes(df).where("record_id <> 8 or record_id is null").collect()}
    want = set()
    for i, t in RECORDS:
        if t and i not in (4, 7, 8):
            want |= {(i, *n) for n in brute(parse(t), "contents", "name")}
    assert got == want
    assert (3, "2/1", "2", "true") in got and (1, "0/2/0", "0/2", "1.50") in got and (None, "0", "", "�") in got
    deep = nested.repository_nodes(df).where("record_id = 8")
    assert deep.count() == 3000 and deep.where("parent_path = ''").count() == 1


def test_deep_reader_agrees():
    for t in ('{"a": [1, -2.5e3, "x", {"b": null}], "c": {}}', "[]", " [ {} , true ] ", '"s"', "12"):
        assert _deep(t) == parse(t)
    for t in ("", "{", "[1,]", '{"a":}', "01", "nul", '{"a":1}}', "[1 2]", "NaN"):
        for f in (_deep, parse):
            try:
                f(t)
            except ValueError:
                continue
            raise AssertionError(t)


def test_empty_trees(spark):
    assert nested.repository_nodes(spark.createDataFrame([], "record_id long, tree_json string")).count() == 0


GRAPH = "repo_name string, id string, component_type string, depends_on array<string>, scan_time timestamp_ntz, ingested_at timestamp_ntz, deleted_at timestamp_ntz, reason string"
LOG = "log_id long, repo_name string, component_id string, logged_at timestamp_ntz"


def day(n):
    return AT(2025, 1, n)


def test_reasons_of_orphans(spark):
    graph = spark.createDataFrame(
        [
            ("r", "a", "class", [" b ", "x", None, "", "x"], day(2), day(3), None, "clash"),
            ("r", "a", "class", ["old"], day(1), day(2), None, "clash"),
            ("r", "a", "class", ["later delivery"], day(2), day(9), None, "clash"),
            ("r", "b", "class", None, day(1), day(2), day(5), "clash"),
            ("r", "c", "class", ["b"], day(7), day(8), None, "clash"),
        ],
        GRAPH,
    )
    log = spark.createDataFrame([(1, "r", "b", day(5)), (2, "r", " unknown", day(5)), (3, "r", None, day(5)), (4, "r", "c\t", day(6)), (5, "r", "B", day(6)), (5, "r", "B", day(6)), (6, "q", "a", day(6)), (7, None, "a", day(6))], LOG)
    got = {tuple(r) for r in references.dangling(graph, log).collect()}
    assert got == {
        ("dependency_graph", "r", "a", "x", "missing", "2025-01"),
        ("dependency_graph", "r", "c", "b", "deleted", "2025-01"),
        ("agent_log", "r", "1", "b", "deleted", "2025-01"),
        ("agent_log", "r", "4", "c", "late", "2025-01"),
        ("agent_log", "r", "5", "B", "missing", "2025-01"),
        ("agent_log", "q", "6", "a", "missing", "2025-01"),
    }
    assert references.dangling(graph.limit(0), log.limit(0)).count() == 0


def test_match_semantics(spark):
    refs = spark.createDataFrame([(1, "x", "k"), (2, None, "k"), (3, "x", None), (4, None, None), (5, None, "z"), (6, "y", "k")], "n int, a string, b string")
    keys = spark.createDataFrame([("x", "k", "extra")], "a string, b string, n string")
    found = {m: {r.n: r.reason for r in references.orphans(refs, keys, ["a", "b"], match=m).collect()} for m in references.MATCH}
    assert found["simple"] == {6: "missing"}
    assert found["partial"] == {5: "missing", 6: "missing"}
    assert found["full"] == {2: "null_key", 3: "null_key", 5: "null_key", 6: "missing"}


def test_a_hot_key_joins_whole(spark):
    from quernel.operators.skew import split_join

    left = spark.range(5000).selectExpr("id", "if(id % 3 = 0, 'hot', concat('k', id % 900)) k").unionByName(spark.createDataFrame([(-1, None)], "id long, k string"))
    right = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(0, 900, 2)], "k string, v int")
    key = lambda df: sorted(map(tuple, df.collect()), key=str)
    for how in ("left", "inner"):
        assert key(split_join(left, right, ["k"], how, hot_keys=5).select("id", "k", "v")) == key(left.join(right, "k", how).select("id", "k", "v"))
