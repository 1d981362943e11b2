import itertools
import random

import pytest
from pyspark.sql import functions as F

from quernel.operators import fold, graph


def tables(spark, edges, nodes=()):
    ids = sorted({x for e in edges for x in e} | set(nodes))
    return spark.createDataFrame([(i,) for i in ids], "id string"), spark.createDataFrame(list(edges), "src string, dst string")


def plain_components(edges, nodes):
    reach = {n: {n} for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            new = reach[b] - reach[a]
            if new:
                reach[a] |= new
                changed = True
    return {n: min(m for m in nodes if m in reach[n] and n in reach[m]) for n in nodes}


def plain_betweenness(edges, nodes):
    import collections

    out = collections.defaultdict(set)
    for a, b in edges:
        if a != b:
            out[a].add(b)
    total = dict.fromkeys(nodes, 0.0)
    paths = {}
    for s in nodes:
        dist, count, queue = {s: 0}, collections.Counter({s: 1}), [s]
        for v in queue:
            for w in out[v]:
                if w not in dist:
                    dist[w] = dist[v] + 1
                    queue.append(w)
                if dist[w] == dist[v] + 1:
                    count[w] += count[v]
        paths[s] = dist, count
    for s, t, v in itertools.product(nodes, repeat=3):
        if len({s, t, v}) == 3 and t in paths[s][0] and v in paths[s][0] and t in paths[v][0] and paths[s][0][v] + paths[v][0][t] == paths[s][0][t]:
            total[v] += paths[s][1][v] * paths[v][1][t] / paths[s][1][t]
    return total


def plain_breaking(edges):
    left = {(a, b) for a, b in edges if a != b}
    while True:
        named = plain_components(left, {x for e in left for x in e})
        inside = {}
        for a, b in left:
            if named[a] == named[b]:
                inside.setdefault(named[a], []).append((a, b))
        if not inside:
            return left
        left -= {min(group) for group in inside.values()}


CASES = [
    [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("e", "e")],
    [("a", "b"), ("b", "a"), ("c", "d"), ("d", "c")],
    [("a", "b"), ("b", "c")],
    [("a", "b"), ("a", "c"), ("b", "d"), ("c", "d")],
    [("a", "hub"), ("b", "hub"), ("c", "hub")],
]


def random_edges(seed, n=14, m=26):
    rng = random.Random(seed)
    return sorted({(f"n{rng.randrange(n):02}", f"n{rng.randrange(n):02}") for _ in range(m)})


@pytest.mark.parametrize("edges", [CASES[0], CASES[1], random_edges(1)])
def test_components(spark, edges):
    nodes, e = tables(spark, edges)
    ids = sorted({x for p in edges for x in p})
    for most in (graph.ONE_TASK_EDGES, 0):
        assert {r.id: r.component for r in graph.components(nodes, e, most).collect()} == plain_components(edges, ids)


def test_cycles_and_breaking(spark):
    nodes, e = tables(spark, CASES[0])
    assert {tuple(r) for r in graph.cycles(nodes, e).collect()} == {("a", 3, False), ("e", 1, True)}
    assert {tuple(r) for r in graph.break_cycles(nodes, e).collect()} == {("b", "c"), ("c", "a"), ("c", "d")}
    nodes, e = tables(spark, CASES[1])
    assert {tuple(r) for r in graph.break_cycles(nodes, e).collect()} == {("b", "a"), ("d", "c")}
    edges = random_edges(3, 5, 9)
    nodes, e = tables(spark, edges)
    one, rounds = ({tuple(r) for r in graph.break_cycles(nodes, e, one_task_edges=k).collect()} for k in (graph.ONE_TASK_EDGES, 0))
    assert one == rounds == plain_breaking(edges)
    nodes, e = tables(spark, [])
    assert graph.components(nodes, e).count() == 0 and graph.break_cycles(nodes, e).count() == 0


def test_betweenness(spark):
    for edges, want in ((CASES[2], {"a": 0, "b": 1, "c": 0}), (CASES[3], {"a": 0, "b": 0.5, "c": 0.5, "d": 0})):
        got = {r.id: r.betweenness for r in graph.betweenness(*tables(spark, edges)).collect()}
        assert got == pytest.approx(want)
    edges = random_edges(5, 9, 18)
    ids = sorted({x for p in edges for x in p})
    got = {r.id: r.betweenness for r in graph.betweenness(*tables(spark, edges)).collect()}
    assert got == pytest.approx(plain_betweenness(edges, ids))


def test_pagerank_sums_to_one(spark):
    for edges in (CASES[4], random_edges(7)):
        got = {r.id: r.rank for r in graph.pagerank(*tables(spark, edges), rounds=40).collect()}
        assert sum(got.values()) == pytest.approx(1)
    star = {r.id: r.rank for r in graph.pagerank(*tables(spark, CASES[4]), rounds=50).collect()}
    assert star["hub"] > star["a"] == pytest.approx(star["b"])


def test_orders(spark):
    edges = [("g", a, b) for a, b in (("app", "lib"), ("app", "util"), ("lib", "util"), ("x", "y"), ("y", "x"))]
    nodes = spark.createDataFrame([("g", i) for i in ("app", "lib", "util", "x", "y", "alone")], "g string, id string")
    e = spark.createDataFrame(edges, "g string, src string, dst string")
    order = [r.id for r in graph.exact_order(nodes, e, "g").orderBy("ord").collect()]
    assert order == ["alone", "util", "lib", "app", "x", "y"]  # (x, y) is the least edge of the cycle and goes
    order = [r.id for r in graph.exact_order(nodes, e, "g", "kahn").orderBy("ord").collect()]
    assert order == ["alone", "util", "lib", "app", "x", "y"]


def test_orders_break_cycles_first(spark):
    nodes = spark.createDataFrame([("g", i) for i in "abc"], "g string, id string")
    e = spark.createDataFrame([("g", "a", "b"), ("g", "b", "c"), ("g", "c", "a"), ("g", "b", "b")], "g string, src string, dst string")
    for method in ("depth_first", "kahn"):
        assert [r.id for r in graph.exact_order(nodes, e, "g", method).orderBy("ord").collect()] == ["a", "c", "b"]


def test_breaking_by_halving():
    for seed in range(60):
        rng = random.Random(seed)
        edges = random_edges(seed, rng.randrange(2, 9), rng.randrange(1, 30))
        assert set(graph._without_cycles(edges)) == plain_breaking(edges), edges
    ring = [(f"n{i:05}", f"n{(i + 1) % 3000:05}") for i in range(3000)] + [(f"n{i:05}", f"n{i // 2:05}") for i in range(1, 3000)]
    left = graph._without_cycles(ring)
    assert len(graph._strong(left)) == len(set(graph._strong(left).values()))


def test_large_cycles_are_broken_in_rounds(spark):
    edges = random_edges(2, 6, 12)
    nodes, e = tables(spark, edges)
    assert {tuple(r) for r in graph.break_cycles(nodes, e, one_task_edges=3).collect()} == plain_breaking(edges)


def test_levels(spark):
    got = {r.id: r.level for r in graph.levels(*tables(spark, [("a", "b"), ("b", "c"), ("a", "c"), ("x", "y"), ("y", "x"), ("z", "x")], ["lone"])).collect()}
    assert got == {"c": 0, "b": 1, "a": 2, "lone": 0, "x": None, "y": None, "z": None}


def test_top_percent(spark):
    scored = spark.createDataFrame([(f"n{i:02}", float(i % 7)) for i in range(31)], "id string, score double")
    for percent, k in ((0, 0), (-1, 0), (0.1, 1), (20, 7), (100, 31), (300, 31)):
        rows = graph.top_percent(scored, percent).orderBy("place").collect()
        assert len(rows) == k and [r.place for r in rows] == list(range(1, k + 1))
    want = sorted(scored.collect(), key=lambda r: (-r.score, r.id))[:7]
    assert [r.id for r in graph.top_percent(scored, 20).orderBy("place").collect()] == [r.id for r in want]


def test_min_max(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 5.0)], "a int, b double")
    assert {(r.a_n, r.b_n) for r in graph.min_max(df, ["a", "b"]).collect()} == {(0.0, 0.0), (0.5, 0.0), (1.0, 0.0)}


def test_influence(spark):
    rows = {r.id: r for r in graph.influence(*tables(spark, CASES[3]), samples=None).collect()}
    assert rows["d"].in_degree == 2 and rows["b"].betweenness == pytest.approx(0.5)
    assert rows["d"].score == pytest.approx(1 + 0 + 0 + 1)


def test_unknown_attributes(spark):
    _, e = tables(spark, [("a", "b")])
    known = spark.createDataFrame([("a", "pkg/x.py")], "id string, relative_path string")
    (r,) = fold.attributed(e, known).collect()
    assert (r.src_pkg, r.dst_file, r.dst_pkg) == ("pkg", "(unknown)", "(unknown)")


def test_influence_query_does_the_whole_job(spark, monkeypatch):
    from quernel.plans import components

    nodes, edges = tables(spark, CASES[3])
    asked = {}
    monkeypatch.setattr(components, "nodes_edges", lambda *_: (nodes, edges))
    monkeypatch.setattr(components.graph, "influence", lambda n, e, **given: asked.update(given) or n.select("id", *[F.lit(0.0).alias(c) for c in ("in_degree", "out_degree", "betweenness", "pagerank", "score")]))
    components.influence(spark, "")
    assert asked == {"samples": 200, "rounds": 50, "tolerance": 1e-8}
