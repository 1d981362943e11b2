"""Dependency graphs as two tables: nodes(id) and edges(src, dst), where src depends on dst.

Iterative operators keep their state in checkpoints and end each round with one scalar, so no list of nodes or
edges comes to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernel.session import cut


def normal_nodes(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Distinct ids of ``nodes`` and of both ends of ``edges``."""
    return nodes.select("id").union(edges.select("src")).union(edges.select("dst")).where("id is not null").distinct()


def internal_edges(components: DataFrame, id: str = "id", depends_on: str = "depends_on") -> DataFrame:
    """Distinct edges (src, dst) whose dst is a component. Null lists and null entries give none."""
    edges = components.select(F.col(id).alias("src"), F.explode(depends_on).alias("dst")).distinct()
    return edges.join(components.select(F.col(id).alias("dst")).distinct(), "dst", "left_semi").select("src", "dst")


def neighbours(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, depends_on, used_by): sorted neighbours in both directions, empty arrays where there are none."""
    out = edges.groupBy(F.col("src").alias("id")).agg(F.array_sort(F.collect_set("dst")).alias("depends_on"))
    back = edges.groupBy(F.col("dst").alias("id")).agg(F.array_sort(F.collect_set("src")).alias("used_by"))
    empty = F.array().cast("array<string>")
    joined = nodes.select("id").join(out, "id", "left").join(back, "id", "left")
    return joined.select("id", F.coalesce("depends_on", empty).alias("depends_on"), F.coalesce("used_by", empty).alias("used_by"))


def degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, in_degree, out_degree) of distinct edges, 0 for isolated nodes. One shuffle: each edge counts at both ends."""
    ends = edges.select("src", "dst").distinct()
    sides = ends.select(F.explode(F.array(F.struct(F.col("dst").alias("id"), F.lit(1).alias("i"), F.lit(0).alias("o")), F.struct(F.col("src").alias("id"), F.lit(0).alias("i"), F.lit(1).alias("o")))).alias("e"))
    own = nodes.select("id").distinct().select("id", F.lit(0).alias("i"), F.lit(0).alias("o"), F.lit(1).alias("there"))
    all_ = own.unionByName(sides.select("e.*", F.lit(0).alias("there")))
    return all_.groupBy("id").agg(F.sum("i").alias("in_degree"), F.sum("o").alias("out_degree"), F.max("there").alias("there")).where("there = 1").drop("there")


def degree_summary(degrees_: DataFrame) -> DataFrame:
    """One row: nodes, edges, average and greatest degrees."""
    return degrees_.agg(
        F.count(F.lit(1)).alias("nodes"),
        F.coalesce(F.sum("out_degree"), F.lit(0)).alias("edges"),
        F.round(F.avg("in_degree"), 6).alias("avg_in"),
        F.round(F.avg("out_degree"), 6).alias("avg_out"),
        F.max("in_degree").alias("max_in"),
        F.max("out_degree").alias("max_out"),
    )


def global_rank(df: DataFrame, order: list[Column], into: str = "place") -> DataFrame:
    """``df`` with its row number, from 0, in a total order of all rows. Rows are range-partitioned and numbered within
    partitions, with one count per partition, so no task gets all rows."""
    ranged = cut(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # one row a partition
    before = counts.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return ranged.withColumn("_in", place).join(F.broadcast(before), "_part").select(*df.columns, (F.col("_before") + F.col("_in")).alias(into))


def numbered(nodes: DataFrame) -> DataFrame:
    """(id, index): dense numbers from 0 in the order of id."""
    return global_rank(nodes.select("id").distinct(), [F.col("id").asc()], "index")


def min_max(df: DataFrame, columns: list[str], suffix: str = "_n") -> DataFrame:
    """``df`` with each column scaled to [0, 1]; 0 where all values are equal (to 1e-9 of the greater)."""
    bounds = df.agg(*[f(c).cast("double").alias(f"{f.__name__}_{c}") for c in columns for f in (F.min, F.max)])
    wide = df.crossJoin(F.broadcast(bounds))  # one row
    for c in columns:
        low, high = F.col(f"min_{c}"), F.col(f"max_{c}")
        flat = F.abs(high - low) <= 1e-9 * F.greatest(F.abs(high), F.abs(low))
        wide = wide.withColumn(c + suffix, F.when(flat, 0.0).otherwise((F.col(c) - low) / (high - low)))
    return wide.drop(*bounds.columns)


def pagerank(nodes: DataFrame, edges: DataFrame, damping: float = 0.85, rounds: int = 50, tolerance: float = 1e-8, checkpoint_every: int = 2) -> DataFrame:
    """(id, rank), summing to 1. Rank of nodes without edges out is spread over all; it stops after ``rounds`` or when
    the ranks' absolute change falls under ``tolerance``. Empty without nodes."""
    ids = normal_nodes(nodes, edges)
    ends = edges.select("src", "dst").distinct()
    weighted = cut(ends.join(ends.groupBy("src").agg(F.count(F.lit(1)).alias("deg")), "src"))
    out = weighted.select(F.col("src").alias("id"), F.col("deg")).distinct()
    state = cut(ids.join(out, "id", "left"))
    n = state.count()
    if not n:
        return state.select("id", F.lit(0.0).alias("rank"))
    state = state.withColumn("rank", F.lit(1.0 / n))
    kept: list[DataFrame] = []
    for k in range(1, rounds + 1):
        loose = state.where("deg is null").agg(F.coalesce(F.sum("rank"), F.lit(0.0)).alias("loose"))
        given = weighted.join(state.select(F.col("id").alias("src"), "rank"), "src").groupBy(F.col("dst").alias("id")).agg(F.sum(F.col("rank") / F.col("deg")).alias("got"))
        following = state.join(given, "id", "left").crossJoin(F.broadcast(loose))  # one row
        value = (1 - damping) / n + damping * (F.coalesce("got", F.lit(0.0)) + F.col("loose") / n)
        state = following.select("id", "deg", F.col("rank").alias("old"), value.alias("rank"))
        if k % checkpoint_every == 0 or k == rounds:
            state = cut(state)
            while kept:
                kept.pop().unpersist()
            if tolerance and state.agg(F.sum(F.abs(F.col("rank") - F.col("old")))).first()[0] < tolerance:
                break
        else:  # a round reads the one before three times
            kept.append(state := state.persist())
    return state.select("id", "rank")


def spread(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, label): each node's least label over all that reach it along ``edges`` (src to dst), itself included.

    Label propagation with pointer jumping is unsound for directed reach, so it takes one round a step; a round ends
    with a count of changed labels."""
    state = cut(labels)
    while True:
        pushed = edges.join(state, edges.src == state.id).select(F.col("dst").alias("id"), "label")
        following = cut(state.withColumn("own", F.col("label")).unionByName(pushed.withColumn("own", F.lit(None).cast(labels.schema["label"].dataType))).groupBy("id").agg(F.min("label").alias("label"), F.max("own").alias("own")))
        if not following.where("label <> own").limit(1).count():
            return following.select("id", "label")
        state = following.select("id", "label")


#: Up to so many edges, counted beforehand, a graph or component is worked on by one task; beyond it, in rounds.
ONE_TASK_EDGES = 200_000


def _strong(edges: list[tuple[str, str]]) -> dict[str, str]:
    """The component of each node of ``edges``, named by its least id: two depth-first searches with stacks."""
    out: dict[str, list] = {}
    back: dict[str, list] = {}
    for a, b in edges:
        out.setdefault(a, []).append(b)
        out.setdefault(b, [])
        back.setdefault(b, []).append(a)
        back.setdefault(a, [])
    seen, finished = set(), []
    for root in out:
        stack = [(root, iter(out[root]))] if root not in seen else []
        seen.add(root)
        while stack:
            node, it = stack[-1]
            following = next((x for x in it if x not in seen), None)
            if following is None:
                finished.append(stack.pop()[0])
            else:
                seen.add(following)
                stack.append((following, iter(out[following])))
    named: dict[str, str] = {}
    for root in reversed(finished):
        if root in named:
            continue
        group, stack = [], [root]
        named[root] = root
        while stack:
            group.append(node := stack.pop())
            for x in back[node]:
                if x not in named:
                    named[x] = root
                    stack.append(x)
        least = min(group)
        named.update(dict.fromkeys(group, least))
    return named


def _without_cycles(edges: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """``edges`` after each component has lost its least edge again and again until none has a cycle.

    An edge goes exactly if it lies on a cycle of edges that aren't less than it. So edges are added from the greatest
    down, and for all of them at once it is found by halving the time in which step their ends come to be in one
    component: O(edges * log(edges)), however many go."""
    order = sorted((e for e in edges if e[0] != e[1]), reverse=True)
    gone = set()
    work = [(0, len(order), [(t, a, b) for t, (a, b) in enumerate(order)])]
    while work:
        low, high, part = work.pop()
        if low == high:  # the step in which the ends meet; len(order) is never
            gone.update(t for t, _, _ in part if low <= t)
            continue
        middle = (low + high) // 2
        named = _strong([(a, b) for t, a, b in part if t <= middle])
        met, apart = [], []
        for t, a, b in part:
            x, y = named.get(a, a), named.get(b, b)
            if x == y:
                met.append((t, a, b))
            else:
                apart.append((t, x, y))
        if met:
            work.append((low, middle, met))
        if apart:
            work.append((middle + 1, high, apart))
    return [e for t, e in enumerate(order) if t not in gone]


def components(nodes: DataFrame, edges: DataFrame, one_task_edges: int = ONE_TASK_EDGES) -> DataFrame:
    """(id, component): strongly connected components, named by their least id. Singletons are components of one.

    Nodes without edges in or out are split off until none is left; then each round labels every remaining node by the
    least id that reaches it and the least it reaches; where both agree the node belongs to that component, other edges
    between labels are cut. What has at most ``one_task_edges`` edges is left to one task.
    """
    left = cut(edges.select("src", "dst").distinct().where("src <> dst"))
    ids = normal_nodes(nodes, edges)
    if left.count() <= one_task_edges:

        def name(pdf: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame(list(_strong(list(zip(pdf["src"], pdf["dst"]))).items()), columns=["id", "component"])

        done = left.groupBy(F.lit(0).alias("g")).applyInPandas(lambda pdf: name(pdf), "id string, component string")
        return ids.join(done, "id", "left").select("id", F.coalesce("component", "id").alias("component"))
    done = ids.select("id", F.col("id").alias("component")).limit(0)
    while True:
        while True:  # trim: a node on a cycle has edges in both directions
            inner = left.select(F.col("src").alias("id")).intersect(left.select(F.col("dst").alias("id")))
            kept = cut(left.join(inner.withColumnRenamed("id", "src"), "src", "left_semi").join(inner.withColumnRenamed("id", "dst"), "dst", "left_semi").select("src", "dst"))
            same = kept.count() == left.count()
            left = kept
            if same:
                break
        if left.isEmpty():
            break
        active = left.select(F.col("src").alias("id")).distinct()
        start = active.select("id", F.col("id").alias("label"))
        forward = spread(start, left)
        backward = spread(start, left.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        both = cut(forward.join(backward.withColumnRenamed("label", "back"), "id"))
        done = cut(done.unionByName(both.where("label = back").select("id", F.col("label").alias("component"))))
        open_ = both.where("label <> back")
        a = open_.select(F.col("id").alias("src"), F.col("label").alias("l1"), F.col("back").alias("b1"))
        b = open_.select(F.col("id").alias("dst"), F.col("label").alias("l2"), F.col("back").alias("b2"))
        left = cut(left.join(a, "src").join(b, "dst").where("l1 = l2 and b1 = b2").select("src", "dst"))
    return ids.join(done, "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def cycles(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(component, size, self_loop) of components of more than one node, and of single nodes with an edge to themselves."""
    loops = edges.where("src = dst").select(F.col("src").alias("id"), F.lit(True).alias("loop")).distinct()
    named = components(nodes, edges).join(loops, "id", "left")
    sized = named.groupBy("component").agg(F.count(F.lit(1)).alias("size"), F.coalesce(F.bool_or("loop"), F.lit(False)).alias("self_loop"))
    return sized.where("size > 1 or self_loop")


def break_cycles(nodes: DataFrame, edges: DataFrame, one_task_edges: int = ONE_TASK_EDGES) -> DataFrame:
    """The edges without cycles: self-loops go, then of each component its least edge (src, dst), until none is left.

    Components are independent. Those of at most ``one_task_edges`` edges are worked on as groups, one task each. For the
    edges of larger ones, all at once, it is found by halving when their ends come to be in one component if edges are
    added from the greatest down: as many rounds of ``components`` as the number of edges has binary digits.
    """
    left = cut(edges.select("src", "dst").distinct().where("src <> dst"))
    named = cut(components(nodes, left, one_task_edges))
    a, b = named.select(F.col("id").alias("src"), F.col("component").alias("c")), named.select(F.col("id").alias("dst"), F.col("component").alias("d"))
    placed = cut(left.join(a, "src").join(b, "dst").select("src", "dst", "c", (F.col("c") == F.col("d")).alias("inside")))
    sizes = placed.where("inside").groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    small = sizes.where(F.col("n") <= one_task_edges).select("c")

    def tidy(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_without_cycles(list(zip(pdf["src"], pdf["dst"]))), columns=["src", "dst"])

    kept = placed.where("not inside").select("src", "dst")
    kept = kept.unionByName(placed.where("inside").join(small, "c", "left_semi").groupBy("c").applyInPandas(tidy, "src string, dst string"))
    large = cut(placed.where("inside").join(small, "c", "left_anti").select("src", "dst"))
    if large.isEmpty():
        return kept
    timed = cut(global_rank(large, [F.desc("src"), F.desc("dst")], "t"))
    never = timed.count()
    # ``low`` and ``high`` bound the step in which the ends of an edge meet; ends are named within their range
    state = timed.select("src", "dst", "t", F.col("src").alias("a"), F.col("dst").alias("b"), F.lit(0).cast("long").alias("low"), F.lit(never).cast("long").alias("high"))
    for _ in range(never.bit_length()):
        middle = F.floor((F.col("low") + F.col("high")) / 2)
        state = cut(state.withColumn("middle", middle).withColumn("p", F.concat_ws(":", "low", "a")).withColumn("q", F.concat_ws(":", "low", "b")))
        early = state.where("t <= middle and low < high").select(F.col("p").alias("src"), F.col("q").alias("dst"))
        found = components(early.select(F.col("src").alias("id")).limit(0), early, one_task_edges)
        x, y = found.select(F.col("id").alias("p"), F.col("component").alias("x")), found.select(F.col("id").alias("q"), F.col("component").alias("y"))
        wide = state.join(x, "p", "left").join(y, "q", "left").withColumn("x", F.coalesce("x", "p")).withColumn("y", F.coalesce("y", "q"))
        met, done = F.col("x") == F.col("y"), F.col("low") == F.col("high")
        bare = lambda c: F.regexp_replace(c, "^[0-9]+:", "")
        state = wide.select(
            "src",
            "dst",
            "t",
            F.when(met | done, F.col("a")).otherwise(bare("x")).alias("a"),
            F.when(met | done, F.col("b")).otherwise(bare("y")).alias("b"),
            F.when(met | done, F.col("low")).otherwise(F.col("middle") + 1).alias("low"),
            F.when(met & ~done, F.col("middle")).otherwise(F.col("high")).alias("high"),
        )
    return kept.unionByName(cut(state.where("low > t").select("src", "dst")))


def levels(nodes: DataFrame, edges: DataFrame, max_level: int | None = None) -> DataFrame:
    """(id, level): the longest path to a node without dependencies; the order in which a graph without cycles can be
    worked off in parallel. Nodes on cycles, or above ``max_level``, have a null level."""
    left = cut(edges.select("src", "dst").distinct())
    waiting = cut(normal_nodes(nodes, edges))
    done = None
    level = 0
    while max_level is None or level <= max_level:
        ready = cut(waiting.join(left.select(F.col("src").alias("id")).distinct(), "id", "left_anti"))
        if ready.isEmpty():
            break
        placed = ready.select("id", F.lit(level).alias("level"))
        done = placed if done is None else cut(done.unionByName(placed))
        waiting = cut(waiting.join(ready, "id", "left_anti"))
        left = cut(left.join(ready.withColumnRenamed("id", "dst"), "dst", "left_anti").select("src", "dst"))
        level += 1
    rest = waiting.select("id", F.lit(None).cast("int").alias("level"))
    return rest if done is None else done.unionByName(rest)


def exact_order(nodes: DataFrame, edges: DataFrame, graph: str, method: str = "depth_first") -> DataFrame:
    """(graph, id, ord): the sequential orders, one graph of column ``graph`` at a time, after its cycles are broken as by
    ``break_cycles``.

    ``depth_first``: post-order with sorted roots and dependencies. ``kahn``: always the least id that is ready. Both are
    sequential by definition, so a graph is one group; it must fit a task. Use ``levels`` for graphs that don't.
    """
    order = {"depth_first": _depth_first, "kahn": _kahn}[method]
    kind = dict(nodes.dtypes)[graph]
    rows = nodes.select(graph, F.col("id").alias("src"), F.lit(None).cast("string").alias("dst")).unionByName(edges.select(graph, "src", "dst"))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        ends = list(zip(pdf["src"], pdf["dst"]))
        deps: dict[str, set] = {x: set() for e in ends for x in e if x is not None}
        for s, d in _without_cycles([e for e in set(ends) if e[1] is not None]):
            deps[s].add(d)
        ids = order(deps)
        return pd.DataFrame({graph: [key[0]] * len(ids), "id": ids, "ord": range(len(ids))})

    return rows.groupBy(graph).applyInPandas(run, f"{graph} {kind}, id string, ord long")


def _depth_first(deps: dict[str, set]) -> list[str]:
    seen, out = set(), []
    for root in sorted(deps):
        stack = [(root, None)]
        while stack:
            node, it = stack.pop()
            if it is None:
                if node in seen:
                    continue
                seen.add(node)
                it = iter(sorted(deps[node]))
            following = next((d for d in it if d not in seen), None)
            if following is None:
                out.append(node)
            else:
                stack += [(node, it), (following, None)]
    return out


def _kahn(deps: dict[str, set]) -> list[str]:
    import heapq

    users: dict[str, list] = {}
    open_ = {n: len(d) for n, d in deps.items()}
    for n, ds in deps.items():
        for d in ds:
            users.setdefault(d, []).append(n)
    ready = [n for n, k in open_.items() if not k]
    heapq.heapify(ready)
    out = []
    while ready:
        out.append(node := heapq.heappop(ready))
        for user in users.get(node, ()):
            open_[user] -= 1
            if not open_[user]:
                heapq.heappush(ready, user)
    return out


def betweenness(nodes: DataFrame, edges: DataFrame, sources: DataFrame | None = None, max_depth: int | None = None) -> DataFrame:
    """(id, betweenness): directed, unweighted, ends excluded, not normalised.

    A breadth-first search from all of ``sources`` (all nodes if None) at once, one level a round, with the number of
    shortest paths; then shares go back level by level. With fewer sources than nodes results are scaled by their
    ratio. State is (source, node, level, paths), so sample sources on large graphs.
    """
    ids = cut(normal_nodes(nodes, edges))
    ends = cut(edges.select("src", "dst").distinct().where("src <> dst"))
    start = ids if sources is None else ids.join(sources.select("id").distinct(), "id", "left_semi")
    scale = 1.0
    if sources is not None:
        picked = start.count()
        scale = ids.count() / picked if picked else 0.0
    frontier = cut(start.select(F.col("id").alias("s"), F.col("id").alias("v"), F.lit(0).alias("level"), F.lit(1.0).alias("paths")))
    found, depth = frontier, 0
    while max_depth is None or depth < max_depth:
        step = frontier.join(ends, frontier.v == ends.src).groupBy("s", F.col("dst").alias("v")).agg(F.sum("paths").alias("paths"))
        frontier = cut(step.join(found.select("s", "v"), ["s", "v"], "left_anti").select("s", "v", F.lit(depth + 1).alias("level"), "paths"))
        if frontier.isEmpty():
            break
        depth += 1
        found = cut(found.unionByName(frontier))
    share = found.where(F.lit(False)).select("s", "v", F.lit(0.0).alias("share"))
    for level in range(depth, 0, -1):
        lower = found.where(F.col("level") == level).join(share, ["s", "v"], "left").select("s", F.col("v").alias("dst"), F.col("paths").alias("below"), F.coalesce("share", F.lit(0.0)).alias("share"))
        upper = found.where(F.col("level") == level - 1).select("s", F.col("v").alias("src"), "paths")
        back = lower.join(ends, "dst").join(upper, ["s", "src"]).groupBy("s", F.col("src").alias("v")).agg(F.sum(F.col("paths") / F.col("below") * (1 + F.col("share"))).alias("share"))
        share = cut(share.unionByName(back.select("s", "v", "share")))
    total = share.where("s <> v").groupBy(F.col("v").alias("id")).agg((F.sum("share") * scale).alias("b"))
    return ids.join(total, "id", "left").select("id", F.coalesce("b", F.lit(0.0)).alias("betweenness"))


def sample_sources(nodes: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """``n`` node ids by a hash of id and seed: the same for every run and partitioning."""
    return nodes.select("id").distinct().orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(n)


def influence(nodes: DataFrame, edges: DataFrame, alpha: float = 1.0, beta: float = 1.0, gamma: float = 1.0, samples: int | None = 200, damping: float = 0.85, rounds: int = 50, tolerance: float = 1e-8, seed: int = 42) -> DataFrame:
    """(id, in_degree, out_degree, betweenness, pagerank, score): score is the weighted sum of the scaled degrees and
    betweenness, plus scaled rank. ``samples``: None for all sources, a negative number for no betweenness."""
    own = degrees(nodes, edges)
    between = nodes.select("id", F.lit(0.0).alias("betweenness")) if samples is not None and samples < 0 else betweenness(nodes, edges, sample_sources(nodes, samples, seed) if samples else None)
    ranked = pagerank(nodes, edges, damping, rounds, tolerance).withColumnRenamed("rank", "pagerank")
    scaled = min_max(cut(own.join(between, "id").join(ranked, "id")), ["in_degree", "out_degree", "betweenness", "pagerank"])
    score = alpha * F.col("in_degree_n") + beta * F.col("out_degree_n") + gamma * F.col("betweenness_n") + F.col("pagerank_n")
    return scaled.select("id", "in_degree", "out_degree", "betweenness", "pagerank", score.alias("score"))


def top_percent(scored: DataFrame, percent: float, score: str = "score", id: str = "id") -> DataFrame:
    """(id, score, place) of the best ``percent``: none for 0 or less, all for 100 or more, else the share rounded up,
    at least one, by score descending, then id."""
    rows = scored.select(F.col(id).alias("id"), F.col(score).alias("score"))
    if percent <= 0:
        return rows.limit(0).withColumn("place", F.lit(0).cast("long"))
    n = rows.count()
    k = n if percent >= 100 else min(n, max(1, -(-int(n * percent * 1_000_000) // 100_000_000)))
    ranked = global_rank(rows, [F.col("id").asc()] if percent >= 100 else [F.desc("score"), F.col("id").asc()])
    return ranked.where(F.col("place") < k).withColumn("place", F.col("place") + 1)


def selected(components_: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of ``components_`` that were chosen, with their ``place``; unknown ids are skipped."""
    return components_.join(chosen.select("id", "place"), "id")


def callers(edges: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, caller) of each wanted id."""
    return edges.join(wanted.select(F.col("id").alias("dst")).distinct(), "dst", "left_semi").select(F.col("dst").alias("id"), F.col("src").alias("caller"))


def batches_of(levels_: DataFrame) -> Iterator[DataFrame]:
    """One table of ids per level, from the ground up: what can be worked on at the same time."""
    top = levels_.agg(F.max("level")).first()[0]
    for level in range(-1 if top is None else top + 1):
        yield levels_.where(F.col("level") == level).select("id")
