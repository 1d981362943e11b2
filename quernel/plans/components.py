"""Queries over components, files and their graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quernel.functions import places
from quernel.functions import text as T
from quernel.operators import extraction, fold, graph, incremental, lookups, references, render, skew, trees
from quernel.plans.registry import Registry
from quernel.session import cut, table
from quernel.sources import readers

R = Registry()
QUERIES, SQL = R.queries, R.sql

PAYLOAD = ["component_type", "relative_path", "file_path", "depends_on", "start_line", "end_line", "has_docstring", "docstring"]


def current(spark: SparkSession, folder: str) -> DataFrame:
    """Current rows of all components; ``key`` is unique over repositories, ``path`` a path with the repository in its first
    segment."""
    rows = references.newest(table(spark, folder, "dependency_graph"), ["repo_name", "id"], PAYLOAD, "scan_time", "ingested_at")
    rows = rows.withColumn("component_type", F.lower(F.trim("component_type")))
    return rows.withColumn("key", F.concat_ws(":", "repo_name", "id")).withColumn("path", F.concat_ws(":", F.replace("repo_name", F.lit("/"), F.lit("|")), "relative_path"))


CURRENT = """
with cur as (
  select repo_name, id, lower(trim(component_type)) as component_type, relative_path, file_path, depends_on, start_line, end_line, has_docstring, docstring,
         repo_name || ':' || id as key, replace(repo_name, '/', '|') || ':' || relative_path as path
  from (select *, row_number() over (partition by repo_name, id order by scan_time desc nulls last, ingested_at asc nulls last) as rn from dependency_graph) where rn = 1),
deps as (
  select distinct repo_name, key as src, repo_name || ':' || trim(d) as dst, trim(d) as target from (select repo_name, key, unnest(depends_on) as d from cur) where trim(d) <> ''),
edges as (select distinct src, dst from deps where dst in (select key from cur)),
attr as (
  select e.src, e.dst, a.path as src_file, b.path as dst_file,
         case when position('/' in a.path) = 0 then '(root)' else split_part(a.path, '/', 1) end as src_pkg,
         case when position('/' in b.path) = 0 then '(root)' else split_part(b.path, '/', 1) end as dst_pkg
  from edges e left join cur a on a.key = e.src left join cur b on b.key = e.dst)
"""


SLICED = CURRENT + ", f as (select distinct repo_name, relative_path, content from source_files)"


def all_deps(rows: DataFrame) -> DataFrame:
    """(repo_name, src, dst, target) of every entry that isn't blank."""
    entries = rows.select("repo_name", F.col("key").alias("src"), F.explode("depends_on").alias("target")).withColumn("target", F.trim("target")).where("target <> ''")
    return entries.select("repo_name", "src", F.concat_ws(":", "repo_name", "target").alias("dst"), "target").distinct()


def nodes_edges(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = current(spark, folder)
    nodes = rows.select(F.col("key").alias("id"))
    edges = all_deps(rows).select("src", "dst").distinct().join(nodes.withColumnRenamed("id", "dst"), "dst", "left_semi").select("src", "dst")
    return nodes, edges


def attributed(spark: SparkSession, folder: str) -> DataFrame:
    _, edges = nodes_edges(spark, folder)
    return fold.attributed(edges, current(spark, folder).select(F.col("key").alias("id"), F.col("path").alias("relative_path")))


@R.add("edges_internal", CURRENT + "select src, dst from edges")
def edges_internal(spark, folder):
    """Edges whose target is a component (EXT16, JN01)."""
    return nodes_edges(spark, folder)[1]


@R.add("edges_dangling", CURRENT + "select src, dst from deps where dst not in (select key from cur)")
def edges_dangling(spark, folder):
    rows = current(spark, folder)
    return lookups.remaining(all_deps(rows).select("src", "dst"), rows.select(F.col("key").alias("dst")), ["dst"]).select("src", "dst")


@R.add(
    "edges_or_module",
    CURRENT
    + """select distinct src, dst from deps d where dst in (select key from cur)
  or repo_name || ':' || split_part(target, '.', 1) in (select distinct repo_name || ':' || replace(regexp_replace(relative_path, '\\.py$', ''), '/', '.') from cur)""",
)
def edges_or_module(spark, folder):
    """Dependencies that are components or begin with a module (EXT11, JN02)."""
    rows = current(spark, folder)
    heads = rows.select(F.concat_ws(":", "repo_name", T.module_path("relative_path")).alias("module")).distinct()
    # a module path has no dot before its first segment ends, so the head is repository and first segment
    return lookups.known_or_module(all_deps(rows), rows.select(F.col("key").alias("id")), heads)


@R.add("neighbours", CURRENT + """select c.key as id, coalesce(o.l, []) as depends_on, coalesce(i.l, []) as used_by from cur c
  left join (select src, list_sort(list(dst)) as l from edges group by src) o on o.src = c.key left join (select dst, list_sort(list(src)) as l from edges group by dst) i on i.dst = c.key""")
def neighbours(spark, folder):
    return graph.neighbours(*nodes_edges(spark, folder))


DEGREES = CURRENT + """, deg as (select c.key as id, coalesce(i.n, 0) as in_degree, coalesce(o.n, 0) as out_degree from cur c
  left join (select dst, count(*) as n from edges group by dst) i on i.dst = c.key left join (select src, count(*) as n from edges group by src) o on o.src = c.key)
"""


@R.add("degrees", DEGREES + "select * from deg")
def degrees(spark, folder):
    return graph.degrees(*nodes_edges(spark, folder))


@R.add("graph_summary", DEGREES + "select count(*) as nodes, cast(sum(out_degree) as bigint) as edges, round(avg(in_degree), 6) as avg_in, round(avg(out_degree), 6) as avg_out, max(in_degree) as max_in, max(out_degree) as max_out from deg")
def graph_summary(spark, folder):
    return graph.degree_summary(degrees(spark, folder))


@R.add(
    "minmax_degree",
    DEGREES + ", b as (select min(in_degree)::double as lo, max(in_degree)::double as hi from deg) select id, round(case when abs(hi - lo) <= 1e-9 * greatest(abs(hi), abs(lo)) then 0.0 else (in_degree - lo) / (hi - lo) end, 9) as in_degree_n from deg, b",
)
def minmax_degree(spark, folder):
    return graph.min_max(degrees(spark, folder), ["in_degree"]).select("id", F.round("in_degree_n", 9).alias("in_degree_n"))


@R.add("node_numbers", CURRENT + "select key as id, row_number() over (order by key) - 1 as index from cur")
def node_numbers(spark, folder):
    return graph.numbered(nodes_edges(spark, folder)[0]).select("id", F.col("index").cast("long").alias("index"))


@R.add(
    "top_percent_20",
    DEGREES + ", r as (select id, in_degree + out_degree as score, row_number() over (order by in_degree + out_degree desc, id) as place, count(*) over () as n from deg) select id, score, place from r where place <= greatest(1, ceil(n * 20 / 100.0))",
)
def top_percent_20(spark, folder):
    scored = degrees(spark, folder).select("id", (F.col("in_degree") + F.col("out_degree")).alias("score"))
    return graph.top_percent(scored, 20).select("id", "score", F.col("place").cast("long").alias("place"))


@R.add("selected_components", DEGREES + ", r as (select id, in_degree + out_degree as score, row_number() over (order by in_degree + out_degree desc, id) as place, count(*) over () as n from deg) select c.key as id, c.relative_path, c.component_type, r.place from r join cur c on c.key = r.id where place <= greatest(1, ceil(n * 20 / 100.0))")
def selected_components(spark, folder):
    """The rows of the chosen, in the order of choice (SNK02)."""
    rows = current(spark, folder).select(F.col("key").alias("id"), "relative_path", "component_type")
    return graph.selected(rows, top_percent_20(spark, folder)).select("id", "relative_path", "component_type", "place")


def _unrolled_pagerank(rounds: int) -> str:
    steps = CURRENT + ", n as (select count(*)::double as n from cur), outdeg as (select src, count(*)::double as deg from edges group by src), r0 as materialized (select key as id, 1.0 / n as rank from cur, n)"
    for k in range(1, rounds + 1):
        steps += f""", g{k} as materialized (select e.dst as id, sum(r.rank / o.deg) as got from edges e join r{k - 1} r on r.id = e.src join outdeg o on o.src = e.src group by e.dst),
l{k} as materialized (select coalesce(sum(rank), 0) as loose from r{k - 1} where id not in (select src from outdeg)),
r{k} as materialized (select r.id, 0.15 / n + 0.85 * (coalesce(g.got, 0) + loose / n) as rank from r{k - 1} r left join g{k} g on g.id = r.id, n, l{k})"""
    return steps + f" select id, round(rank, 9) as rank from r{rounds}"


@R.add("pagerank_20", _unrolled_pagerank(20))
def pagerank_20(spark, folder):
    """20 rounds without early stop (GR06)."""
    nodes, edges = nodes_edges(spark, folder)
    return graph.pagerank(cut(nodes), cut(edges), rounds=20, tolerance=0).select("id", F.round("rank", 9).alias("rank"))


REACH = CURRENT + """, reach as (select src, dst from edges union select r.src, e.dst from reach r join edges e on e.src = r.dst),
named as (select c.key as id, least(c.key, coalesce(min(a.dst), c.key)) as component from cur c left join reach a on a.src = c.key and exists (select 1 from reach b where b.src = a.dst and b.dst = c.key) group by c.key)
"""
REACH = REACH.replace("with cur", "with recursive cur", 1)


@R.add("strong_components", REACH + "select id, component from named")
def strong_components(spark, folder):
    """Strongly connected components (GR02)."""
    nodes, edges = nodes_edges(spark, folder)
    return graph.components(cut(nodes), cut(edges))


@R.add("cycles", REACH + """select component, count(*) as size, coalesce(bool_or(id in (select src from edges where src = dst)), false) as self_loop from named group by component
having count(*) > 1 or coalesce(bool_or(id in (select src from edges where src = dst)), false)""")
def cycles(spark, folder):
    nodes, edges = nodes_edges(spark, folder)
    return graph.cycles(cut(nodes), cut(edges))


#: An edge goes if it lies on a cycle of edges that aren't less than it.
ACYCLIC = (
    REACH
    + """, inner_ as (select src, dst from edges where src <> dst and exists (select 1 from reach r where r.src = edges.dst and r.dst = edges.src)),
walk as (select src as s, dst as d, dst as here from inner_ union select w.s, w.d, i.dst from walk w join inner_ i on i.src = w.here and (i.src > w.s or i.src = w.s and i.dst > w.d)),
acyclic as (select src, dst from edges where src <> dst except select s, d from walk where here = s)
"""
)


@R.add("acyclic_edges", ACYCLIC + "select src, dst from acyclic")
def acyclic_edges(spark, folder):
    """Edges left after cycles are broken (GR03)."""
    nodes, edges = nodes_edges(spark, folder)
    return graph.break_cycles(cut(nodes), cut(edges))


@R.add(
    "dependency_levels",
    REACH
    + """, bad as (select distinct src from reach where dst in (select src from reach where src = dst)),
walk as (select key as id, 0 as level from cur where key not in (select src from bad) union select e.src, w.level + 1 from walk w join edges e on e.dst = w.id where e.src not in (select src from bad))
select c.key as id, max(level) as level from cur c left join walk w on w.id = c.key group by c.key""",
)
def dependency_levels(spark, folder):
    """Levels for parallel work (GR04 in its parallel form); null on cycles and above them."""
    nodes, edges = nodes_edges(spark, folder)
    return graph.levels(cut(nodes), cut(edges))


#: Dependencies of each component as a sorted list, without cycles.
AFTER = (
    ACYCLIC
    + """, adj as (select c.repo_name, c.id, coalesce((select list_sort(list(x.id)) from acyclic a join cur x on x.key = a.dst where a.src = c.key), []) as deps from cur c where c.id is not null and c.repo_name is not null),
"""
)


@R.add(
    "dependency_first_order",
    AFTER
    + """roots as (select repo_name, list_sort(list(id)) as ids from adj group by 1),
step as (select repo_name, cast([] as varchar[]) as stack, cast([] as varchar[]) as seen, cast([] as varchar[]) as out from roots
  union all
  select repo_name, case when nxt is null then stack[:-2] else list_append(stack, nxt) end, case when nxt is null then seen else list_append(seen, nxt) end, case when nxt is null then list_append(out, stack[-1]) else out end
  from (select s.*, list_filter(case when len(s.stack) = 0 then r.ids else a.deps end, lambda x: not list_contains(s.seen, x))[1] as nxt
        from step s join roots r using (repo_name) left join adj a on a.repo_name = s.repo_name and a.id = s.stack[-1]) where nxt is not null or len(stack) > 0),
final as (select s.repo_name, s.out from step s join roots r using (repo_name) where len(s.out) = len(r.ids))
select repo_name, unnest(out) as id, cast(generate_subscripts(out, 1) - 1 as bigint) as ord from final""",
)
def dependency_first_order(spark, folder):
    """Depth-first post-order per repository after cycles are broken (GR05)."""
    rows = current(spark, folder)
    nodes = rows.select("repo_name", "id")
    edges = rows.select("repo_name", F.col("id").alias("src"), F.explode("depends_on").alias("dst")).withColumn("dst", F.trim("dst")).distinct()
    edges = edges.join(nodes.withColumnRenamed("id", "dst"), ["repo_name", "dst"], "left_semi").select("repo_name", "src", "dst")
    return graph.exact_order(nodes, edges, "repo_name")


@R.add(
    "kahn_order",
    AFTER
    + """heap as (select repo_name, cast([] as varchar[]) as out from adj group by 1
  union all
  select repo_name, list_append(out, nxt) from (select h.repo_name, h.out, min(a.id) as nxt from heap h join adj a on a.repo_name = h.repo_name and not list_contains(h.out, a.id) and list_has_all(h.out, a.deps) group by 1, 2)),
last as (select repo_name, arg_max(out, len(out)) as out from heap group by 1)
select repo_name, unnest(out) as id, cast(generate_subscripts(out, 1) - 1 as bigint) as ord from last""",
)
def kahn_order(spark, folder):
    """Kahn's order with the least id first, per repository after cycles are broken (GR04)."""
    rows = current(spark, folder)
    nodes = rows.select("repo_name", "id")
    edges = rows.select("repo_name", F.col("id").alias("src"), F.explode("depends_on").alias("dst")).withColumn("dst", F.trim("dst")).distinct()
    edges = edges.join(nodes.withColumnRenamed("id", "dst"), ["repo_name", "dst"], "left_semi").select("repo_name", "src", "dst")
    return graph.exact_order(nodes, edges, "repo_name", "kahn")


@R.add("influence")
def influence(spark, folder):
    """Composite influence with betweenness from 200 sources by hash and at most 50 rounds of rank, to a change of 1e-8, as
    the reference's defaults (GR07, GR10); tested on hand-made graphs."""
    nodes, edges = nodes_edges(spark, folder)
    return graph.influence(cut(nodes), cut(edges), samples=200, rounds=50, tolerance=1e-8).select("id", "in_degree", "out_degree", *[F.round(c, 6).alias(c) for c in ("betweenness", "pagerank", "score")])


@R.add("file_edges", CURRENT + "select src_file as src, dst_file as dst, count(*) as weight from attr where src_file <> dst_file group by all")
def file_edges(spark, folder):
    return fold.file_edges(attributed(spark, folder))


@R.add("package_edges", CURRENT + "select src_pkg as src, dst_pkg as dst, count(*) as weight from attr where src_pkg <> dst_pkg group by all")
def package_edges(spark, folder):
    return fold.package_edges(attributed(spark, folder))


HUBS = CURRENT + """, pe as (select src_pkg as src, dst_pkg as dst, count(*) as weight from attr where src_pkg <> dst_pkg group by all),
pk as (select distinct case when position('/' in path) = 0 then '(root)' else split_part(path, '/', 1) end as id from cur),
hub as (select pk.id, coalesce(i.n, 0) as in_edges, coalesce(o.n, 0) as out_edges, cast(coalesce(i.w, 0) as bigint) as in_weight, cast(coalesce(o.w, 0) as bigint) as out_weight from pk
  left join (select dst, count(*) as n, sum(weight) as w from pe group by dst) i on i.dst = pk.id left join (select src, count(*) as n, sum(weight) as w from pe group by src) o on o.src = pk.id
  order by in_weight desc, out_weight desc, in_edges desc, out_edges desc, pk.id limit 20)
"""


@R.add("package_hubs", HUBS + "select * from hub")
def package_hubs(spark, folder):
    """The 20 packages that matter most (AGG05, AGG06, WIN02)."""
    ids = current(spark, folder).select(T.package_of("path").alias("id"))
    return fold.hubs(ids, package_edges(spark, folder))


@R.add("hub_lines", HUBS + "select '- ' || id || ': in ' || in_weight || ' (' || in_edges || ' edges), out ' || out_weight || ' (' || out_edges || ' edges)' as line from hub")
def hub_lines(spark, folder):
    return fold.hub_lines(package_hubs(spark, folder))


@R.add("strongest_file_edges", CURRENT + "select src_file as src, dst_file as dst, count(*) as weight from attr where src_file <> dst_file group by all order by weight desc, src, dst limit 40")
def strongest_file_edges(spark, folder):
    return fold.strongest(file_edges(spark, folder))


@R.add("edge_lines", CURRENT + "select '- ' || src_file || ' -> ' || dst_file || ' (' || count(*) || ')' as line from attr where src_file <> dst_file group by src_file, dst_file order by count(*) desc, src_file, dst_file limit 40")
def edge_lines(spark, folder):
    return fold.edge_lines(strongest_file_edges(spark, folder))


@R.add("callers_outside", CURRENT + "select dst as id, count(distinct src_file) as callers, count(*) as edges from attr where src_file <> dst_file group by dst")
def callers_outside(spark, folder):
    return fold.callers_outside(attributed(spark, folder))


@R.add(
    "representatives_top8",
    CURRENT
    + """, outside as (select dst as id, count(distinct src_file) as callers, count(*) as edges from attr where src_file <> dst_file group by dst),
r as (select c.key as id, c.path as relative_path, component_type, coalesce(o.callers, 0) as callers, coalesce(o.edges, 0) as edges, coalesce(has_docstring, false) as documented,
  row_number() over (partition by c.path order by coalesce(o.callers, 0) desc, coalesce(o.edges, 0) desc, coalesce(has_docstring, false) desc, component_type = 'class' desc, c.key desc) as place
  from cur c left join outside o on o.id = c.key where component_type in ('class', 'function') and split_part(c.key, '.', -1) not like '\\_%' escape '\\')
select * from r where place <= 8""",
)
def representatives_top8(spark, folder):
    rows = current(spark, folder).select(F.col("key").alias("id"), F.col("path").alias("relative_path"), "component_type", "has_docstring")
    return fold.representatives(rows, callers_outside(spark, folder)).withColumn("place", F.col("place").cast("long"))


@R.add("package_files", CURRENT + "select case when position('/' in path) = 0 then '(root)' else split_part(path, '/', 1) end as pkg, list_sort(list(distinct path)) as files from cur group by 1")
def package_files(spark, folder):
    return fold.package_files(current(spark, folder).select(F.col("path").alias("relative_path")))


@R.add("class_methods", CURRENT + """, m as (select repo_name || ':' || regexp_replace(id, '\\.[^.]*$', '') as class_id, list_sort(list(key)) as methods from cur where component_type = 'method' and split_part(id, '.', -1) <> '__init__' group by 1)
select c.key as class_id, coalesce(m.methods, []) as methods from cur c left join m on m.class_id = c.key where c.component_type = 'class'""")
def class_methods(spark, folder):
    """Methods of each class but constructors (AGG12, EXT13, JN10)."""
    return lookups.class_methods(current(spark, folder).select(F.col("key").alias("id"), "component_type"))


@R.add("callers_of", CURRENT + "select dst as id, src as caller from edges where dst in (select key from cur where component_type = 'class')")
def callers_of(spark, folder):
    """Who uses each class (GR14)."""
    _, edges = nodes_edges(spark, folder)
    return graph.callers(edges, current(spark, folder).where("component_type = 'class'").select(F.col("key").alias("id")))


@R.add("callers_with_code", SLICED + ", code as (select c.key, md5(case when start_line > 0 and end_line >= start_line then array_to_string(list_slice(string_split(replace(content, chr(13) || chr(10), chr(10)), chr(10)), start_line, end_line), chr(10)) end) as code_md5 from cur c left join f on f.repo_name = c.repo_name and f.relative_path = c.relative_path) select dst as id, src as caller, code_md5 from edges join code on code.key = src where dst in (select key from cur where component_type = 'class')")
def callers_with_code(spark, folder):
    """Who uses each class, with code (GR14)."""
    return callers_of(spark, folder).join(source_slices(spark, folder).withColumnRenamed("id", "caller"), "caller")


@R.add("plain_hub_lines", DEGREES + "select cast(row_number() over (order by in_degree desc, out_degree desc, id desc) as integer) as place, '- ' || id || ' (in=' || in_degree || ' out=' || out_degree || ')' as line from deg order by 1 limit 50")
def plain_hub_lines(spark, folder):
    """Hubs of a graph of plain ids (FIL15)."""
    return fold.plain_hubs(*nodes_edges(spark, folder))


@R.add(
    "code_signatures",
    SLICED
    + """, s as (select c.key as id, component_type = 'class' as is_class, regexp_replace(split_part(array_to_string(list_slice(string_split(replace(content, chr(13) || chr(10), chr(10)), chr(10)), start_line, end_line), chr(10)), chr(10), 1), '^\\s+|\\s+$', '', 'g') as line
  from cur c join f on f.repo_name = c.repo_name and f.relative_path = c.relative_path where start_line > 0 and end_line >= start_line and content is not null),
e as (select *, coalesce(list_filter(range(1, length(line) + 1), lambda i: substring(line, i, 1) = ')' and len(string_split(left(line, i), '(')) = len(string_split(left(line, i), ')')))[1], 0) as closing from s),
p as (select *, case when closing = 0 then 0 else position(':' in substring(line, closing)) end as colon from e)
select id, case when is_class or colon = 0 then line else left(line, closing + colon - 1) end as signature from p""",
)
def code_signatures(spark, folder):
    """The signature in the first line of each component's code (STR07)."""
    files = table(spark, folder, "source_files").select("repo_name", "relative_path", "content").where("content is not null").distinct()
    rows = current(spark, folder).join(files, ["repo_name", "relative_path"]).withColumn("code", T.line_slice("content", "start_line", "end_line")).where("code is not null")
    return rows.select(F.col("key").alias("id"), T.code_signature("code", F.coalesce(F.col("component_type") == "class", F.lit(False))).alias("signature"))


@R.add("type_counts", CURRENT + "select t.component_type, coalesce(n, 0) as n from (values ('class'), ('function'), ('method')) t(component_type) left join (select component_type, count(*) as n from cur group by 1) c using (component_type)")
def type_counts(spark, folder):
    """Three fixed kinds, also those without rows (AGG13)."""
    kinds = spark.createDataFrame([("class",), ("function",), ("method",)], "component_type string")
    counts = current(spark, folder).groupBy("component_type").agg(F.count(F.lit(1)).alias("n"))
    return kinds.join(counts, "component_type", "left").select("component_type", F.coalesce("n", F.lit(0)).alias("n"))


@R.add("dependency_stats", DEGREES + "select cast(sum(out_degree) as bigint) as total, round(avg(out_degree), 6) as average, max(out_degree) as most, arg_max(id, struct_pack(a := out_degree, b := id)) as most_id from deg")
def dependency_stats(spark, folder):
    """Sum, average and the component with most dependencies, by count and id (AGG14)."""
    top = F.max(F.struct("out_degree", "id"))
    return degrees(spark, folder).agg(F.sum("out_degree").alias("total"), F.round(F.avg("out_degree"), 6).alias("average"), top.alias("t")).select("total", "average", F.col("t.out_degree").alias("most"), F.col("t.id").alias("most_id"))


@R.add("doc_items", CURRENT + """select key as component_id, component_type as kind, coalesce(nullif(file_path, ''), nullif(relative_path, ''), '') as location,
case when component_type = 'class' then 'class ' || split_part(id, '.', -1) else 'def ' || split_part(id, '.', -1) || '(...)' end as signature, coalesce(docstring, '') as content, repo_name, relative_path from cur""")
def doc_items(spark, folder):
    rows = current(spark, folder).drop("id").withColumnRenamed("key", "id")
    return extraction.doc_items(rows)


@R.add("nontrivial_components", CURRENT + """, i as (select key as component_id, lower(case when component_type = 'class' then '' else split_part(id, '.', -1) end) as name, component_type as kind, coalesce(docstring, '') as doc from cur),
n as (select *, trim(regexp_replace(doc, '[\\s\\x{a0}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+', ' ', 'g')) as t from i)
select component_id from n where not (case when name = '' then false when name in ('__repr__', '__str__', '__len__', '__iter__', '__getitem__', '__setitem__') then true
when regexp_matches(name, '^(get_|set_|is_|has_)') then length(t) < 80 else kind in ('function', 'method') and length(t) < 40 and regexp_matches(lower(t), 'getter|setter|returns|return|get|set') end)""")
def nontrivial_components(spark, folder):
    """Components worth enriching (FIL02, FIL03); the tables' docstrings hold no examples blocks."""
    return doc_items(spark, folder).where(~T.trivial("signature", "kind", "content")).select("component_id")


@R.add("component_kinds", CURRENT + """select key as id, case when len(string_split(id, '.')) < 2 then null when len(string_split(id, '.')) >= 3 and regexp_matches(string_split(id, '.')[-2], '^\\p{Lu}') then 'method'
when regexp_matches(string_split(id, '.')[-1], '^\\p{Lu}') then 'class' else 'function' end as kind from cur""")
def component_kinds(spark, folder):
    """What each dotted path leads to (FIL09)."""
    return current(spark, folder).select(F.col("key").alias("id"), T.route("id").alias("kind"))


@R.add("display_names", CURRENT + "select key as id, case when component_type = 'method' and len(string_split(id, '.')) > 2 then split_part(id, '.', -2) || '.' || split_part(id, '.', -1) else split_part(id, '.', -1) end as name from cur")
def display_names(spark, folder):
    return current(spark, folder).select(F.col("key").alias("id"), T.display_name("id", "component_type").alias("name"))


@R.add("public_components", CURRENT + "select key as id from cur where component_type in ('class', 'function') and split_part(id, '.', -1) not like '\\_%' escape '\\'")
def public_components(spark, folder):
    return current(spark, folder).where(F.col("component_type").isin("class", "function") & ~T.last_segment("id").startswith("_")).select(F.col("key").alias("id"))


@R.add("worked_components", CURRENT + "select key as id from cur where id not like '%.\\_\\_init\\_\\_' escape '\\'")
def worked_components(spark, folder):
    """Constructors are skipped (FIL05)."""
    return current(spark, folder).where(T.last_segment("id") != "__init__").select(F.col("key").alias("id"))


@R.add("source_slices", SLICED + """select c.key as id, md5(case when start_line > 0 and end_line >= start_line then array_to_string(list_slice(string_split(replace(content, chr(13) || chr(10), chr(10)), chr(10)), start_line, end_line), chr(10)) end) as code_md5
from cur c left join f on f.repo_name = c.repo_name and f.relative_path = c.relative_path""")
def source_slices(spark, folder):
    """Code of each component by its lines; null without file or lines (SRC04, JN06)."""
    files = table(spark, folder, "source_files").select("repo_name", "relative_path", "content").distinct()
    joined = lookups.source_of(current(spark, folder), files, ["repo_name", "relative_path"])
    return joined.select(F.col("key").alias("id"), F.md5(T.line_slice("content", "start_line", "end_line")).alias("code_md5"))


@R.add("resume_remaining", CURRENT + "select key as component_id from cur where key not in (select repo_name || ':' || component_id from agent_log where agent = 'writer' and component_id is not null)")
def resume_remaining(spark, folder):
    """Components the writer hasn't worked on (JN03, STM01, SET05)."""
    done = table(spark, folder, "agent_log").where("agent = 'writer'").select(F.concat(F.col("repo_name"), F.lit(":"), F.col("component_id")).alias("component_id"))
    return incremental.resume(current(spark, folder).select(F.col("key").alias("component_id")), done, "component_id")


@R.add("resume_items", CURRENT + """select key as component_id from cur c where not exists (select 1 from stage_b_function_items b where b.repo_name = c.repo_name and coalesce(b.location, '') || '::' || coalesce(b.signature, '') =
c.relative_path || '::' || (case when component_type = 'class' then 'class ' || split_part(id, '.', -1) else 'def ' || split_part(id, '.', -1) || '(...)' end))""")
def resume_items(spark, folder):
    """Items without a cached result by location and signature (JN04, SRC08)."""
    items = current(spark, folder).select(F.col("key").alias("component_id"), F.concat_ws(" ", "repo_name", "relative_path").alias("location"), T.component_signature("id", F.col("component_type")).alias("signature"))
    cached = table(spark, folder, "stage_b_function_items").select(F.concat_ws(" ", "repo_name", "location").alias("location"), "signature")
    return incremental.resume_items(items, cached).select("component_id")


@R.add("pending_files", CURRENT + "select distinct repo_name, relative_path as file from cur where not exists (select 1 from stage_b_file_summaries s where s.repo_name = cur.repo_name and s.file = cur.relative_path)")
def pending_files(spark, folder):
    files = current(spark, folder).select("repo_name", F.col("relative_path").alias("file")).distinct()
    return lookups.remaining(files, table(spark, folder, "stage_b_file_summaries"), ["repo_name", "file"]).select("repo_name", "file")


@R.add("pending_modules", CURRENT + """select distinct repo_name, case when position('/' in relative_path) = 0 then '(root)' else split_part(relative_path, '/', 1) end as module from cur
where not exists (select 1 from stage_b_module_summaries s where s.repo_name = cur.repo_name and s.module = case when position('/' in relative_path) = 0 then '(root)' else split_part(relative_path, '/', 1) end)""")
def pending_modules(spark, folder):
    modules = current(spark, folder).select("repo_name", T.package_of("relative_path").alias("module")).distinct()
    return lookups.remaining(modules, table(spark, folder, "stage_b_module_summaries"), ["repo_name", "module"]).select("repo_name", "module")


@R.add("rollup_counts", """with x as (select case when position('/' in location) = 0 then '(root)' else split_part(location, '/', 1) end as module, location as file from (select distinct * from stage_b_function_items))
select module, file, count(*) as items from x group by rollup(module, file)""")
def rollup_counts(spark, folder):
    """Items per file, module and in all (AGG07, AGG08)."""
    items = table(spark, folder, "stage_b_function_items").distinct().withColumn("file", F.col("location"))
    return incremental.counts_up(items)


@R.add("summary_defaults", """with f as (select repo_name, file, min(file_summary) as file_summary from stage_b_file_summaries group by all), s as (select distinct repo_name, relative_path as file from source_files)
select s.repo_name, s.file, coalesce(nullif(f.file_summary, ''), '(no file summary)') as file_summary from s left join f using (repo_name, file)""")
def summary_defaults(spark, folder):
    """Files with their summary or a stand-in (JN09)."""
    files = table(spark, folder, "source_files").select("repo_name", F.col("relative_path").alias("file")).distinct()
    return lookups.with_defaults(files, one_summary(spark, folder), ["repo_name", "file"], {"file_summary": render.NO_FILE})


def one_summary(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "stage_b_file_summaries").groupBy("repo_name", "file").agg(F.min("file_summary").alias("file_summary"))


@R.add("contains_first_match", """with i as (select distinct item_id, repo_name, location from stage_b_function_items where location is not null), k as (select distinct file from stage_b_file_summaries where file <> '')
select item_id, min(file) as file from i join k on contains(location, file) group by item_id, i.repo_name, location""")
def contains_first_match(spark, folder):
    """The first file key that an item's location contains, anywhere (JN08, WIN16)."""
    items = table(spark, folder, "stage_b_function_items").where("location is not null").select("item_id", "repo_name", "location").distinct()
    return lookups.containing(items, _file_keys(spark, folder), "location", "file", "ord", anywhere=True).select("item_id", "file")


def _file_keys(spark, folder):
    return table(spark, folder, "stage_b_file_summaries").where("file is not null").select("file", F.col("file").alias("ord")).distinct()


@R.add("segments_first_match", """with i as (select distinct item_id, repo_name, location from stage_b_function_items where location is not null), k as (select distinct file from stage_b_file_summaries where file is not null)
select item_id, min(file) as file from i join k on ('/' || location || '/') like '%/' || replace(replace(file, '_', '\\_'), '%', '\\%') || '/%' escape '\\' group by item_id, i.repo_name, location""")
def segments_first_match(spark, folder):
    """The first file key that stands in an item's location at whole segments."""
    items = table(spark, folder, "stage_b_function_items").where("location is not null").select("item_id", "repo_name", "location").distinct()
    return lookups.containing(items, _file_keys(spark, folder), "location", "file", "ord").select("item_id", "file")


@R.add("similar_code", None)
def similar_code(spark, folder):
    """Functions, methods and classes of one name with nearly the same code (JN18); tested against a plain loop.

    Pairs are formed between different codes; a copy has one row, of similarity 1, to the least key with its code, and
    stands for that key's pairs too. Classes are similar by name alone, so each has one row to the least key of its name.
    """
    own = extraction.components(extraction.parse_files(table(spark, folder, "source_files"), links=False))
    return similar_components(cut(own.select(F.concat_ws(":", "repo_name", "id").alias("key"), F.col("component_type").alias("kind"), T.last_segment("id").alias("name"), "code")))


def similar_components(rows):
    """(a, b, similarity) of (key, kind, name, code)."""
    named = F.ltrim("code").startswith("class ")
    code, classes = rows.where(~named), rows.where(named).select("name", F.col("key").alias("b"), T.tidy_lines("code").alias("y"))
    pairs = lookups.similar_pairs(code, "key", "code", ["kind", "name"])
    copies = lookups.equal_code(code, "key", "code", ["kind", "name"]).withColumn("similarity", F.lit(1.0))
    least = classes.groupBy("name").agg(F.min(F.struct("b", "y")).alias("r")).select("name", F.col("r.b").alias("a"), F.col("r.y").alias("x"))
    by_name = skew.split_join(classes, least, ["name"], "inner").where(F.col("a") < F.col("b")).select("a", "b", F.round(places.share_equal("x", "y"), 6).alias("similarity"))
    return pairs.unionByName(copies).unionByName(by_name)


@R.add("extracted_components", None)
def extracted_components(spark, folder):
    """Components out of the sources themselves (EXT01-EXT05); tested on fixtures."""
    parsed = extraction.parse_files(table(spark, folder, "source_files"))
    return extraction.components(parsed).select("repo_name", "id", "component_type", "relative_path", "start_line", "end_line", "has_docstring", "docstring")


@R.add("extracted_imports", None)
def extracted_imports(spark, folder):
    return extraction.imports(extraction.parse_files(table(spark, folder, "source_files")))


@R.add("extracted_dependencies", None)
def extracted_dependencies(spark, folder):
    """Dependencies resolved by imports and modules (EXT06-EXT14); tested on fixtures."""
    return extraction.dependencies(cut(extraction.parse_files(table(spark, folder, "source_files"))))


@R.add("extracted_calls", None)
def extracted_calls(spark, folder):
    """Call sites of the sources joined with their definitions (JN17); tested on fixtures."""
    parsed = cut(extraction.parse_files(table(spark, folder, "source_files")))
    defs = extraction.definition_sites(parsed)
    return lookups.callers_in_order(lookups.edges_by_call(extraction.call_sites(parsed), defs), defs)


def sites(spark, folder):
    """Definitions and call sites out of the graph: a dependency within a file counts as a call of what it names."""
    rows = current(spark, folder).withColumn("parts", F.split("id", r"\."))
    name, owner = F.element_at("parts", -1), F.when(F.col("component_type") == "method", F.try_element_at("parts", F.lit(-2)))
    own = cut(rows.where("path is not null and id is not null").select(F.col("path").alias("file"), F.col("key").alias("id"), owner.alias("class"), name.alias("name"), "component_type"))
    deps = all_deps(rows).select("src", "dst").distinct()
    a = own.select(F.col("id").alias("src"), "file", F.col("class").alias("caller_class"))
    b = own.select(F.col("id").alias("dst"), F.col("file").alias("target_file"), "class", "name")
    met = deps.join(a, "src").join(b, "dst").where("file = target_file")
    prefix = F.when(F.col("class") == F.col("caller_class"), "self").otherwise(F.col("class"))
    calls = met.select("file", F.col("src").alias("caller"), "caller_class", prefix.alias("prefix"), "name", F.lit(None).cast("string").alias("var_class"))
    return own.where("component_type <> 'class'").drop("component_type"), calls


CALLS = (
    CURRENT
    + """, own as (select path as file, key as id, case when component_type = 'method' and len(string_split(id, '.')) > 1 then split_part(id, '.', -2) end as class, split_part(id, '.', -1) as name, component_type from cur where path is not null and id is not null),
site as (select a.file, a.id as caller, a.class as caller_class, b.class, b.name from (select distinct src, dst from deps) d join own a on a.id = d.src join own b on b.id = d.dst and b.file = a.file),
def as (select * from own where component_type <> 'class'),
called as (
  select s.caller, d.id as callee from site s join def d on d.file = s.file and d.name = s.name and d.class = s.class
  union select s.caller, d.id from site s join def d on d.file = s.file and s.class is null and d.class is null and d.name = s.name
  union select s.caller, d.id from site s join def d on d.file = s.file and s.class is null and d.class = s.name and d.name = '__init__')
"""
)


@R.add("call_edges", CALLS + "select caller, callee from called")
def call_edges(spark, folder):
    """Call sites joined with definitions by name, class and constructor (JN13-JN15)."""
    defs, calls = sites(spark, folder)
    return lookups.edges_by_call(calls, defs)


@R.add("callers_by_branch", CALLS + "select callee as id, caller, cast(case when d.class is null then 0 when d.name = '__init__' then 2 else 1 end as integer) as branch from called join def d on d.id = caller")
def callers_by_branch(spark, folder):
    """Callers: functions, methods, constructors (JN16)."""
    defs, calls = sites(spark, folder)
    return lookups.callers_in_order(lookups.edges_by_call(calls, defs), defs)


@R.add(
    "requested_dependencies",
    CURRENT
    + """, d as (select src as id, case when regexp_matches(split_part(target, '.', -1), '^\\p{Lu}') then 'class' when len(string_split(target, '.')) >= 2 and regexp_matches(split_part(target, '.', -2), '^\\p{Lu}') then 'method' when len(string_split(target, '.')) >= 2 then 'function' end as kind, target as dst, cast(md5_number_lower(dst) & 1048575 as bigint) as ord from deps),
r as (select distinct id, kind, split_part(dst, '.', -1) as req from d where kind is not null), q as (select *, row_number() over (partition by id, kind order by req) as pos from r),
m as (select q.id, q.kind, q.pos, q.req, d.ord, d.dst from q join d using (id, kind) where q.req = split_part(d.dst, '.', -1) or contains(d.dst, q.req)),
a as (select *, row_number() over (partition by id, kind, dst order by pos) as first from m), b as (select *, row_number() over (partition by id, kind, req order by ord desc, dst desc) as last from a where first = 1)
select id, kind, req, dst from b where last = 1""".replace("cast(md5_number_lower(dst) & 1048575 as bigint)", "length(target)"),
)
def requested_dependencies(spark, folder):
    """What each requested name leads to (JN11, WIN16): the last segments of a component's dependencies, as its requests."""
    deps = all_deps(current(spark, folder)).select(F.col("src").alias("id"), T.request_route("target").alias("kind"), F.struct(F.length("target"), "target").alias("ord"), F.col("target").alias("dst")).where("kind is not null").distinct()
    names = deps.select("id", "kind", T.last_segment("dst").alias("req")).distinct()
    asked = names.withColumn("pos", F.row_number().over(Window.partitionBy("id", "kind").orderBy("req")))
    return lookups.requested(asked, deps)


@R.add("request_kinds", CURRENT + """select key as id, case when regexp_matches(split_part(id, '.', -1), '^\\p{Lu}') then 'class' when len(string_split(id, '.')) >= 2 and regexp_matches(split_part(id, '.', -2), '^\\p{Lu}') then 'method' when len(string_split(id, '.')) >= 2 then 'function' end as kind from cur""")
def request_kinds(spark, folder):
    """What a requested dotted name is (FIL10)."""
    return current(spark, folder).select(F.col("key").alias("id"), T.request_route("id").alias("kind"))


@R.add("class_method_edges", CURRENT + "select repo_name || ':' || regexp_replace(id, '\\.[^.]*$', '') as src, key as dst from cur where component_type = 'method' and split_part(id, '.', -1) <> '__init__' and repo_name || ':' || regexp_replace(id, '\\.[^.]*$', '') in (select key from cur where component_type = 'class')")
def class_method_edges(spark, folder):
    """Classes on their methods (EXT13)."""
    return lookups.class_method_edges(current(spark, folder).select(F.col("key").alias("id"), "component_type"))


@R.add("all_nodes", CURRENT + "select key as id from cur union select src from deps union select dst from deps")
def all_nodes(spark, folder):
    """Components and all that they name (GR01, SET01)."""
    rows = current(spark, folder)
    return graph.normal_nodes(rows.select(F.col("key").alias("id")), all_deps(rows))


@R.add("component_defaults", CURRENT + "select key, coalesce(depends_on, []) as depends_on, coalesce(start_line, 0) as start_line, coalesce(end_line, 0) as end_line, coalesce(has_docstring, false) as has_docstring, coalesce(docstring, '') as docstring from cur")
def component_defaults(spark, folder):
    """Components with defaults for what is missing (EXT02)."""
    return readers.defaults(current(spark, folder).select("key", "depends_on", "start_line", "end_line", "has_docstring", "docstring"))


@R.add("signature_names", "select distinct signature, regexp_extract(signature, '\\b([A-Za-z_]\\w*)\\s*\\(', 1) as name from stage_b_function_items where signature is not null")
def signature_names(spark, folder):
    """The name in each signature (STR06, EXT03)."""
    rows = table(spark, folder, "stage_b_function_items").where("signature is not null").select("signature").distinct()
    return rows.select("signature", T.name_in_signature("signature").alias("name"))


@R.add("paths_below_root", CURRENT + """select distinct file_path, case when starts_with(file_path, '/srv/scan/quillmere/') then substring(file_path, 21) else split_part(file_path, '/', -1) end as below,
case when split_part(ltrim(file_path, '/'), '/', 1) = 'srv' then regexp_replace(ltrim(file_path, '/'), '^[^/]*/?', '') else ltrim(file_path, '/') end as bare from cur where file_path is not null""")
def paths_below_root(spark, folder):
    """Paths below a root, and without its first segment (FIL13, FIL17)."""
    rows = current(spark, folder).where("file_path is not null").select("file_path").distinct()
    return rows.select("file_path", T.relative_to("file_path", "/srv/scan/quillmere").alias("below"), T.without_root("file_path", "srv").alias("bare"))


@R.add("cached_and_new", "select item_id, business_summary from (select distinct item_id, business_summary from stage_b_function_items where business_summary is not null union all select distinct item_id, 'new' from stage_b_function_items where business_summary is null)")
def cached_and_new(spark, folder):
    """Cached rows and new ones together (SET04)."""
    rows = table(spark, folder, "stage_b_function_items").select("item_id", "business_summary").distinct()
    return incremental.with_cached(rows.where("business_summary is not null"), rows.where("business_summary is null").withColumn("business_summary", F.lit("new")))


@R.add("inherited_methods", None)
def inherited_methods(spark, folder):
    """Where each class gets its methods' names from, along bases of the file (JN12)."""
    parsed = cut(extraction.parse_files(table(spark, folder, "source_files")))
    defs = extraction.definition_sites(parsed).where("class is not null").select("file", "class", F.col("name").alias("method"))
    bases = extraction.class_bases(parsed)
    asked = bases.select("file", "class").join(defs.select("file", "method").distinct(), "file")
    return lookups.inherited(asked, bases, defs)


TREE = "with f as (select distinct repo_name, relative_path as path from source_files where relative_path <> '')"


TREE_NODES = (
    TREE
    + """, d as (select distinct repo_name, array_to_string(list_slice(string_split(path, '/'), 1, i), '/') as path from f, range(1, 64) r(i) where i < len(string_split(path, '/'))),
t as (select repo_name, path, case when path like '%/%' then regexp_replace(path, '/[^/]*$', '') else '' end as parent_path, split_part(path, '/', -1) as name, type, case when type = 'file' then coalesce(nullif(regexp_extract(split_part(path, '/', -1), '^.+\\.([^.]+)$', 1), ''), 'none') end as extension,
  cast(len(string_split(path, '/')) as integer) as depth from (select *, 'file' as type from f union all select *, 'directory' from d)
  where not regexp_matches(path, '(^|/)(\\.git|__pycache__|\\.pytest_cache|\\.env|venv|node_modules|\\.DS_Store|[^/]*\\.pyc|[^/]*\\.pyo|[^/]*\\.pyd|\\.Python|[^/]*\\.so)(/|$)'))
"""
)


@R.add("tree_nodes", TREE_NODES + "select * from t")
def tree_nodes(spark, folder):
    """The directory tree of every repository (SRC10, STR13, FIL01)."""
    return trees.paths_to_tree(table(spark, folder, "source_files"), ["repo_name"], "relative_path")


@R.add(
    "tree_text",
    TREE_NODES
    + """, l as (select repo_name, path, repeat('│   ', depth - 1) || case when type = 'directory' then '├── ' || name || '/' when lead(name) over (partition by repo_name, parent_path order by name) is null then '└── ' || name else '├── ' || name end as line from t)
select repo_name, string_agg(line, chr(10) order by replace(path, '/', chr(1))) as text from l group by 1""",
)
def tree_text(spark, folder):
    """The trees as text (RND07)."""
    return trees.tree_text(tree_nodes(spark, folder), ["repo_name"])


@R.add("file_counts", TREE + " select repo_name, count(*) as files from f group by 1")
def file_counts(spark, folder):
    return trees.count_files(tree_nodes(spark, folder), ["repo_name"])


INDEX = "select repo_name, 'INDEX.md' as path, '# Repo Wiki' || chr(10) || chr(10) || '## Pages' || chr(10) || chr(10) || string_agg('- [' || path || '](pages/file/' || path || '.md)', chr(10) order by replace(path, '/', chr(1))) || chr(10) || chr(10) || '- [Architecture](ARCHITECTURE.md)' || chr(10) || '- [Context](CONTEXT.md)' || chr(10) as content"


@R.add("index_pages", TREE + INDEX + " from f group by 1")
def index_pages(spark, folder):
    return render.index_page(tree_nodes(spark, folder))


def _wiki_parts(spark, folder):
    modules = table(spark, folder, "stage_b_module_summaries").groupBy("repo_name", "module").agg(F.min("module_summary").alias("module_summary"))
    items = table(spark, folder, "stage_b_function_items").distinct().select("repo_name", F.col("location").alias("file"), "signature", "business_summary")
    return tree_nodes(spark, folder), modules, one_summary(spark, folder), items


PAGES = (
    TREE_NODES
    + """, link as (select repo_name, path, parent_path, name, type, '](pages/' || case when type = 'file' then 'file/' else 'dir/' end || path || '.md)' as target from t),
ms as (select repo_name, module, min(module_summary) as module_summary from stage_b_module_summaries group by all),
fs as (select repo_name, file, min(file_summary) as file_summary from stage_b_file_summaries group by all),
its as (select repo_name, location as file, string_agg('- `' || signature || '`: ' || coalesce(business_summary, ''), chr(10) order by signature, business_summary nulls first) as body from (select distinct * from stage_b_function_items) group by all),
dirs as (select repo_name, parent_path as module, string_agg('- [' || name || target, chr(10) order by name, target) as body from link where parent_path <> '' group by 1, 2),
dir_pages as (select d.repo_name, 'pages/dir/' || module || '.md' as path, '# ' || module || chr(10) || chr(10) || coalesce(nullif(module_summary, ''), '(no module summary)') || chr(10) || chr(10) || body as content from dirs d left join ms using (repo_name, module)),
file_pages as (select l.repo_name, 'pages/file/' || l.path || '.md' as path, '# ' || l.path || chr(10) || chr(10) || coalesce(nullif(file_summary, ''), '(no file summary)') || coalesce(chr(10) || chr(10) || body, '') as content
  from link l left join fs on fs.repo_name = l.repo_name and fs.file = l.path left join its on its.repo_name = l.repo_name and its.file = l.path where type = 'file')
"""
)


@R.add("directory_pages", PAGES + "select * from dir_pages")
def directory_pages(spark, folder):
    tree, modules, _, _ = _wiki_parts(spark, folder)
    return render.directory_pages(tree, modules)


@R.add("file_pages", """with f as (select distinct repo_name, relative_path as file from source_files where relative_path <> ''), s as (select repo_name, file, min(file_summary) as file_summary from stage_b_file_summaries group by all),
i as (select repo_name, location as file, string_agg('- `' || signature || '`: ' || coalesce(business_summary, ''), chr(10) order by signature, business_summary nulls first) as body from (select distinct * from stage_b_function_items) group by all)
select f.repo_name, 'pages/file/' || f.file || '.md' as path, '# ' || f.file || chr(10) || chr(10) || coalesce(nullif(file_summary, ''), '(no file summary)') || coalesce(chr(10) || chr(10) || body, '') as content from f left join s using (repo_name, file) left join i using (repo_name, file)""")
def file_pages(spark, folder):
    tree, _, files, items = _wiki_parts(spark, folder)
    return render.file_pages(tree, files, items)


@R.add(
    "whole_wiki",
    PAGES
    + """, ds as (select repo_name, path, split_part(path, '/', 1) as module from t where type = 'directory' union all select distinct repo_name, '', '(root)' from t),
fsum as (select repo_name, file, min(struct_pack(a := file_summary, b := workflows)) as s from stage_b_file_summaries group by all),
one as (select repo_name, location as path, signature, business_summary, '#### ' || coalesce(signature, '(unknown)') || chr(10) || chr(10) || trim(coalesce(business_summary, ''), chr(32) || chr(9) || chr(10) || chr(13))
  || case when len(business_rules) > 0 then chr(10) || chr(10) || 'Business Rules' || chr(10) || '- ' || array_to_string(business_rules, chr(10) || '- ') else '' end
  || case when len(key_terms) > 0 then chr(10) || chr(10) || 'Key Terms' || chr(10) || '- ' || array_to_string(key_terms, chr(10) || '- ') else '' end as line from (select distinct * from stage_b_function_items)),
pf as (select repo_name, path, string_agg(line, chr(10) order by signature, business_summary nulls first, line) as body from one group by all),
blocks as (
  select repo_name, path, '## Directory: ' || case when path = '' then '(root)' else path end || case when coalesce(module_summary, '') <> '' then chr(10) || chr(10) || trim(module_summary, chr(32) || chr(9) || chr(10) || chr(13)) else '' end || chr(10) as block from ds left join ms using (repo_name, module)
  union all
  select t.repo_name, t.path, '## File: ' || t.path || chr(10) || chr(10) || coalesce(nullif(fsum.s.a, ''), '(no file summary)') || case when len(fsum.s.b) > 0 then chr(10) || chr(10) || '### Workflows' || chr(10) || '- ' || array_to_string(fsum.s.b, chr(10) || '- ') else '' end
    || coalesce(chr(10) || chr(10) || '### Functions / Methods' || chr(10) || body, '') || chr(10) from t left join fsum on fsum.repo_name = t.repo_name and fsum.file = t.path left join pf on pf.repo_name = t.repo_name and pf.path = t.path where type = 'file')
select repo_name, 'WIKI.md' as path, rtrim('# Repo Wiki' || chr(10) || chr(10) || '## Project Context' || chr(10) || chr(10) || chr(10) || chr(10) || '## Architecture Insights' || chr(10) || chr(10) || '- (architecture_insights unavailable)' || chr(10) || chr(10) || '## Reference' || chr(10) || chr(10)
  || string_agg(block, chr(10) order by replace(path, '/', chr(1)), block), chr(10)) || chr(10) as content from blocks group by 1""",
)
def whole_wiki(spark, folder):
    """One page per repository (RND01, RND05)."""
    tree, modules, _, _ = _wiki_parts(spark, folder)
    files = table(spark, folder, "stage_b_file_summaries").groupBy("repo_name", "file").agg(F.min(F.struct("file_summary", "workflows")).alias("s")).select("repo_name", "file", "s.*")
    items = table(spark, folder, "stage_b_function_items").distinct().withColumn("file", F.col("location"))
    return render.wiki(tree, modules, files, items, mode="monolithic")


def _summed_up(name: str, source: str, keys: str, signature: str, text: str, into: str) -> str:
    """Common table expressions that sum ``source`` up as the offline provider does: blocks of 200 lines, and their replies once more."""
    first = r"regexp_extract({}, '(?s)^[\s\x{{0b}}\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]*(.*?(?:[.!?。！？]|\z))', 1)"
    return f"""
{name}_l as (select {keys}, '- ' || coalesce({signature}, '') || ': ' || coalesce({text}, '') as line, row_number() over (partition by {keys} order by {signature} nulls first, '- ' || coalesce({signature}, '') || ': ' || coalesce({text}, '')) - 1 as pos from {source}),
{name}_b as (select {keys}, pos // 200 as block, {first.format("string_agg(line, chr(10) order by pos)")} as reply, count(*) as lines from {name}_l group by {keys}, pos // 200),
{name} as (select {keys}, cast(sum(lines) as bigint) as n, case when sum(lines) <= 200 then min(reply) else {first.format("string_agg(reply, chr(10) order by block)")} end as {into} from {name}_b group by {keys})"""


@R.add(
    "semantic_levels",
    "with i as (select distinct repo_name, location as file, signature, business_summary, item_id, kind, business_rules, key_terms from stage_b_function_items),"
    + _summed_up("f", "i", "repo_name, file", "signature", "business_summary", "file_summary")
    + ", u as (select repo_name, file, file_summary, case when coalesce(file, '') = '' then '(unknown)' when position('/' in file) = 0 then '(root)' else split_part(file, '/', 1) end as module from f),"
    + _summed_up("m", "u", "repo_name, module", "file", "file_summary", "module_summary")
    + " select * from m",
)
def semantic_levels(spark, folder):
    """Summaries of modules out of those of files out of items, with the offline provider (AGG09-AGG11)."""
    items = table(spark, folder, "stage_b_function_items").distinct().select("repo_name", F.col("location").alias("file"), "signature", "business_summary")
    return incremental.aggregate_levels(items)["modules"]


@R.add("group_listing", """select repo_name, location as file, count(*) as n, string_agg('- ' || signature || ': ' || coalesce(business_summary, ''), chr(10) order by signature, '- ' || signature || ': ' || coalesce(business_summary, '')) as listing
from (select distinct * from stage_b_function_items) group by all""")
def group_listing(spark, folder):
    """The prompt of each file's items: all of their lines in order (AGG09)."""
    items = table(spark, folder, "stage_b_function_items").distinct().withColumn("file", F.col("location"))
    return incremental.summaries_up(items, ["repo_name", "file"], "business_summary", "listing", incremental.echo)
