"""Queries p2 and p3: nested records as flat tables, references to records that don't exist."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernel.operators import nested, references
from quernel.session import table


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """One row per node of every tree, with the path of its parent."""
    parts = [("repo_tree", nested.repository_nodes), ("stage_a_context", nested.context_nodes)]
    columns = ["record_id", "node_path", "parent_path", "node_name"]
    (first, second) = (f(table(spark, folder, name)).select(F.lit(name).alias("source_table"), *columns) for name, f in parts)
    return first.unionByName(second).distinct()


def p2_directories(spark: SparkSession, folder: str) -> DataFrame:
    """The node table of type ``directory``, with interval labels and the link to the parent."""
    linked = nested.repository_nodes(table(spark, folder, "repo_tree"))
    return nested.by_type(linked, ["directory", "file"])["directory"].select("record_id", "node_path", "parent_path", "pre", "post", "depth", "node_name")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Each distinct reference that names no component known at its time, with the reason and the month."""
    return references.dangling(table(spark, folder, "dependency_graph"), table(spark, folder, "agent_log"))


def p3_per_period(spark: SparkSession, folder: str) -> DataFrame:
    """Orphan references counted per table, month and reason."""
    return references.per_period(p3_found(spark, folder))


QUERIES = {"p2_found": p2_found, "p2_directories": p2_directories, "p3_found": p3_found, "p3_per_period": p3_per_period}

_ORPHANS = """
with ranked as (
  select *, row_number() over (partition by repo_name, id order by scan_time desc nulls last, ingested_at asc nulls last) as rn,
         min(ingested_at) over (partition by repo_name, id) as first_seen
  from dependency_graph),
current_rows as (select * from ranked where rn = 1),
refs as (
  select distinct 'dependency_graph' as source_table, repo_name, id as record_id, trim(raw, e' \\t\\r\\n') as target_id, moment
  from (select repo_name, id, unnest(depends_on) as raw, ingested_at as moment from current_rows)
  union
  select distinct 'agent_log', repo_name, cast(log_id as varchar), trim(component_id, e' \\t\\r\\n'), logged_at
  from agent_log where trim(component_id, e' \\t\\r\\n') <> 'unknown'),
judged as (
  select r.*, case when c.id is null then 'missing' when c.deleted_at <= r.moment then 'deleted' when c.first_seen > r.moment then 'late' end as reason
  from refs r left join current_rows c on c.repo_name = r.repo_name and c.id = r.target_id
  where r.target_id <> '' and r.repo_name is not null)
"""

#: The nodes of all trees: ``n`` has (source_table, record_id, digest, node_path, parent_path, j). Strings that hold JSON are unwrapped.
_NODES = r"""
with recursive raw as (
  select distinct 'repo_tree' as source_table, record_id, tree_json as t from repo_tree where json_valid(tree_json)
  union select distinct 'stage_a_context', record_id, context_json from stage_a_context where json_valid(context_json)),
whole as (select source_table, record_id, md5(t) as digest, case when json_type(t :: json) = 'VARCHAR' and json_valid((t :: json) ->> '$') then ((t :: json) ->> '$') :: json else t :: json end as j from raw),
tree as (select source_table, record_id, digest, case when source_table = 'repo_tree' then j when json_type(j) = 'OBJECT' then j -> 'context_tree' end as j from whole),
top as (select source_table, record_id, digest, case when json_type(j) = 'VARCHAR' and json_valid(j ->> '$') then (j ->> '$') :: json else j end as j from tree),
n as (
  select source_table, record_id, digest, cast(e.i - 1 as varchar) as node_path, '' as parent_path, case when json_type(e.x) = 'VARCHAR' and json_valid(e.x ->> '$') then (e.x ->> '$') :: json else e.x end as j
  from top, unnest(case json_type(j) when 'ARRAY' then j -> '$[*]' when 'OBJECT' then [j] else [] end) with ordinality as e(x, i)
  where json_type(case when json_type(e.x) = 'VARCHAR' and json_valid(e.x ->> '$') then (e.x ->> '$') :: json else e.x end) = 'OBJECT'
  union all
  select source_table, record_id, digest, node_path || '/' || (e.i - 1), node_path, case when json_type(e.x) = 'VARCHAR' and json_valid(e.x ->> '$') then (e.x ->> '$') :: json else e.x end
  from (select *, case when json_type(k) = 'VARCHAR' and json_valid(k ->> '$') then (k ->> '$') :: json else k end as c from (select *, case when source_table = 'repo_tree' then j -> 'contents' else j -> 'children' end as k from n)) p,
    unnest(case json_type(c) when 'ARRAY' then c -> '$[*]' when 'OBJECT' then [c] else [] end) with ordinality as e(x, i)
  where json_type(case when json_type(e.x) = 'VARCHAR' and json_valid(e.x ->> '$') then (e.x ->> '$') :: json else e.x end) = 'OBJECT')
"""

SQL = {
    "p2_found": _NODES + "select distinct source_table, record_id, node_path, parent_path, coalesce(case when source_table = 'repo_tree' then j ->> 'name' else j ->> 'title' end, '') as node_name from n",
    # pre-order goes by the positions on the path; as many nodes end before a node as begin before it, without those above it, and its own below
    "p2_directories": _NODES
    + """, r as (select *, list_transform(string_split(node_path, '/'), lambda x: x :: bigint) as place from n where source_table = 'repo_tree'),
p as (select *, row_number() over (partition by record_id, digest order by place) - 1 as pre, len(place) - 1 as depth,
  (select count(*) from r d where d.record_id = r.record_id and d.digest = r.digest and starts_with(d.node_path || '/', r.node_path || '/')) as below from r)
select record_id, node_path, parent_path, cast(pre as integer) as pre, cast(pre - depth + below - 1 as integer) as post, cast(depth as integer) as depth, coalesce(j ->> 'name', '') as node_name
from p where lower(trim(j ->> 'type')) = 'directory'""",
    "p3_found": _ORPHANS
    + "select distinct source_table, repo_name, record_id, target_id, reason, strftime(moment, '%Y-%m') as period_month from judged where reason is not null",
    "p3_per_period": _ORPHANS
    + """select source_table, period_month, reason, count(*) as orphans from (
  select distinct source_table, repo_name, record_id, target_id, reason, strftime(moment, '%Y-%m') as period_month from judged where reason is not null)
group by all""",
}
