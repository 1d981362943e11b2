"""Deeply nested records as flat node tables, linked by interval containment."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernel.functions.lenient_json import as_text, parse, unwrap

NODES = "record_id {id}, record_hash long, pre int, post int, depth int, position int, node_path string, node_type string, node_name string"


def number(tree, children: str, name: str, kind: str) -> list[tuple]:
    """(pre, post, depth, position, path, type, name) of every node of ``tree`` by one depth-first traversal.

    Only objects are nodes; they stand in ``children`` as an array or as one object (position 0). Other elements
    keep their position. An array at the top gives several roots. The traversal keeps its own stack.
    """

    def nodes_in(value) -> list[tuple[int, dict]]:
        value = unwrap(value)
        if isinstance(value, dict):
            return [(0, value)]
        return [(i, x) for i, e in enumerate(value) if isinstance(x := unwrap(e), dict)] if isinstance(value, list) else []

    rows: list[list] = []
    pre = post = 0
    stack: list[tuple] = [("in", i, x, str(i), 0) for i, x in reversed(nodes_in(tree))]
    while stack:
        step, i, x, path, depth = stack.pop()
        if step == "out":
            rows[i][1] = post
            post += 1
            continue
        rows.append([pre, 0, depth, i, path, as_text(x.get(kind)), as_text(x.get(name))])
        stack.append(("out", pre, None, path, depth))
        pre += 1
        stack += [("in", j, y, f"{path}/{j}", depth + 1) for j, y in reversed(nodes_in(x.get(children)))]
    return [tuple(r) for r in rows]


def label(df: DataFrame, record_id: Column | str, text: Column | str, children: str, name: str, kind: str, root: str | None = None) -> DataFrame:
    """Interval-labelled nodes of each JSON record: record_id, record_hash, pre, post, depth, position,
    node_path, node_type, node_name.

    ``root`` names the field that holds the tree (None: the record itself). JSON encoded as a JSON string counts
    as what it encodes. Records that are null, empty or not complete, valid JSON give no rows; copies of a record
    count once; missing and null names are empty. Other columns of ``df`` are ignored, so they may clash.
    """
    record_id, text = (F.col(c) if isinstance(c, str) else c for c in (record_id, text))
    records = df.select(record_id.alias("record_id"), text.alias("text")).where(F.col("text").isNotNull()).distinct()
    records = records.withColumn("record_hash", F.xxhash64("text"))

    def flatten(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[tuple] = []
            for key, digest, raw in zip(batch["record_id"], batch["record_hash"], batch["text"]):
                try:
                    tree = unwrap(parse(raw))
                except ValueError:
                    continue
                if root is not None:
                    tree = tree.get(root) if isinstance(tree, dict) else None
                out += [(key, digest, *row) for row in number(tree, children, name, kind)]
                if len(out) > 20_000:
                    yield frame(out)
                    out = []
            yield frame(out)

    columns = ["record_id", "record_hash", "pre", "post", "depth", "position", "node_path", "node_type", "node_name"]

    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=columns)

    return records.select("record_id", "record_hash", "text").mapInPandas(flatten, NODES.format(id=dict(records.dtypes)["record_id"]))


def link(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``parent_path`` and ``parent_pre`` (empty and null for roots), by interval containment.

    A node's parent is the node one level up whose interval holds it: the last one before it in pre-order that
    ends after it in post-order. Each node is laid beside its level's possible parents and the window looks back
    once, so no pairs of nodes are formed; a window holds one level of one record.
    """
    own = F.struct("node_path", "pre", "post")
    levels = F.array(F.struct(F.col("depth").alias("level"), F.lit(False).alias("up")), F.struct((F.col("depth") + 1).alias("level"), F.lit(True).alias("up")))
    laid = nodes.withColumn("at", F.explode(levels))
    back = Window.partitionBy("record_id", "record_hash", "at.level").orderBy("pre").rowsBetween(Window.unboundedPreceding, 0)
    laid = laid.withColumn("parent", F.last(F.when(F.col("at.up"), own), ignorenulls=True).over(back)).where(~F.col("at.up"))
    held = (F.col("parent.pre") < F.col("pre")) & (F.col("parent.post") > F.col("post"))
    return laid.select(
        *nodes.columns, F.when(held, F.col("parent.node_path")).otherwise("").alias("parent_path"), F.when(held, F.col("parent.pre")).alias("parent_pre")
    )


def by_type(linked: DataFrame, types: list[str]) -> dict[str, DataFrame]:
    """A table per node type (compared without case; ``other`` has the rest), each with its link to the parent."""
    kind = F.lower(F.trim("node_type"))
    tables = {t: linked.where(kind == t) for t in types}
    return tables | {"other": linked.where(~kind.isin(types))}


def repository_nodes(df: DataFrame) -> DataFrame:
    """Linked nodes of ``repo_tree.tree_json``."""
    return link(label(df, "record_id", "tree_json", "contents", "name", "type"))


def context_nodes(df: DataFrame) -> DataFrame:
    """Linked nodes of ``stage_a_context.context_json``."""
    return link(label(df, "record_id", "context_json", "children", "title", "level", root="context_tree"))
