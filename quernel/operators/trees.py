"""Trees of paths and of headings as rows, and their text form."""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quernel.functions.text import base_name, extension, ignored, lines, strip

TREE = "path string, parent_path string, name string, type string, extension string, depth int, truncated boolean, error string"


def scan_directory(spark: SparkSession, root: str, max_depth: int | None = None, ignore: tuple[str, ...] = ()) -> DataFrame:
    """Nodes of a directory on the driver's disk: ignored names, and those of ``ignore``, are left out, directories deeper than ``max_depth`` are
    dropped, ones that can't be read have an ``error``. For folders on shared storage use ``paths_to_tree`` over a listing."""
    from fnmatch import fnmatch

    from quernel.functions.text import IGNORED

    def walk(folder: str, path: str, depth: int) -> Iterator[tuple]:
        try:
            names = sorted(os.listdir(folder))
        except PermissionError:
            yield path, path.rpartition("/")[0], os.path.basename(folder), "directory", None, depth, False, "Permission denied"
            return
        yield path, path.rpartition("/")[0], os.path.basename(folder), "directory", None, depth, False, None
        for name in names:
            if any(fnmatch(name, p) for p in (*IGNORED, *ignore)):
                continue
            full, below = os.path.join(folder, name), f"{path}/{name}" if path else name
            if os.path.isfile(full):
                yield below, path, name, "file", os.path.splitext(name)[1][1:] or "none", depth + 1, False, None
            elif os.path.isdir(full) and (max_depth is None or depth < max_depth):
                yield from walk(full, below, depth + 1)

    return spark.createDataFrame(list(walk(os.path.abspath(root), "", 0)), TREE)


def paths_to_tree(files: DataFrame, keys: list[str], path: str, max_depth: int | None = None) -> DataFrame:
    """(keys, path, parent_path, name, type, extension, depth): the files of a listing and the directories above them, down to
    ``max_depth``. Ignored paths are left out; copies count once; null and empty paths give nothing."""
    kept = files.where(F.col(path).isNotNull() & (F.col(path) != "") & ~ignored(path)).select(*keys, F.col(path).alias("path")).distinct()
    parts = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    folders = kept.where(F.size(parts) > 1).select(*keys, F.explode(above).alias("path")).distinct()
    rows = kept.select("*", F.lit("file").alias("type")).unionByName(folders.select("*", F.lit("directory").alias("type")))
    depth = F.size(F.split("path", "/"))
    rows = rows.select(
        *keys, "path", F.regexp_replace("path", r"/?[^/]*$", "").alias("parent_path"), base_name("path").alias("name"), "type", F.when(F.col("type") == "file", extension("path")).alias("extension"), depth.alias("depth")
    )
    return rows if max_depth is None else rows.where(F.col("depth") <= max_depth)


def count_files(tree: DataFrame, keys: list[str]) -> DataFrame:
    return tree.where("type = 'file'").groupBy(*keys).agg(F.count(F.lit(1)).alias("files"))


def _sort_path(path: str) -> F.Column:
    # siblings by name, parents before children: the slash sorts below every other character
    return F.replace(F.col(path), F.lit("/"), F.lit("\u0001"))


def tree_lines(tree: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, ord, line): the tree as text in depth-first order; directories end in a slash, the last entry of a
    directory gets a corner if it is a file."""
    siblings = Window.partitionBy(*keys, "parent_path").orderBy("name")
    last = F.lead("name").over(siblings).isNull()
    down = F.repeat(F.lit("│   "), F.col("depth") - 1)
    line = F.when(F.col("type") == "directory", F.concat(down, F.lit("├── "), "name", F.lit("/"))).otherwise(F.concat(down, F.when(last, "└── ").otherwise("├── "), "name"))
    ord_ = F.row_number().over(Window.partitionBy(*keys).orderBy(_sort_path("path")))
    return tree.select(*keys, line.alias("line"), "path").withColumn("ord", ord_).select(*keys, "ord", "line")


def tree_text(tree: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, text): all lines of each tree."""
    ordered = F.array_sort(F.collect_list(F.struct("ord", "line")))
    return tree_lines(tree, keys).groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("text"))


def headings(texts: DataFrame, key: str, text: str, fence_aware: bool = False) -> DataFrame:
    """(key, ord, parent_ord, depth, level, title, raw): the heading tree of each text; the root has ord 0, level and depth 0.

    A heading is a line of one to six ``#``, white space and a title; with ``fence_aware`` not inside a code fence.
    Its parent is the last earlier heading of a lower level. ``raw`` is the text up to the next heading, stripped. All in
    one array per text, so nothing is shuffled.
    """
    is_heading = lambda line: line.rlike(r"^#{1,6}(?U)\s+.*$")
    start = F.struct(
        F.lit(False).alias("fenced"),
        F.array(F.struct(F.lit(0).alias("level"), F.lit("README").alias("title"), F.array().cast("array<string>").alias("raw"))).alias("nodes"),
    )

    def step(state, line):
        fence = F.startswith(F.ltrim(line), F.lit("```"))
        opens = is_heading(line) & ~(state["fenced"] if fence_aware else F.lit(False))
        node = F.struct(F.length(F.regexp_extract(line, r"^(#{1,6})", 1)).alias("level"), strip(F.regexp_extract(line, r"^#{1,6}(?U)\s+(.*)$", 1)).alias("title"), F.array().cast("array<string>").alias("raw"))
        last = F.element_at(state["nodes"], -1)
        longer = F.struct(last["level"].alias("level"), last["title"].alias("title"), F.concat(last["raw"], F.array(line)).alias("raw"))
        before = F.slice(state["nodes"], F.lit(1), F.size(state["nodes"]) - 1)
        return F.struct(
            F.when(fence, ~state["fenced"]).otherwise(state["fenced"]).alias("fenced"),
            F.when(opens, F.concat(state["nodes"], F.array(node))).otherwise(F.concat(before, F.array(longer))).alias("nodes"),
        )

    nodes = F.aggregate(lines(text), start, step)["nodes"]
    rows = texts.where(F.col(text).isNotNull()).select(key, nodes.alias("nodes"))
    rows = rows.select(key, "nodes", F.posexplode("nodes").alias("ord", "n"))
    # levels as a string of digits: the parent is the last earlier digit below the own
    levels = F.transform(F.slice("nodes", F.lit(1), F.col("ord")), lambda x: x["level"])
    parent = F.array_max(F.filter(F.transform(levels, lambda lv, i: F.when(lv < F.col("n.level"), i)), lambda i: i.isNotNull()))
    chain = F.aggregate(F.reverse(levels), F.struct(F.col("n.level").alias("level"), F.lit(0).alias("depth")), lambda s, lv: F.when(lv < s["level"], F.struct(lv.alias("level"), (s["depth"] + 1).alias("depth"))).otherwise(s))
    return rows.select(key, "ord", parent.alias("parent_ord"), chain["depth"].alias("depth"), F.col("n.level").alias("level"), F.col("n.title").alias("title"), strip(F.array_join("n.raw", "\n")).alias("raw"))


def outline(headings_: DataFrame, key: str) -> DataFrame:
    """(key, text): each heading as a bullet, two blanks per level under the first."""
    line = F.concat(F.repeat(F.lit(" "), F.greatest(F.lit(0), 2 * (F.col("level") - 1))), F.lit("- "), "title")
    ordered = F.array_sort(F.collect_list(F.struct("ord", line.alias("line"))))
    return headings_.where("level > 0").groupBy(key).agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("text"))
