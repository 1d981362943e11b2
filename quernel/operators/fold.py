"""Folding a component graph to files and packages, and what stands out in it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quernel.functions.text import package_of
from quernel.operators.graph import degrees


def attributed(edges: DataFrame, components: DataFrame) -> DataFrame:
    """Edges with file and package of both ends, ``(unknown)`` where a component isn't known."""
    known = components.select("id", F.coalesce("relative_path", F.lit("")).alias("file")).dropDuplicates(["id"])
    known = known.select("id", "file", package_of("file").alias("pkg"))
    unknown = F.lit("(unknown)")
    joined = edges.join(known.toDF("src", "src_file", "src_pkg"), "src", "left").join(known.toDF("dst", "dst_file", "dst_pkg"), "dst", "left")
    return joined.select("src", "dst", *[F.coalesce(F.nullif(c, F.lit("")), unknown).alias(c) for c in ("src_file", "src_pkg", "dst_file", "dst_pkg")])


def file_edges(attributed_: DataFrame) -> DataFrame:
    """(src, dst, weight) between different files."""
    return attributed_.where("src_file <> dst_file").groupBy(F.col("src_file").alias("src"), F.col("dst_file").alias("dst")).agg(F.count(F.lit(1)).alias("weight"))


def package_edges(attributed_: DataFrame) -> DataFrame:
    """(src, dst, weight) between different packages."""
    return attributed_.where("src_pkg <> dst_pkg").groupBy(F.col("src_pkg").alias("src"), F.col("dst_pkg").alias("dst")).agg(F.count(F.lit(1)).alias("weight"))


def callers_outside(attributed_: DataFrame) -> DataFrame:
    """(id, callers, edges) per symbol used from another file: distinct files and edges."""
    return attributed_.where("src_file <> dst_file").groupBy(F.col("dst").alias("id")).agg(F.count_distinct("src_file").alias("callers"), F.count(F.lit(1)).alias("edges"))


def weighted_degrees(edges: DataFrame) -> DataFrame:
    """(id, in_edges, out_edges, in_weight, out_weight) of (src, dst, weight); both ends of an edge in one shuffle."""
    side = lambda c, i: F.struct(F.col(c).alias("id"), F.lit(i).alias("i"), F.lit(1 - i).alias("o"))
    ends = edges.select(F.explode(F.array(side("dst", 1), side("src", 0))).alias("e"), "weight").select("e.*", "weight")
    return ends.groupBy("id").agg(F.sum("i").alias("in_edges"), F.sum("o").alias("out_edges"), F.sum(F.col("i") * F.col("weight")).alias("in_weight"), F.sum(F.col("o") * F.col("weight")).alias("out_weight"))


def hubs(ids: DataFrame, edges: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` ids with the greatest weighted, then plain degrees in and out; ties by id. Ids without edges count 0."""
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("in_edges", "out_edges", "in_weight", "out_weight")]
    joined = ids.select("id").distinct().join(weighted_degrees(edges), "id", "full").select("id", *zero)
    return joined.orderBy(F.desc("in_weight"), F.desc("out_weight"), F.desc("in_edges"), F.desc("out_edges"), "id").limit(n)


def strongest(edges: DataFrame, n: int = 40) -> DataFrame:
    """The ``n`` heaviest edges; ties by ends."""
    return edges.orderBy(F.desc("weight"), "src", "dst").limit(n)


def representatives(components: DataFrame, outside: DataFrame, per_file: int = 8) -> DataFrame:
    """Public classes and functions that represent a file: at most ``per_file`` each, by callers, edges, documentation,
    class before function and id, all descending. The window is limited before its sort, so no file is held whole."""
    public = components.where(F.col("component_type").isin("class", "function") & ~F.element_at(F.split("id", r"\."), -1).startswith("_"))
    joined = public.join(outside, "id", "left").select(
        "id", "relative_path", "component_type", F.coalesce("callers", F.lit(0)).alias("callers"), F.coalesce("edges", F.lit(0)).alias("edges"), F.coalesce("has_docstring", F.lit(False)).alias("documented")
    )
    order = [F.desc("callers"), F.desc("edges"), F.desc("documented"), F.desc(F.col("component_type") == "class"), F.desc("id")]
    return joined.withColumn("place", F.row_number().over(Window.partitionBy("relative_path").orderBy(*order))).where(F.col("place") <= per_file)


def package_files(components: DataFrame) -> DataFrame:
    """(pkg, files): the sorted distinct files of each package."""
    return components.select(package_of("relative_path").alias("pkg"), "relative_path").groupBy("pkg").agg(F.array_sort(F.collect_set("relative_path")).alias("files"))


def edge_lines(edges: DataFrame) -> DataFrame:
    """(line) ``- a -> b (weight)`` per edge."""
    return edges.select(F.format_string("- %s -> %s (%d)", "src", "dst", "weight").alias("line"))


def hub_lines(hubs_: DataFrame) -> DataFrame:
    """(line) per hub with its degrees."""
    return hubs_.select(F.format_string("- %s: in %d (%d edges), out %d (%d edges)", "id", "in_weight", "in_edges", "out_weight", "out_edges").alias("line"))


def plain_hubs(nodes: DataFrame, edges: DataFrame, k: int = 50) -> DataFrame:
    """(place, line) of the ``k`` nodes with most edges in, then out, then by id from the last: for graphs of plain ids."""
    both = degrees(nodes, edges)
    top = both.orderBy(F.desc("in_degree"), F.desc("out_degree"), F.desc("id")).limit(k)
    place = F.row_number().over(Window.orderBy(F.desc("in_degree"), F.desc("out_degree"), F.desc("id")))  # k rows
    return top.select(place.alias("place"), F.format_string("- %s (in=%d out=%d)", "id", "in_degree", "out_degree").alias("line"))


def more(names: str, shown: int) -> F.Column:
    """The first ``shown`` of an array as text, with ``+n more`` for the rest."""
    size = F.size(names)
    head = F.array_join(F.slice(names, 1, shown), ", ")
    return F.when(size > shown, F.concat(head, F.lit(", +"), (size - shown).cast("string"), F.lit(" more"))).otherwise(head)
