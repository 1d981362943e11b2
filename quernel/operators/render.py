"""Documents assembled from tables: an index, pages of directories and files, one page for all. Results are tables
(repo_name, path, content); writing them as files is left to ``sources.sinks``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernel.functions.text import md_link, strip, strip_think
from quernel.operators.lookups import with_defaults

NO_FILE, NO_MODULE = "(no file summary)", "(no module summary)"
MODES = ("distributed", "monolithic", "both")


def lines_by(order: list[str], line: Column, separator: str = "\n") -> Column:
    """The lines of a group in order, as an aggregate."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, line.alias("_line")))), lambda x: x["_line"]), separator)


def in_tree_order(path: Column | str) -> Column:
    """What sorts paths as a walk of their tree does: the slash below every other sign."""
    return F.replace(F.col(path) if isinstance(path, str) else path, F.lit("/"), F.lit("\u0001"))


def index_page(tree: DataFrame) -> DataFrame:
    """One page per repository that links every file's page, in the order of the tree."""
    link = F.concat(F.lit("- "), md_link("path", F.concat(F.lit("pages/file/"), "path", F.lit(".md"))))
    files = tree.where("type = 'file'").withColumn("_walk", in_tree_order("path"))
    pages = files.groupBy("repo_name").agg(lines_by(["_walk"], link).alias("body"))
    tail = F.concat(F.lit("\n\n- "), md_link(F.lit("Architecture"), F.lit("ARCHITECTURE.md")), F.lit("\n- "), md_link(F.lit("Context"), F.lit("CONTEXT.md")), F.lit("\n"))
    return pages.select("repo_name", F.lit("INDEX.md").alias("path"), F.concat(F.lit("# Repo Wiki\n\n## Pages\n\n"), "body", tail).alias("content"))


def directory_pages(tree: DataFrame, module_summaries: DataFrame) -> DataFrame:
    """A page per directory: the summary of its module and links to what it holds. ``module_summaries``: (repo_name, module,
    module_summary), one row a key."""
    target = F.when(F.col("type") == "file", F.concat(F.lit("pages/file/"), "path", F.lit(".md"))).otherwise(F.concat(F.lit("pages/dir/"), "path", F.lit(".md")))
    held = tree.where("parent_path <> ''").groupBy("repo_name", F.col("parent_path").alias("module")).agg(lines_by(["name"], F.concat(F.lit("- "), md_link("name", target))).alias("body"))
    joined = with_defaults(held, module_summaries.select("repo_name", "module", "module_summary"), ["repo_name", "module"], {"module_summary": NO_MODULE})
    return joined.select("repo_name", F.concat(F.lit("pages/dir/"), "module", F.lit(".md")).alias("path"), F.concat(F.lit("# "), "module", F.lit("\n\n"), "module_summary", F.lit("\n\n"), "body").alias("content"))


def file_pages(tree: DataFrame, file_summaries: DataFrame, items: DataFrame) -> DataFrame:
    """A page per file: its summary and its items. ``file_summaries``: (repo_name, file, file_summary), one row a key;
    ``items``: (repo_name, file, signature, business_summary)."""
    files = tree.where("type = 'file'").select("repo_name", F.col("path").alias("file"))
    listed = items.groupBy("repo_name", "file").agg(lines_by(["signature", "business_summary"], F.concat(F.lit("- `"), "signature", F.lit("`: "), F.coalesce("business_summary", F.lit("")))).alias("body"))
    joined = with_defaults(files, file_summaries.select("repo_name", "file", "file_summary"), ["repo_name", "file"], {"file_summary": NO_FILE}).join(listed, ["repo_name", "file"], "left")
    return joined.select("repo_name", F.concat(F.lit("pages/file/"), "file", F.lit(".md")).alias("path"), F.concat(F.lit("# "), "file", F.lit("\n\n"), "file_summary", F.coalesce(F.concat(F.lit("\n\n"), "body"), F.lit(""))).alias("content"))


# Headings of the page that holds all.
NO_INSIGHTS = "- (architecture_insights unavailable)"


def reference_blocks(tree: DataFrame, module_summaries: DataFrame, file_summaries: DataFrame, items: DataFrame) -> DataFrame:
    """(repo_name, ord, block): the parts of a page that holds all, in the order of the tree: directories with the summary of their
    top module, files with summary, workflows and items. A table, so that it may be larger than any one text.

    ``file_summaries`` may have ``workflows``, ``items`` ``business_rules`` and ``key_terms``; absent ones count as empty."""
    empty = F.array().cast("array<string>")
    listed = lambda rows, c: F.coalesce(F.col(c), empty) if c in rows.columns else empty
    bullets = lambda title, xs: F.when(F.size(xs) > 0, F.concat(F.lit(f"\n\n{title}\n- "), F.array_join(xs, "\n- "))).otherwise("")
    top = tree.where("type = 'directory'").select("repo_name", "path", F.split_part("path", F.lit("/"), F.lit(1)).alias("module"))
    top = top.unionByName(tree.select("repo_name").distinct().select("repo_name", F.lit("").alias("path"), F.lit("(root)").alias("module")))
    known = top.join(module_summaries.select("repo_name", "module", "module_summary"), ["repo_name", "module"], "left")
    told = F.when(F.coalesce("module_summary", F.lit("")) != "", F.concat(F.lit("\n\n"), strip("module_summary"))).otherwise("")
    directories = known.select("repo_name", "path", F.concat(F.lit("## Directory: "), F.when(F.col("path") == "", "(root)").otherwise(F.col("path")), told, F.lit("\n")).alias("block"))
    one = F.concat(
        F.lit("#### "), F.coalesce("signature", F.lit("(unknown)")), F.lit("\n\n"), strip(F.coalesce("business_summary", F.lit(""))), bullets("Business Rules", listed(items, "business_rules")), bullets("Key Terms", listed(items, "key_terms"))
    )
    per_file = items.groupBy("repo_name", F.col("file").alias("path")).agg(lines_by(["signature", "business_summary"], one).alias("body"))
    flows = file_summaries.select("repo_name", F.col("file").alias("path"), "file_summary", listed(file_summaries, "workflows").alias("workflows"))
    files = tree.where("type = 'file'").select("repo_name", "path").join(flows, ["repo_name", "path"], "left").join(per_file, ["repo_name", "path"], "left")
    summary = F.coalesce(F.nullif("file_summary", F.lit("")), F.lit(NO_FILE))
    body = F.coalesce(F.concat(F.lit("\n\n### Functions / Methods\n"), "body"), F.lit(""))
    pages = files.select("repo_name", "path", F.concat(F.lit("## File: "), "path", F.lit("\n\n"), summary, bullets("### Workflows", F.coalesce("workflows", empty)), body, F.lit("\n")).alias("block"))
    return directories.unionByName(pages).withColumn("ord", in_tree_order("path")).select("repo_name", "ord", "block")


def one_page(blocks: DataFrame, context: DataFrame | None = None, insights: DataFrame | None = None) -> DataFrame:
    """All blocks of a repository as one page, behind its context (repo_name, text) and insights (repo_name, lines)."""
    whole = blocks.groupBy("repo_name").agg(lines_by(["ord"], F.col("block")).alias("_body"))
    whole = whole.join(context.select("repo_name", F.col("text").alias("_context")), "repo_name", "left") if context is not None else whole.withColumn("_context", F.lit(None).cast("string"))
    whole = whole.join(insights.select("repo_name", F.col("lines").alias("_lines")), "repo_name", "left") if insights is not None else whole.withColumn("_lines", F.lit(None).cast("array<string>"))
    found = F.when(F.size(F.coalesce("_lines", F.array().cast("array<string>"))) > 0, F.concat(F.lit("- "), F.array_join("_lines", "\n- "))).otherwise(NO_INSIGHTS)
    text = F.concat(F.lit("# Repo Wiki\n\n## Project Context\n\n"), F.coalesce("_context", F.lit("")), F.lit("\n\n## Architecture Insights\n\n"), found, F.lit("\n\n## Reference\n\n"), "_body")
    return whole.select("repo_name", F.lit("WIKI.md").alias("path"), F.concat(strip(text), F.lit("\n")).alias("content"))


def wiki(tree: DataFrame, module_summaries: DataFrame, file_summaries: DataFrame, items: DataFrame, mode: str = "both", context: DataFrame | None = None, insights: DataFrame | None = None) -> DataFrame:
    """All pages; an unknown ``mode`` counts as both. ``context`` and ``insights`` as in ``one_page``; they have pages of their own too."""
    pages = [index_page(tree), directory_pages(tree, module_summaries), file_pages(tree, file_summaries, items)]
    if context is not None:
        pages.append(context.select("repo_name", F.lit("CONTEXT.md").alias("path"), F.concat(F.lit("# Context\n\n"), "text", F.lit("\n")).alias("content")))
    if insights is not None:
        pages.append(insights.select("repo_name", F.lit("ARCHITECTURE.md").alias("path"), F.concat(F.lit("# Architecture\n\n- "), F.array_join("lines", "\n- "), F.lit("\n")).alias("content")))
    if mode != "distributed":
        whole = one_page(reference_blocks(tree, module_summaries, file_summaries, items), context, insights)
        pages = [whole] if mode == "monolithic" else [*pages, whole]
    return reduce(DataFrame.unionByName, pages)


def context_tree(nodes: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, text): nodes (keys, ord, depth, title, summary) as nested bullets; of several lines of a summary each has its own below
    the title. Thinking blocks, blank lines and the root (depth 0) are left out, and so are nodes without a title."""
    own = F.filter(F.transform(F.split(strip(strip_think(F.coalesce("summary", F.lit("")))), "\n"), lambda x: F.regexp_replace(x, r"(?U)\s+$", "")), lambda x: x.rlike(r"(?U)\S"))
    indent = F.repeat(F.lit("  "), F.col("depth") - 1)
    head = F.concat(indent, F.lit("- **"), "title", F.lit("**"))
    below = F.array_join(F.transform(own, lambda x: F.concat(F.lit("\n"), indent, F.lit("  "), x)), "")
    line = F.when(F.size(own) == 0, head).when(F.size(own) == 1, F.concat(head, F.lit(": "), own[0])).otherwise(F.concat(head, F.lit(":"), below))
    shown = nodes.where(F.coalesce(F.col("title") != "", F.lit(False)) & (F.col("depth") > 0))
    return shown.groupBy(*keys).agg(lines_by(["ord"], line).alias("text"))


def fallback_summary(facts: DataFrame) -> DataFrame:
    """(repo_name, file, file_summary) out of facts (doc, classes, functions, has_main) where no summary was written."""
    part = lambda label, c: F.when(F.size(c) > 0, F.concat(F.lit(label), F.array_join(c, ", ")))
    text = F.concat_ws(" ", F.nullif("doc", F.lit("")), part("Classes: ", "classes"), part("Functions: ", "functions"), F.when(F.col("has_main"), F.lit("Runs as a script.")))
    return facts.select("repo_name", "file", F.when(text == "", NO_FILE).otherwise(text).alias("file_summary"))


def context_sections(sections: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, text): a context of tagged sections. ``sections``: (keys, section, round, content); rounds are appended."""
    merged = sections.groupBy(*keys, "section").agg(lines_by(["round"], F.col("content")).alias("body"))
    tagged = F.concat(F.lit("<"), "section", F.lit(">\n"), "body", F.lit("\n</"), "section", F.lit(">"))
    return merged.groupBy(*keys).agg(lines_by(["section"], tagged).alias("text"))
