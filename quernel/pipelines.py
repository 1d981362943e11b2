"""The three lifecycles end to end: metadata out of sources, the knowledge base, generation of pairs.

Every model call is a ``Provider`` (``operators.incremental``, ``operators.providers``); without one an offline stub
answers. Stages are materialised under a folder, so a run that broke off continues where it was.

    python -m quernel.pipelines metadata SOURCE OUT [--name N] [--percent P]
    python -m quernel.pipelines tree SOURCE OUT [--max-depth D] [--ignore PATTERN ...] [--output text|json]
    python -m quernel.pipelines score COMPONENTS.json OUT [--top-percent P] [--alpha A] [--beta B] [--gamma G]
        [--betweenness-samples N] [--betweenness-seed S] [--pagerank-damping D] [--pagerank-iters I] [--print-top-percent P] [--print-top K]
    python -m quernel.pipelines wiki TABLES OUT [--mode distributed|monolithic|both] [--force] [--no-cache] [--limit N]
        [--max-level 1|2|3] [--preview-lines N] [--manifest] [--config FILE] [--check]
    python -m quernel.pipelines generate TABLES OUT [--task qa|design] [--mode reader_searcher|context_print] [--attempts N] [--config FILE]
"""

from __future__ import annotations

import argparse
import os
import sys

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quernel.functions import text as T
from quernel.functions import vocabulary
from quernel.operators import extraction, fold, graph, incremental, lookups, providers, references, render, retrieval, trees
from quernel.operators.incremental import Provider, Stages, offline
from quernel.session import build_session, cut, table
from quernel.sources import readers, sinks

TASKS = ("qa", "design")
# Own wording of the prompts, one per agent.
PROMPTS = {
    "context": "Sum up this section of a readme in one sentence, knowing its parent.\n\nParent: {parent}\n\n{title}\n\n{raw}",
    "identity": "Describe the project as JSON with domain, goals, business_terms and module_intents.\n\n{text}",
    "item": "Say in one sentence what this component is for.\n\nSignature: {signature}\nPlace: {location}\n\n{content}",
    "architecture": "Name what stands out in this dependency graph.\n\n{lines}",
    "reader": "Decide what else must be known to explain this component. Answer with INFO_NEED and REQUEST.\n\n{code}",
    "qa": "Write questions and answers about this component.\n\n{code}\n\nContext:\n{context}",
    "design": "Write requirements and solutions this component could come from.\n\n{code}\n\nContext:\n{context}",
}
# What a context says where nothing calls a component, and where there is no knowledge base.
NO_KNOWLEDGE = "Information not found (RAG not initialized)"
NEVER_CALLED = "This component is never called by any other component."


def fill(template: str, **columns: str) -> F.Column:
    """A prompt with its slots filled from columns; nulls count as empty."""
    parts, rest = [], template
    while "{" in rest:
        head, _, rest = rest.partition("{")
        name, _, rest = rest.partition("}")
        parts += [F.lit(head), F.coalesce(F.col(columns.get(name, name)).cast("string"), F.lit(""))]
    return F.concat(*parts, F.lit(rest))


def metadata(files: DataFrame, percent: float = 100, samples: int | None = 200) -> dict[str, DataFrame]:
    """components, edges, scores and the chosen components of (repo_name, relative_path, content)."""
    parsed = cut(extraction.parse_files(files))
    own = extraction.components(parsed)
    key = lambda c: F.concat_ws(":", "repo_name", c)
    deps = cut(extraction.dependencies(parsed))
    nodes = cut(own.select(key("id").alias("id")))
    edges = graph.internal_edges(own.select(key("id").alias("id")).join(deps.groupBy(key("src").alias("id")).agg(F.collect_set(key("dst")).alias("depends_on")), "id", "left"))
    edges = cut(edges)
    scores = graph.influence(nodes, edges, samples=samples)
    lists = deps.groupBy("repo_name", F.col("src").alias("id")).agg(F.array_sort(F.collect_set("dst")).alias("depends_on"))
    whole = own.join(lists, ["repo_name", "id"], "left").withColumn("depends_on", T.as_list("depends_on"))
    chosen = graph.top_percent(cut(scores), percent)
    return {"components": whole, "edges": edges, "scores": scores, "chosen": graph.selected(whole.withColumnRenamed("id", "component_id").withColumn("id", key("component_id")), chosen)}


def graph_of(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of serialized components or of plain (id, depends_on) rows, told apart by their columns."""
    if "component_type" in rows.columns:
        rows = readers.defaults(rows)
    return rows.select("id").distinct(), graph.internal_edges(rows)


def readme_summaries(headings: DataFrame, key: str, provider: Provider = offline) -> DataFrame:
    """(key, ord, level, title, summary) of a heading tree, from the top down: each level's prompts carry their parents'
    summaries. One join per level, of which there are at most six."""
    done = headings.where("level = 0").select(key, "ord", "level", "title", F.lit("").alias("summary"))
    for level in range(1, 7):
        here = headings.where(F.col("level") == level)
        parents = done.select(key, F.col("ord").alias("parent_ord"), F.col("summary").alias("parent"))
        asked = here.join(parents, [key, "parent_ord"], "left").withColumn("prompt", fill(PROMPTS["context"]))
        replied = incremental.enrich(asked, "prompt", "summary", provider)
        done = done.unionByName(replied.select(key, "ord", "level", "title", T.strip_think("summary").alias("summary")))
    return done


def identity_card(reply: str) -> F.Column:
    """domain, goals, business_terms and module_intents out of a model's reply; empty where it can't be read."""
    schema = "domain string, goals array<string>, business_terms map<string, string>, module_intents array<string>"
    card = F.from_json(T.json_reply(reply), schema)
    return F.struct(
        F.coalesce(card["domain"], F.lit("")).alias("domain"),
        T.as_list(card["goals"]).alias("goals"),
        F.coalesce(card["business_terms"], F.create_map().cast("map<string,string>")).alias("business_terms"),
        T.as_list(card["module_intents"]).alias("module_intents"),
    )


def items_of(components: DataFrame, provider: Provider = offline) -> DataFrame:
    """(repo_name, file, component_id, signature, kind, business_summary) of components worth it."""
    asked = extraction.doc_items(components).where(~T.trivial("signature", "kind", "content")).withColumn("prompt", fill(PROMPTS["item"]))
    replied = incremental.enrich(asked, "prompt", "business_summary", provider)
    return replied.select("repo_name", F.col("relative_path").alias("file"), "component_id", "signature", "kind", T.strip_think("business_summary").alias("business_summary"))


def architecture(components: DataFrame, edges: DataFrame, provider: Provider = offline) -> DataFrame:
    """One row: the prompt of hubs and strongest edges, and its reply."""
    held = fold.attributed(edges, components)
    packages = fold.package_edges(held)
    hubs = fold.hub_lines(fold.hubs(components.select(T.package_of("relative_path").alias("id")), packages, 20))
    lines = hubs.unionByName(fold.edge_lines(fold.strongest(packages, 40)))
    prompt = lines.agg(F.array_join(F.array_sort(F.collect_list("line")), "\n").alias("lines")).withColumn("prompt", fill(PROMPTS["architecture"]))
    return incremental.enrich(prompt, "prompt", "insights", provider)


def project_context(readmes: DataFrame, provider: Provider = offline) -> DataFrame:
    """(repo_name, text, card) of each readme (repo_name, text): its headings summed up from the top down, as nested bullets, and
    the identity card that a model reads out of them."""
    heads = cut(trees.headings(readmes, "repo_name", "text"))
    summed = readme_summaries(heads, "repo_name", provider)
    nodes = heads.select("repo_name", "ord", "depth").join(summed, ["repo_name", "ord"])
    told = render.context_tree(nodes, ["repo_name"])
    asked = readmes.select("repo_name").distinct().join(told, "repo_name", "left").withColumn("text", F.coalesce("text", F.lit(""))).withColumn("prompt", fill(PROMPTS["identity"]))
    replied = incremental.enrich(asked, "prompt", "reply", provider)
    return replied.select("repo_name", "text", identity_card("reply").alias("card"))


def knowledge(stages: Stages, components: DataFrame, files: DataFrame, provider: Provider = offline, mode: str = "both", readmes: DataFrame | None = None, limit: int | None = None, max_level: int = 3) -> DataFrame:
    """The pages of the knowledge base, in four stages that are kept each: context out of readmes (repo_name, text); items, summaries
    of files and modules as far as ``max_level``; insights into the graph; assembly.

    Replies of models hold their fields as JSON (``incremental.summary_fields``); those of the offline stub are plain summaries.
    """
    if not 1 <= max_level <= 3:
        raise ValueError("max_level must be 1, 2 or 3")
    none = components.sparkSession.createDataFrame([], "repo_name string, text string")
    context = stages.get("context", lambda: project_context(readmes if readmes is not None else none, provider))
    chosen = incremental.first_items(components, limit, ["repo_name", "id"])
    items = stages.get("items", lambda: items_of(chosen, provider))
    plain = provider is offline

    def read(rows: DataFrame, level: str) -> DataFrame:
        return rows if plain else incremental.summary_fields(rows, f"{level}_summary", level)

    def summaries() -> DataFrame:
        rows = items if max_level >= 2 else items.limit(0)
        return read(incremental.summaries_up(rows, ["repo_name", "file"], "business_summary", "file_summary", provider), "file")

    held = stages.get("files", summaries)
    modules = stages.get("modules", lambda: read(incremental.modules_up(held if max_level >= 3 else held.limit(0), provider), "module"))

    def insights() -> DataFrame:
        key = F.concat_ws(":", "repo_name", "id")
        rows = components.select("repo_name", key.alias("id"), "relative_path", F.transform("depends_on", lambda d: F.concat_ws(":", F.col("repo_name"), F.trim(d))).alias("depends_on"))
        found = architecture(cut(rows), graph.internal_edges(rows), provider)
        lines = F.filter(F.split(T.strip_think(F.coalesce("insights", F.lit(""))), "\n"), lambda x: F.trim(x) != "")
        return components.select("repo_name").distinct().crossJoin(F.broadcast(found.select(lines.alias("lines"))))  # one row

    found = stages.get("insights", insights)
    tree = trees.paths_to_tree(files, ["repo_name"], "relative_path")
    return stages.get(f"pages_{mode}", lambda: render.wiki(tree, modules, held, items, mode, context.select("repo_name", "text"), found))


def internal_context(components: DataFrame, edges: DataFrame, requests: DataFrame) -> DataFrame:
    """(id, req, dst, called_by): what each requested name leads to and who uses the component. ``requests``: (id, kind, pos, req),
    ``components``: (id, code), ``edges``: (src, dst)."""
    deps = edges.select(F.col("src").alias("id"), "dst", T.route("dst").alias("kind"), F.xxhash64("dst").alias("ord"))
    found = lookups.requested(requests, deps)
    users = edges.groupBy(F.col("dst").alias("id")).agg(F.array_join(F.array_sort(F.collect_set("src")), ", ").alias("called_by"))
    return found.join(users, "id", "left").withColumn("called_by", F.coalesce("called_by", F.lit(NEVER_CALLED)))


def external_context(texts: DataFrame, queries: list[tuple[str, str]], k: int = 5) -> DataFrame:
    """The best ``k`` chunks of (source, text) for each query."""
    chunks = retrieval.chunk_table(texts, "source", "text").withColumn("chunk", F.concat_ws("#", "source", "idx"))
    return retrieval.substring_search(chunks, queries, "chunk", "text", k)


def constrain(sections: DataFrame, keys: list[str], max_words: int, whole: list[str] | None = None) -> DataFrame:
    """``sections`` (keys, section, content and others): the longest section of each key is cut at its end as far as the words of all
    exceed ``max_words``; sections named in ``whole`` count but aren't cut. Rows of one section are cut from the last ``round``."""
    more = ["round"] if "round" in sections.columns else []
    sized = sections.withColumn("_n", T.word_count("content"))
    per = sized.groupBy(*keys, "section").agg(F.sum("_n").alias("_m"))
    free = ~F.col("section").isin(whole or [])
    total = per.groupBy(*keys).agg(F.sum("_m").alias("_total"), F.max_by(F.when(free, F.col("section")), F.when(free, F.struct("_m", "section"))).alias("_longest"))
    later = Window.partitionBy(*keys, "section").orderBy(*[F.desc(c) for c in more], F.desc("_n")).rowsBetween(Window.unboundedPreceding, -1)
    joined = sized.withColumn("_later", F.coalesce(F.sum("_n").over(later), F.lit(0))).join(total, keys)
    over = F.greatest(F.lit(0), F.col("_total") - max_words - F.col("_later"))
    short = T.truncate_words("content", F.greatest(F.lit(0), F.col("_n") - over).cast("int"))
    return joined.withColumn("content", F.when((F.col("section") == F.col("_longest")) & (over > 0), short).otherwise(F.col("content"))).select(*sections.columns)


MODES = (None, "reader_searcher", "context_print")


def searched(asked: DataFrame, components: DataFrame, knowledge_base: Provider | None = None) -> DataFrame:
    """(component_id, section, content) for the requests in ``reading`` of ``asked``: code of the requested dependencies, code of the callers
    where they are asked for (or that there are none), and an answer to each query, errors as text."""
    wanted = T.request("reading")
    code = components.select(F.col("id").alias("dst"), F.col("code").alias("dst_code"))
    names = F.array(*[F.struct(F.lit(k).alias("kind"), wanted[f].alias("names")) for k, f in (("class", "classes"), ("function", "functions"), ("method", "methods"))])
    requests = asked.select(F.col("component_id").alias("id"), F.explode(names).alias("n")).select("id", "n.kind", F.posexplode("n.names").alias("pos", "req"))
    deps = asked.select(F.col("component_id").alias("id"), F.posexplode("depends_on").alias("ord", "dst")).select("id", "ord", "dst", T.request_route("dst").alias("kind"))
    got = lookups.requested(requests, deps).join(code, "dst", "left").select(F.col("id").alias("component_id"), "req", "dst", F.coalesce("dst_code", F.lit("")).alias("dst_code"))
    inside = got.groupBy("component_id").agg(render.lines_by(["req", "dst"], F.concat(F.lit("# "), "dst", F.lit("\n"), "dst_code"), "\n\n").alias("content")).select("component_id", F.lit("INTERNAL_INFO").alias("section"), "content")
    edges = components.select(F.col("id").alias("src"), F.explode("depends_on").alias("dst"))
    users = graph.callers(edges, asked.where(wanted["call_by"]).select(F.col("component_id").alias("id")))
    users = users.join(components.select(F.col("id").alias("caller"), "code"), "caller").groupBy("id").agg(render.lines_by(["caller"], F.concat(F.lit("# "), "caller", F.lit("\n"), F.coalesce("code", F.lit(""))), "\n\n").alias("content"))
    called = asked.where(wanted["call_by"]).select("component_id").join(users.withColumnRenamed("id", "component_id"), "component_id", "left")
    called = called.select("component_id", F.lit("CALLED_BY").alias("section"), F.coalesce("content", F.lit(NEVER_CALLED)).alias("content"))
    queries = asked.select("component_id", F.posexplode(wanted["queries"]).alias("n", "query"))
    if knowledge_base is None:
        answers = queries.withColumn("value", F.lit(NO_KNOWLEDGE))
    else:
        answers = retrieval.answer_each(queries, "query", knowledge_base).withColumn("value", F.col("answer.value"))
    outside = answers.groupBy("component_id").agg(render.lines_by(["n"], F.concat("query", F.lit("\n"), F.coalesce("value", F.lit(""))), "\n\n").alias("content"))
    return retrieval.gather([inside, called, outside.select("component_id", F.lit("EXTERNAL_INFO").alias("section"), "content")])


def generate(
    components: DataFrame, log: DataFrame, task: str = "qa", provider: Provider = offline, max_code_tokens: int = 10_000, attempts: int = 1, mode: str | None = None,
    knowledge_base: Provider | None = None, max_input_words: int = 10_000, log_to: str | None = None,
) -> DataFrame:
    """(component_id, task, file_path, dataset_content, error) of components without a result; constructors are skipped.

    The reader is asked what else it must know; what it asks for is searched and appended to the context, up to ``attempts``
    times for components that still need something, and then the writer is asked once. A context with the code is held to ``max_input_words`` by
    cutting its longest section. A call that fails leaves its component a row with ``error`` and no content. ``mode``
    ``reader_searcher`` gives the reader's last reply instead, ``context_print`` the context. With ``log_to`` every reply is appended there.
    """
    if task not in TASKS or mode not in MODES:
        raise ValueError((task, mode))
    encoder = vocabulary.Encoder(components.sparkSession) if os.path.exists(vocabulary.vocabulary_path()) else None
    work = components.where(T.last_segment("id") != "__init__").select(F.col("id").alias("component_id"), "repo_name", "relative_path", "code", T.as_list("depends_on").alias("depends_on"))
    work = incremental.resume(work, log.where(F.col("task") == task).select("component_id"), "component_id")
    short = vocabulary.truncate_tokens(encoder, "code", max_code_tokens) if encoder else T.truncate_words("code", int(max_code_tokens / 1.3))
    state = cut(work.withColumn("code", short).withColumn("context", F.lit("")).withColumn("reading", F.lit(None).cast("string")).withColumn("failed", F.lit(None).cast("string")).withColumn("open", F.lit(True)))
    sections = None

    def logged(rows: DataFrame, agent: str, content: str) -> None:
        if log_to:
            sinks.log_replies(rows.select("component_id", F.col(content).alias("content")), log_to, agent)

    for attempt in range(attempts + 1):
        asked = state.where("open").withColumn("reader_prompt", F.concat(fill(PROMPTS["reader"]), F.when(F.col("context") != "", F.concat(F.lit("\n\nContext:\n"), "context")).otherwise("")))
        read = incremental.enrich(asked.drop("reading"), "reader_prompt", "reading", provider)
        read = cut(read.withColumn("failed", F.col("reading_error")).withColumn("open", F.coalesce(T.needs_info("reading"), F.lit(False))).select(*state.columns))
        logged(read, "reader", "reading")
        if attempt == attempts or read.where("open").isEmpty():
            state = state.where("not open").unionByName(read)
            break
        found = cut(searched(read.where("open"), components, knowledge_base).withColumn("round", F.lit(attempt)))
        logged(found, "searcher", "content")
        sections = found if sections is None else sections.unionByName(found)
        sized = read.where("open").select("component_id", F.lit("CODE").alias("section"), F.col("code").alias("content"), F.lit(-1).alias("round"))
        held = constrain(sections.unionByName(sized), ["component_id"], max_input_words, ["CODE"]).where("section <> 'CODE'")
        told = render.context_sections(held, ["component_id"]).withColumnRenamed("text", "_told")
        newer = read.join(told, "component_id", "left").withColumn("context", F.coalesce("_told", "context")).select(*state.columns)
        state = cut(state.where("not open").unionByName(newer))
    result = ["component_id", F.lit(task).alias("task"), F.col("relative_path").alias("file_path")]
    if mode:
        return state.select(*result, F.col("reading" if mode == "reader_searcher" else "context").alias("dataset_content"), F.col("failed").alias("error"))
    written = incremental.enrich(state.where("failed is null").withColumn("writer_prompt", fill(PROMPTS[task])), "writer_prompt", "dataset_content", provider)
    written = cut(written.select(*result, T.strip_think("dataset_content").alias("dataset_content"), F.col("dataset_content_error").alias("error")))
    logged(written, "writer", "dataset_content")
    return written.unionByName(state.where("failed is not null").select(*result, F.lit(None).cast("string").alias("dataset_content"), F.col("failed").alias("error")))


def keep_flagged(texts: DataFrame, text: str, flag: str, provider: Provider = offline, head: int = 1000) -> DataFrame:
    """Rows whose first ``head`` characters make the model set ``flag`` to true; a failing call drops the row."""
    asked = texts.withColumn("_prompt", F.substring(text, 1, head))
    replied = incremental.enrich(asked, "_prompt", "_reply", provider)
    return replied.where(F.contains(F.lower("_reply"), F.lit(f'"{flag}": true'))).select(*texts.columns)


def score(components: DataFrame, percent: float = 100, **weights) -> DataFrame:
    """The best ``percent`` of components (id, depends_on, ...) with ``score`` and ``place``; ``weights`` as in ``graph.influence``."""
    nodes, edges = graph_of(components)
    scored = cut(graph.influence(cut(nodes), cut(edges), **weights))
    return graph.selected(components, graph.top_percent(scored, percent)).join(scored.select("id", "score"), "id")


def _options() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="quernel")
    commands = parser.add_subparsers(dest="command", required=True)
    made = {}
    for name in ("metadata", "tree", "score", "wiki", "generate"):
        made[name] = commands.add_parser(name)
        made[name].add_argument("source")
        made[name].add_argument("out")
    made["metadata"].add_argument("--name", default="repository")
    made["metadata"].add_argument("--percent", type=float, default=100.0)
    made["tree"].add_argument("--max-depth", type=int)
    made["tree"].add_argument("--ignore", nargs="+", default=[], help="further patterns to leave out")
    made["tree"].add_argument("--output", choices=("text", "json", "table"), default="table")
    for option, default in (("top-percent", 100.0), ("alpha", 1.0), ("beta", 1.0), ("gamma", 1.0), ("pagerank-damping", 0.85), ("print-top-percent", 0.0)):
        made["score"].add_argument(f"--{option}", type=float, default=default)
    for option, default in (("betweenness-samples", 200), ("betweenness-seed", 0), ("pagerank-iters", 50), ("print-top", None)):
        made["score"].add_argument(f"--{option}", type=int, default=default)
    made["wiki"].add_argument("--mode", choices=render.MODES, default="both")
    made["wiki"].add_argument("--limit", type=int, help="only so many items, in the order of repository and id")
    made["wiki"].add_argument("--max-level", type=int, default=3, choices=(1, 2, 3))
    made["wiki"].add_argument("--preview-lines", type=int, default=0)
    for option in ("force", "no-cache", "manifest", "check"):
        made["wiki"].add_argument(f"--{option}", action="store_true")
    made["generate"].add_argument("--task", choices=TASKS, default="qa")
    made["generate"].add_argument("--mode", choices=MODES[1:])
    made["generate"].add_argument("--attempts", type=int, default=1)
    for name in ("wiki", "generate"):
        made[name].add_argument("--config", help="settings of the model; without one the offline stub answers")
    return parser


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = _options().parse_args(args)
    spark = spark or build_session()
    if a.command == "metadata":
        for name, df in metadata(readers.repository(spark, a.source, a.name), a.percent).items():
            sinks.replace_rows(df, f"{a.out}/{name}")
        return 0
    if a.command == "tree":
        found = trees.scan_directory(spark, a.source, a.max_depth, tuple(a.ignore))
        if a.output == "text":
            found = trees.tree_text(found.where("depth > 0").withColumn("repo_name", F.lit("")), ["repo_name"]).select(F.col("text").alias("value"))
        sinks.replace_rows(found, a.out, {"table": "parquet"}.get(a.output, a.output))
        return 0
    if a.command == "score":
        weights = {"alpha": a.alpha, "beta": a.beta, "gamma": a.gamma, "samples": a.betweenness_samples or None, "seed": a.betweenness_seed, "damping": a.pagerank_damping, "rounds": a.pagerank_iters}
        rows = readers.component_map(spark, a.source)
        best = cut(score(rows, a.top_percent, **weights))
        sinks.write_component_object(best.select(*rows.columns), a.out)
        n = rows.count()
        shown = a.print_top if a.print_top is not None else -(-int(n * min(a.print_top_percent, a.top_percent) * 1000) // 100_000)
        for r in best.orderBy("place").limit(shown).collect():  # as many as the user asked to see
            print(f"{r.place}\t{r.id}\t{r.score:.6f}")
        return 0
    settings = readers.config(a.config) if a.config else {}
    provider = providers.create(settings.get("llm") or {})
    if a.command == "wiki" and a.check:
        provider(pd.Series(["ping"]))  # raises where no model answers
    rows = references.newest(table(spark, a.source, "dependency_graph"), ["repo_name", "id"], ["component_type", "file_path", "relative_path", "depends_on", "start_line", "end_line", "has_docstring", "docstring"], "scan_time", "ingested_at")
    files = table(spark, a.source, "source_files").select("repo_name", "relative_path", "content").distinct()
    if a.command == "wiki":
        readme = files.where(F.lower(T.base_name("relative_path")).startswith("readme")).groupBy("repo_name").agg(F.min_by("content", F.struct(F.length("relative_path"), "relative_path")).alias("text"))
        pages = knowledge(Stages(spark, f"{a.out}/_stages", a.force or a.no_cache), rows, files, provider, a.mode, readme, a.limit, a.max_level)
        sinks.replace_pages(pages, f"{a.out}/pages", a.mode)
        if a.manifest:
            sinks.replace_rows(sinks.manifest(pages), f"{a.out}/manifest", "json")
        if a.preview_lines:
            pages.where("path = 'INDEX.md'").select("repo_name", sinks.preview("content", a.preview_lines).alias("head")).orderBy("repo_name").show(40, False)
    else:
        code = lookups.source_of(rows, files, ["repo_name", "relative_path"]).withColumn("code", T.line_slice("content", "start_line", "end_line"))
        made = generate(code, table(spark, a.source, "agent_log").where("agent = 'writer'"), a.task, provider, attempts=a.attempts, mode=a.mode, log_to=f"{a.out}/log")
        sinks.append_rows(made.where("dataset_content is not null and error is null").drop("error"), f"{a.out}/{a.task}")
        sinks.append_rows(made.where("error is not null"), f"{a.out}/errors")
    return 0


if __name__ == "__main__":
    sys.exit(main())
