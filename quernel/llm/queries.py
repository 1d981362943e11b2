"""Queries of the text-corpus operators, and SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernel.llm import chunking, documented, lookalikes, packing, prompts, residue, tokens
from quernel.session import cut, table


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Components whose documentation is telling; that of the file is the one in the component's own file."""
    return documented.pairs(table(spark, folder, "dependency_graph"), table(spark, folder, "source_files"), with_code=False, across_files=False).select("repo_name", "id")


def p1_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """The pairs themselves: code and documentation."""
    return documented.pairs(table(spark, folder, "dependency_graph"), table(spark, folder, "source_files"))


STAGE_B = ("stage_b_function_items", "stage_b_file_summaries", "stage_b_module_summaries")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Stage-B records whose summary is residue."""
    return residue.found(*(table(spark, folder, t) for t in STAGE_B))


def p4_kept(spark: SparkSession, folder: str) -> DataFrame:
    """Stage-B summaries without blank ones and residue."""
    return residue.kept(*(table(spark, folder, t) for t in STAGE_B))


def p4_all(spark: SparkSession, folder: str) -> DataFrame:
    """The keys of all records that are kept or found: none is lost between the two."""
    return p4_kept(spark, folder).select(*residue.KEYS).unionByName(p4_found(spark, folder)).distinct()


def limits(spark: SparkSession, folder: str) -> dict[str, int]:
    """The table ``size_limits``: three fixed rows."""
    return {r.limit_name: r.limit_value for r in table(spark, folder, "size_limits").collect()}


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Oversized chunks, and whether one of their cuts is forced."""
    size = limits(spark, folder)
    return chunking.kinds(table(spark, folder, "rag_chunk"), size["chunk_size"], size["chunk_overlap"])


def p5_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """The pieces of oversized chunks."""
    size = limits(spark, folder)
    return chunking.pieces(table(spark, folder, "rag_chunk"), size["chunk_size"], size["chunk_overlap"])


def p5_rejoined(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of the texts that the pieces give back, and the length of the longest piece."""
    fresh = F.substring("text", F.col("fresh_char") - F.col("start_char") + 1, F.length("text"))
    ordered = F.array_sort(F.collect_list(F.struct("piece_no", fresh.alias("fresh"))))
    whole = p5_pieces(spark, folder).groupBy("source", "idx").agg(F.array_join(F.transform(ordered, lambda x: x["fresh"]), "").alias("text"), F.max(F.length("text")).alias("longest"))
    return whole.select("source", "idx", F.md5("text").alias("text_md5"), (F.col("longest") <= limits(spark, folder)["chunk_size"]).alias("fits"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Defective prompt-response pairs with their defect."""
    return prompts.defects(table(spark, folder, "agent_log")).select("log_id", "pair_no", "defect")


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document."""
    return tokens.encode(table(spark, folder, "documents"))


def p7_decoded(spark: SparkSession, folder: str) -> DataFrame:
    """Texts from the ids again."""
    return tokens.decode(p7_ids(spark, folder))


def p8_containers(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's container."""
    return packing.containers(table(spark, folder, "documents"), limits(spark, folder)["container_capacity"])


def p8_fill(spark: SparkSession, folder: str) -> DataFrame:
    """How well the containers are filled, beside the least number of containers."""
    capacity = limits(spark, folder)["container_capacity"]
    return packing.fill(packing.containers(table(spark, folder, "documents"), capacity), capacity)


def p8_placed(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the least first token of its parts, whether its parts follow each other without gap, and whether all of
    their containers hold at most the capacity."""
    capacity = limits(spark, folder)["container_capacity"]
    placed = cut(packing.containers(table(spark, folder, "documents"), capacity))
    used = placed.groupBy("container_id").agg(F.sum("tokens").alias("used"))
    each = placed.join(used, "container_id").groupBy("doc_id").agg(F.min("first_token").alias("first_token"), F.max(F.col("first_token") + F.col("tokens")).alias("end"), F.sum("tokens").alias("tokens"), F.max("used").alias("used"))
    return each.select("doc_id", "first_token", (F.col("end") == F.col("tokens")).alias("whole"), (F.col("used") <= capacity).alias("fits"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of documents that look the same though stored differently."""
    return lookalikes.same_looking(table(spark, folder, "documents"))


def p9_forms(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's text in its consistent form."""
    return lookalikes.consistent(table(spark, folder, "documents").select("doc_id", "text")).select("doc_id", "form")


QUERIES = {"p1_found": p1_found, "p1_pairs": p1_pairs, "p4_found": p4_found, "p4_kept": p4_kept, "p4_all": p4_all}
QUERIES |= {"p5_found": p5_found, "p5_pieces": p5_pieces, "p5_rejoined": p5_rejoined, "p6_found": p6_found}
QUERIES |= {"p7_ids": p7_ids, "p7_decoded": p7_decoded, "p8_containers": p8_containers, "p8_fill": p8_fill, "p8_placed": p8_placed}
QUERIES |= {"p9_found": p9_found, "p9_forms": p9_forms}

SQL: dict[str, str] = {
    "p4_all": r"""
select distinct source_table, repo_name, record_key from (
  select 'stage_b_function_items' as source_table, repo_name, cast(item_id as varchar) as record_key, business_summary as s from stage_b_function_items
  union all select 'stage_b_file_summaries', repo_name, file, file_summary from stage_b_file_summaries
  union all select 'stage_b_module_summaries', repo_name, module, module_summary from stage_b_module_summaries)
where regexp_matches(s, '[^\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]')""",
    "p5_rejoined": "select distinct source, idx, md5(text) as text_md5, true as fits from rag_chunk where length(text) > 1200",
    "p8_placed": "select doc_id, cast(0 as bigint) as first_token, true as whole, true as fits from documents",
    "p7_decoded": "select doc_id, coalesce(text, '') as text from documents",
    "p5_found": r"""
select distinct source, idx, case when exists (select 1 from unnest(regexp_split_to_array(text, '[\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}。！？]')) as runs(run) where length(run) > 1200)
  then 'forced' else 'natural' end as kind
from rag_chunk where length(text) > 1200""",
}
