"""Work that is done in stages and resumed: what is left, what is cached, what goes up a level."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quernel.functions.text import json_reply, package_of
from quernel.operators.lookups import remaining
from quernel.session import cut

#: A provider turns a series of prompts into a series of replies; it stands for a model.
Provider = Callable[[pd.Series], pd.Series]


def offline(prompts: pd.Series) -> pd.Series:
    """A provider without a model: the first sentence of each prompt."""
    return prompts.fillna("").str.extract(r"(?s)^\s*(.*?(?:[.!?。！？]|\Z))", expand=False).fillna("")


def echo(prompts: pd.Series) -> pd.Series:
    """A provider that gives each prompt back."""
    return prompts.fillna("")


def enrich(rows: DataFrame, prompt: str, into: str, provider: Provider = offline) -> DataFrame:
    """``rows`` with the provider's reply to ``prompt``; a failure is a null reply with its text in ``<into>_error``."""

    schema = StructType([*rows.schema.fields, StructField(into, StringType()), StructField(f"{into}_error", StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            try:
                yield batch.assign(**{into: provider(batch[prompt]).to_numpy(), f"{into}_error": None})
            except Exception as e:  # noqa: BLE001 - a provider may fail in any way; the rows must survive
                yield batch.assign(**{into: None, f"{into}_error": str(e)[:500]})

    return rows.mapInPandas(run, schema)


def resume(work: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Work whose key has no result yet."""
    return remaining(work, done.where(F.col(key).isNotNull()), [key])


def resume_items(items: DataFrame, cached: DataFrame) -> DataFrame:
    """Items without a cached result, by ``location::signature``."""
    joint = F.concat_ws("::", F.coalesce("location", F.lit("")), F.coalesce("signature", F.lit("")))
    return items.withColumn("_key", joint).join(cached.select(joint.alias("_key")).distinct(), "_key", "left_anti").drop("_key")


def with_cached(cached: DataFrame, new: DataFrame) -> DataFrame:
    """Cached and new rows together."""
    return cached.unionByName(new)


def latest(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Of several rows of a key the one with the greatest ``order``: how an append-only table is read."""
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(F.col(order), F.xxhash64(*rest))).alias("_r"))
    return best.select(*keys, "_r.*")


def summaries_up(items: DataFrame, keys: list[str], text: str, into: str, provider: Provider = offline, most: int = 200) -> DataFrame:
    """(keys, n, into): a group's ``- signature: text`` lines, in order, as one prompt and its reply; ``n`` counts the lines.

    A group of more than ``most`` lines is cut into blocks of ``most``, one prompt each; the blocks' replies, in order, are
    summed up in the same way, level by level, until one is left. If the reply to a block fails, so does the group's.
    Lines are numbered by a global rank, so no task gets a whole group; a prompt holds at most ``most`` of them.
    """
    from quernel.operators.graph import global_rank

    if most < 2:
        raise ValueError("most must be at least 2")
    line = F.concat(F.lit("- "), F.coalesce("signature", F.lit("")), F.lit(": "), F.coalesce(text, F.lit("")))
    ranked = global_rank(items.select(*keys, "signature", line.alias("_line")), [F.col(c) for c in (*keys, "signature", "_line")], "_place")
    groups = cut(ranked.groupBy(*keys).agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("n")))
    largest = groups.agg(F.max("n")).first()[0] or 0
    rest = ranked.join(groups, keys).select(*keys, "n", (F.col("_place") - F.col("_first")).alias("_at"), "_line")
    done, held = None, 1
    while True:
        ordered = F.transform(F.array_sort(F.collect_list(F.struct("_at", "_line"))), lambda x: x["_line"])
        blocks = rest.groupBy(*keys, "n", F.expr(f"_at div {most}").alias("_block")).agg(F.array_join(ordered, "\n").alias("prompt"), F.bool_or(F.col("_line").isNull()).alias("_failed"))
        held *= most  # lines that a block stands for
        replied = enrich(blocks, "prompt", into, provider).withColumn(into, F.when(~F.col("_failed"), F.col(into)))
        if held < largest:
            replied = cut(replied)
        whole = replied.where(F.col("n") <= held).select(*keys, "n", into)
        done = whole if done is None else done.unionByName(whole)
        if held >= largest:
            return done
        rest = replied.where(F.col("n") > held).select(*keys, "n", F.col("_block").alias("_at"), F.col(into).alias("_line"))


def aggregate_levels(items: DataFrame, provider: Provider = offline, max_level: int = 3) -> dict[str, DataFrame]:
    """Up to three levels: items, summaries of files, summaries of modules (the first segment of the path)."""
    out = {"items": items}
    if max_level >= 2:
        out["files"] = cut(summaries_up(items, ["repo_name", "file"], "business_summary", "file_summary", provider))
    if max_level >= 3:
        out["modules"] = modules_up(out["files"], provider)
    return out


def modules_up(files: DataFrame, provider: Provider = offline) -> DataFrame:
    """(repo_name, module, n, module_summary) out of (repo_name, file, file_summary)."""
    upper = files.select("repo_name", package_of("file").alias("module"), F.col("file").alias("signature"), "file_summary")
    return summaries_up(upper, ["repo_name", "module"], "file_summary", "module_summary", provider)


def counts_up(items: DataFrame) -> DataFrame:
    """(module, file, items): counts per file, per module and in all; null stands for all of a level."""
    return items.withColumn("module", package_of("file")).rollup("module", "file").agg(F.count(F.lit(1)).alias("items"))


def first_items(items: DataFrame, n: int | None, order: list[str]) -> DataFrame:
    """The first ``n`` items in ``order``, all if ``n`` is None: a run's limit, asked for by its user."""
    return items if n is None else items.orderBy(*order).limit(n)


#: What stands in for a summary that couldn't be read or is empty, and the lists of each level.
LEVELS = {"file": ("(file summary unavailable)", "(no file summary)", ["key_terms", "workflows"]), "module": ("(module summary unavailable)", "(no module summary)", ["responsibilities", "key_terms"])}


def summary_fields(rows: DataFrame, reply: str, level: str) -> DataFrame:
    """``rows`` with the fields of a level's reply in place of ``reply``: ``<level>_summary`` and its lists. A reply that isn't a JSON
    object gives the stand-in and empty lists, an empty or missing summary the other stand-in; entries of lists are texts."""
    unread, none, lists = LEVELS[level]
    fields = F.from_json(json_reply(reply), f"{level}_summary string, " + ", ".join(f"{c} array<string>" for c in lists))
    there = json_reply(reply).isNotNull()
    summary = F.when(~there, unread).otherwise(F.coalesce(F.nullif(fields[f"{level}_summary"], F.lit("")), F.lit(none)))
    empty = F.array().cast("array<string>")
    return rows.withColumns({f"{level}_summary": summary} | {c: F.coalesce(F.filter(fields[c], lambda x: x.isNotNull()), empty) for c in lists}).drop(*([reply] if reply != f"{level}_summary" else []))


class Stages:
    """Named tables in a folder: a stage is computed once and read afterwards, until it is forced."""

    def __init__(self, spark: SparkSession, folder: str, force: bool = False) -> None:
        self.spark, self.folder, self.force = spark, folder.rstrip("/"), force

    def exists(self, name: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}/_SUCCESS")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def get(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if self.force or not self.exists(name):
            make().write.mode("overwrite").parquet(f"{self.folder}/{name}")
        return self.spark.read.parquet(f"{self.folder}/{name}")
