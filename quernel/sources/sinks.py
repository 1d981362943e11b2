"""Sinks: append-only outputs, JSON maps, pages as files."""

from __future__ import annotations

import os
import posixpath
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quernel.session import cut


def append_rows(rows: DataFrame, path: str, form: str = "json") -> None:
    """Adds rows to an output folder."""
    rows.write.mode("append").format(form).save(path)


def replace_rows(rows: DataFrame, path: str, form: str = "parquet") -> None:
    rows.write.mode("overwrite").format(form).save(path)


def component_json(components: DataFrame) -> DataFrame:
    """(id, json): each component as its JSON entry; joining the entries with braces gives the map."""
    return components.select("id", F.to_json(F.struct(*components.columns), {"ignoreNullFields": "false"}).alias("json"))


def write_component_map(components: DataFrame, path: str) -> None:
    """A map id -> component as JSON lines of one entry each, sorted by id within the files."""
    entry = F.to_json(F.create_map("id", F.struct(*components.columns)))
    components.sortWithinPartitions("id").select(entry.alias("value")).write.mode("overwrite").text(path)


def write_component_object(components: DataFrame, path: str) -> None:
    """A map id -> component as one JSON object in one file, as ``readers.component_map`` reads it. One task streams all rows into
    that file; it suits an export, ``write_component_map`` and Parquet suit large tables."""
    own = components.select(F.col("id").alias("_id"), F.to_json(F.struct("id")).alias("_k"), F.to_json(F.struct(*components.columns), {"ignoreNullFields": "false"}).alias("_v"))
    key = F.regexp_extract("_k", r'^\{"id":(.*)\}$', 1)
    place = F.row_number().over(Window.orderBy("_id"))
    lines = own.where("_id is not null").select(F.concat(F.when(place > 1, ",").otherwise("{"), key, F.lit(": "), "_v").alias("value"), place.alias("_n"))
    end = components.sparkSession.createDataFrame([(2**31 - 1,)], "_n int")
    closing = end.select(F.when(F.lit(components.where("id is not null").isEmpty()), "{}").otherwise("}").alias("value"), "_n")
    lines.unionByName(closing).coalesce(1).sortWithinPartitions("_n").select("value").write.mode("overwrite").text(path)


def log_replies(replies: DataFrame, path: str, agent: str) -> None:
    """Appends (component_id, content) as rows of an agent's log; a missing component is ``unknown``."""
    rows = replies.select(F.coalesce("component_id", F.lit("unknown")).alias("component_id"), F.lit(agent).alias("agent"), "content", F.current_timestamp().alias("logged_at"))
    append_rows(rows, path)


def append_new(rows: DataFrame, path: str, key: str, form: str = "parquet") -> int:
    """Appends the rows whose ``key`` the table at ``path`` doesn't have yet, each key once, and gives their number: how cumulative
    metadata grows. Null keys are left out."""
    new = rows.where(F.col(key).isNotNull()).dropDuplicates([key])
    spark = rows.sparkSession
    if exists(spark, path):
        new = new.join(spark.read.format(form).load(path).select(key).distinct(), key, "left_anti").select(*rows.columns)
    new = cut(new)
    append_rows(new, path, form)
    return new.count()


def _path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, files = _path(spark, path)
    return files.exists(at)


def replace_pages(pages: DataFrame, folder: str, mode: str, modes: tuple[str, ...] = ("distributed", "monolithic", "both")) -> None:
    """Writes the pages of one mode under its own folder and removes those of the other modes, which are stale by then."""
    replace_rows(pages, f"{folder.rstrip('/')}/{mode}")
    for other in modes:
        at, files = _path(pages.sparkSession, f"{folder.rstrip('/')}/{other}")
        if other != mode:
            files.delete(at, True)


def write_pages(pages: DataFrame, folder: str) -> DataFrame:
    """Writes (path, content) as files under ``folder``, a path or the address of a store that all executors reach; gives
    (path, bytes). Paths that would leave the folder are refused. A page is written under a temporary name first, so a
    repeated task leaves it whole."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        files, base = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), os.path.abspath(folder))
        for batch in batches:
            sizes = []
            for path, content in zip(batch["path"], batch["content"]):
                full = posixpath.normpath(posixpath.join(base, path))
                if not full.startswith(posixpath.normpath(base) + "/"):
                    raise ValueError(path)
                files.create_dir(posixpath.dirname(full), recursive=True)
                data = (content or "").encode("utf-8")
                with files.open_output_stream(f"{full}.{os.getpid()}.part") as f:
                    f.write(data)
                files.move(f"{full}.{os.getpid()}.part", full)
                sizes.append(len(data))
            yield pd.DataFrame({"path": batch["path"], "bytes": sizes})

    return pages.select("path", "content").mapInPandas(run, "path string, bytes long")


def manifest(pages: DataFrame) -> DataFrame:
    """(repo_name, pages): the sorted paths of each repository's pages."""
    return pages.groupBy("repo_name").agg(F.array_sort(F.collect_set("path")).alias("pages"))


def preview(text: Column | str, n: int = 20) -> Column:
    """The first lines of a page."""
    return F.array_join(F.slice(F.split(text, "\n"), 1, n), "\n")
