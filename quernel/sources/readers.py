"""Sources: repositories, JSON maps and logs, documents, search results, configuration."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

COMPONENT = "struct<id: string, component_type: string, file_path: string, relative_path: string, depends_on: array<string>, start_line: int, end_line: int, has_docstring: boolean, docstring: string>"


def repository(spark: SparkSession, root: str, name: str, pattern: str = "*.py") -> DataFrame:
    """(repo_name, relative_path, content) of every matching file under ``root``; bytes that aren't UTF-8 give a null content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    base = root.rstrip("/") + "/"
    relative = F.regexp_replace("path", r"^.*?" + "".join("\\" + c if not c.isalnum() and c not in "/_" else c for c in base), "")
    text = F.when(F.is_valid_utf8(F.col("content").cast("string")), F.decode("content", "UTF-8"))
    return files.select(F.lit(name).alias("repo_name"), relative.alias("relative_path"), text.alias("content"))


def texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of whole files."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def component_map(spark: SparkSession, path: str) -> DataFrame:
    """Components out of a JSON object id -> component; missing fields get their defaults."""
    raw = spark.read.text(path, wholetext=True)
    rows = raw.select(F.explode(F.from_json("value", f"map<string, {COMPONENT}>")).alias("key", "c"))
    return defaults(rows.select("key", "c.*").withColumn("id", F.coalesce("id", "key")).drop("key"))


def defaults(rows: DataFrame) -> DataFrame:
    """Components with defaults for what is missing: no dependencies, lines 0, no docstring."""
    values = {"depends_on": F.array().cast("array<string>"), "start_line": F.lit(0), "end_line": F.lit(0), "has_docstring": F.lit(False), "docstring": F.lit("")}
    return rows.withColumns({c: F.coalesce(F.col(c), d) for c, d in values.items() if c in rows.columns})


def json_lines(spark: SparkSession, path: str, schema: str, strict: bool = False) -> DataFrame:
    """Rows of a JSONL file. Tolerant: blank and unreadable lines are skipped; ``strict`` fails on them."""
    if strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return spark.read.schema(schema + ", _bad string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(path).where("_bad is null").drop("_bad")


def json_file(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON value over several lines."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def json_any(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """By its suffix."""
    return json_lines(spark, path, schema, strict=True) if path.endswith(".jsonl") else json_file(spark, path, schema)


def done_keys(spark: SparkSession, path: str, key: str = "component_id") -> DataFrame:
    """The distinct keys in a tolerant JSONL output; rows without one are skipped."""
    return json_lines(spark, path, f"{key} string").where(F.col(key).isNotNull()).distinct()


def decoded(base64_text: Column | str) -> Column:
    """A base64 text as UTF-8, empty if it can't be decoded."""
    return F.coalesce(F.try_to_binary(base64_text, F.lit("base64")).cast("string"), F.lit(""))


def search(repositories: DataFrame, wanted: dict) -> DataFrame:
    """Repositories by a search's conditions: owners, created_after and created_before (exclusive), languages, licenses,
    stars, forks and size (min and max, exclusive), archived, forks_allowed, min_python; sort, order, limit.

    ``python_share`` of null with a minimum above 0 is skipped; unknown conditions raise."""
    keep = F.lit(True)
    for name, value in wanted.items():
        if name in ("sort", "order", "limit") or value is None:
            continue
        if name == "owners":
            keep &= F.split_part("full_name", F.lit("/"), F.lit(1)).isin(value)
        elif name in ("created_after", "created_before"):
            at = F.to_timestamp(F.lit(value))
            keep &= F.col("created_at") > at if name == "created_after" else F.col("created_at") < at
        elif name in ("language", "license"):
            keep &= F.lower(name) == value[0].lower() if value else F.lit(True)
        elif name in ("stars", "forks", "size"):
            keep &= F.coalesce(F.col(name) > value["min"], F.lit(False)) if value.get("min") is not None else F.lit(True)
            keep &= F.coalesce(F.col(name) < value["max"], F.lit(False)) if value.get("max") is not None else F.lit(True)
        elif name in ("archived", "fork"):
            keep &= F.lit(True) if value else ~F.coalesce(F.col(name), F.lit(False))
        elif name == "min_python":
            keep &= F.coalesce(F.col("python_share") >= value, F.lit(value <= 0))
        else:
            raise ValueError(name)
    found = repositories.where(keep)
    order = wanted.get("sort", "stars")
    found = found.orderBy(F.desc(order) if wanted.get("order", "desc") == "desc" else F.asc(order), "full_name")
    return found.limit(wanted["limit"]) if wanted.get("limit") is not None else found


def python_share(bytes_by_language: Column | str) -> Column:
    """Python's share in percent of a map language -> bytes; null for null and empty maps."""
    total = F.aggregate(F.map_values(bytes_by_language), F.lit(0).cast("long"), lambda s, v: s + v.cast("long"))
    own = F.coalesce(F.try_element_at(bytes_by_language, F.lit("Python")), F.lit(0))
    return F.when(total > 0, own * 100.0 / total)


def config(path: str) -> dict:
    """A YAML file as a dictionary; an absent file is empty. JSON is read where no YAML reader is installed."""
    p = Path(path)
    if not p.exists():
        return {}
    try:
        import yaml

        return yaml.safe_load(p.read_text(encoding="utf-8")) or {}
    except ImportError:
        import json

        return json.loads(p.read_text(encoding="utf-8"))
