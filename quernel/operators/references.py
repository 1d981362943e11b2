"""Orphan references: keys that name no row of another table, with the reason, at the time of the reference."""

from __future__ import annotations

from functools import reduce
from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernel.operators.skew import split_join

#: Outer white space of keys: spaces, tabs, line ends.
BLANKS = " \t\r\n"
MATCH = ("simple", "partial", "full")


def newest(df: DataFrame, keys: list[str], payload: list[str], latest: str, earliest: str) -> DataFrame:
    """One row per ``keys``: of the rows with the greatest ``latest`` the one with the smallest ``earliest``.

    Rows that tie on both are ordered by ``payload``, so the result doesn't depend on the order of the input;
    copies therefore count once. Nulls in ``latest`` and ``earliest`` come last. Null keys form a group. It is
    one aggregation that combines before the shuffle, so a key with a third of all rows fills no task.
    """
    age = F.expr(f"-timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{earliest}`)")
    rank = F.struct(F.col(latest).alias("_a"), age.alias("_b"), *[F.col(c) for c in payload])
    best = df.groupBy(*keys).agg(F.max(rank).alias("_top"))
    return best.select(*keys, *[F.col("_top")[c].alias(c) for c in payload])


def trimmed(column) -> F.Column:
    """The key without outer spaces, tabs and line ends."""
    return F.btrim(column, F.lit(BLANKS))


def orphans(
    references: DataFrame,
    targets: DataFrame,
    keys: list[str],
    time: str | None = None,
    first_seen: str | None = None,
    deleted_at: str | None = None,
    match: str = "simple",
) -> DataFrame:
    """The rows of ``references`` whose composite key names no row of ``targets``, with a column ``reason``.

    References are grouped by the null mask of ``keys``; each mask that ``match`` says must be checked is
    anti-joined on its non-null columns (a left join with a presence flag, so ``deleted`` and ``late`` come from
    the same shuffle). ``match``: ``simple`` - a null anywhere satisfies the reference; ``partial`` - the
    non-null columns must match some row, all null satisfies; ``full`` - all null satisfies, a partly null key
    is an orphan. ``reason``: ``missing`` - no such target; ``deleted`` - every matching target has
    ``deleted_at`` at or before ``time``; ``late`` - the earliest ``first_seen`` is after ``time``; ``null_key``
    - partly null under ``full``. A null ``time`` gives only ``missing``. Repeated rows of ``references`` stay;
    an empty ``targets`` makes every checked reference ``missing``. Other columns of ``targets`` are ignored,
    so they may clash.
    """
    if match not in MATCH:
        raise ValueError(match)
    columns = references.columns
    seen = F.col(first_seen) if first_seen else F.lit(None).cast("timestamp_ntz")
    gone = F.col(deleted_at) if deleted_at else F.lit(None).cast("timestamp_ntz")
    state = targets.select(*keys, seen.alias("_seen"), gone.alias("_gone"))
    when = F.col(time) if time else F.lit(None).cast("timestamp_ntz")
    parts = []
    for mask in product((False, True), repeat=len(keys)):  # True: the column is null
        if all(mask) or (match == "simple" and any(mask)):
            continue
        own = references.where(reduce(lambda a, b: a & b, [F.col(k).isNull() if m else F.col(k).isNotNull() for k, m in zip(keys, mask)]))
        if any(mask) and match == "full":
            parts.append(own.withColumn("reason", F.lit("null_key")))
            continue
        on = [k for k, m in zip(keys, mask) if not m]
        known = state.groupBy(*on).agg(
            F.min("_seen").alias("_seen"),
            F.max("_gone").alias("_gone"),
            F.bool_or(F.col("_gone").isNull()).alias("_alive"),
            F.lit(True).alias("_there"),
        )
        reason = (
            F.when(F.col("_there").isNull(), "missing")
            .when(~F.col("_alive") & (F.col("_gone") <= when), "deleted")
            .when(F.col("_seen") > when, "late")
        )
        parts.append(split_join(own, known, on).withColumn("reason", reason).where(F.col("reason").isNotNull()).select(*columns, "reason"))
    return reduce(DataFrame.unionByName, parts)


def component_targets(graph: DataFrame) -> DataFrame:
    """(repo_name, id, first_seen, deleted_at, depends_on, ingested_at) per component: its current row and the
    earliest ``ingested_at`` of all its rows, in one aggregation."""
    age = F.expr("-timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ingested_at)")
    top = F.max(F.struct(F.col("scan_time"), age.alias("age"), F.col("ingested_at"), F.col("deleted_at"), F.col("depends_on")))
    best = graph.groupBy("repo_name", "id").agg(top.alias("t"), F.min("ingested_at").alias("first_seen"))
    return best.select("repo_name", "id", "first_seen", "t.deleted_at", "t.depends_on", "t.ingested_at")


def dangling(graph: DataFrame, log: DataFrame) -> DataFrame:
    """Orphan references of ``depends_on`` and of the log's ``component_id``, one row per distinct reference.

    Columns source_table, repo_name, record_id, target_id, reason, period_month. Blank entries, and ``unknown``
    in the log, aren't references. Null arrays and null entries give nothing; ids are compared as they stand,
    so letter case counts. Declared match is ``simple``: a reference with a null ``repo_name`` isn't checked.
    """
    current = component_targets(graph)
    named = F.array_distinct(F.transform("depends_on", trimmed))  # a current row names each target once
    entries = current.select(F.lit("dependency_graph").alias("source_table"), "repo_name", F.col("id").alias("record_id"), F.explode(named).alias("id"), F.col("ingested_at").alias("at"))
    notes = log.select(F.lit("agent_log").alias("source_table"), "repo_name", F.col("log_id").cast("string").alias("record_id"), trimmed(F.col("component_id")).alias("id"), F.col("logged_at").alias("at"))
    references = entries.unionByName(notes.where(F.col("id") != "unknown")).where(F.col("id") != "")
    found = orphans(references, current.select("repo_name", "id", "first_seen", "deleted_at"), ["repo_name", "id"], "at", "first_seen", "deleted_at", "simple")
    month = F.date_format("at", "yyyy-MM").alias("period_month")
    return found.select("source_table", "repo_name", "record_id", F.col("id").alias("target_id"), "reason", month).distinct()


def per_period(found: DataFrame) -> DataFrame:
    """Counts of ``dangling`` per table, month and reason."""
    return found.groupBy("source_table", "period_month", "reason").agg(F.count(F.lit(1)).alias("orphans"))
