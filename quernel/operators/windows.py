"""Windows over time and turns: usage, cost, batches, conversations, ordered dedup under a budget."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernel.session import cut

MICROS = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{}`)"
#: A key's events are cut into stretches of so many windows each, so that one key with much of the rows fills no task.
STRETCH = 16


def _stretched(events: DataFrame, time: str, seconds: int) -> DataFrame:
    """``events`` with their microsecond ``_us`` and stretch ``_at``; those near the end of a stretch once more in the next one,
    as its past (``_own`` is false)."""
    window, length = seconds * 1_000_000, STRETCH * seconds * 1_000_000
    laid = events.withColumn("_us", F.expr(MICROS.format(time)))
    here = F.floor(F.col("_us") / length)
    own = F.struct(here.alias("at"), F.lit(True).alias("own"))
    past = F.when(F.pmod("_us", F.lit(length)) >= length - window, F.struct((here + 1).alias("at"), F.lit(False).alias("own")))
    both = F.filter(F.array(own, past), lambda x: x.isNotNull())
    return laid.withColumn("_copy", F.explode(both)).withColumn("_at", F.col("_copy.at")).withColumn("_own", F.col("_copy.own")).drop("_copy")


def sliding_usage(events: DataFrame, keys: list[str], time: str, amounts: list[str], seconds: int = 60) -> DataFrame:
    """``events`` with the number of events and the sums of ``amounts`` over the last ``seconds`` up to each event, of
    the same ``keys``; an event exactly ``seconds`` ago still counts, and so do events at the same time. Events with a
    null time are left out."""
    span = Window.partitionBy(*keys, "_at").orderBy("_us").rangeBetween(-seconds * 1_000_000, 0)
    out = _stretched(events, time, seconds)
    out = out.withColumns({"events_in_window": F.count(F.lit(1)).over(span)} | {f"{a}_in_window": F.sum(a).over(span) for a in amounts})
    return out.where("_own").drop("_us", "_at", "_own")


def waits(usage: DataFrame, time: str, limits: dict[str, float], keys: list[str], seconds: int = 60, keep: float = 0.9) -> DataFrame:
    """``usage`` (of ``sliding_usage``) with ``wait_s``: how long a request must wait until all of ``limits`` (column to
    its limit, of which ``keep`` is used) have room: until the window's oldest event leaves it; 0 if there is room."""
    span = Window.partitionBy(*keys, "_at").orderBy("_us").rangeBetween(-seconds * 1_000_000, 0)
    out = _stretched(usage, time, seconds).withColumn("_oldest", F.min("_us").over(span)).where("_own")
    full = F.lit(False)
    for c, limit in limits.items():
        full |= F.col(c) > limit * keep
    wait = F.when(full, F.greatest(F.lit(0.0), seconds - (F.col("_us") - F.col("_oldest")) / 1e6)).otherwise(0.0)
    return out.withColumn("wait_s", F.round(wait, 6)).drop("_us", "_oldest", "_at", "_own")


def running_cost(events: DataFrame, keys: list[str], time: str, order: list[str], tokens: str, per_million: float, seconds: int = 86_400) -> DataFrame:
    """``events`` with ``running_tokens`` and ``running_cost`` up to each event, per ``keys``, by ``time`` and then ``order``.

    Sums run within stretches of ``seconds``; what went before a stretch comes from the totals of the stretches, of which
    a key has few, so a key with much of the rows fills no task. A null time comes first.
    """
    laid = events.withColumn("_at", F.coalesce(F.floor(F.expr(MICROS.format(time)) / (seconds * 1_000_000)), F.lit(-(2**62))))
    inside = Window.partitionBy(*keys, "_at").orderBy(time, *order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    totals = laid.groupBy(*keys, "_at").agg(F.sum(tokens).alias("_sum")).withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    totals = totals.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_at").alias("_k_at"), "_before")
    on = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys] + [F.col("_at") == F.col("_k_at")]
    out = laid.withColumn("_inside", F.sum(tokens).over(inside)).join(totals, on)
    total = F.col("_before") + F.coalesce("_inside", F.lit(0))
    return out.withColumn("running_tokens", total).withColumn("running_cost", F.round(total * per_million / 1e6, 9)).select(*events.columns, "running_tokens", "running_cost")


def running_sums(rows: DataFrame, keys: list[str], order: list[Column], value: Column, into: str) -> DataFrame:
    """``rows`` with the sum of ``value`` up to each row, per ``keys`` in a total ``order``. Rows are range-partitioned by keys and
    order, summed within partitions, and what a key has in earlier partitions is added, so no task gets a whole key."""
    ranged = cut(rows.withColumn("_value", value).repartitionByRange(*[F.col(k).asc() for k in keys], *order).withColumn("_part", F.spark_partition_id()))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy(*keys, "_part").agg(F.sum("_value").alias("_sum")).withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
    parts = parts.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_part").alias("_k_part"), "_before")
    inside = F.sum("_value").over(Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    on = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys] + [F.col("_part") == F.col("_k_part")]
    return ranged.withColumn("_inside", inside).join(parts, on).select(*rows.columns, (F.col("_before") + F.col("_inside")).alias(into))


def batch_numbers(rows: DataFrame, keys: list[str], order: list[str], size: int = 50) -> DataFrame:
    """``rows`` with ``batch``, from 1, of ``size`` rows each per ``keys``."""
    placed = running_sums(rows, keys, [F.col(c).asc() for c in order], F.lit(1), "_place")
    return placed.withColumn("batch", (F.floor((F.col("_place") - 1) / size) + 1).cast("int")).drop("_place")


def batch_count(n: int, size: int = 50) -> int:
    return math.ceil(n / size)


def collapse_roles(turns: DataFrame, conversation: str, turn: str, role: str) -> DataFrame:
    """Turns whose role differs from the turn before: runs of one role keep their first."""
    before = F.lag(role).over(Window.partitionBy(conversation).orderBy(turn))
    return turns.withColumn("_before", before).where(F.col("_before").isNull() | (F.col("_before") != F.col(role))).drop("_before")


def ends_with_user(turns: DataFrame, conversation: str, turn: str, role: str) -> DataFrame:
    """(conversation, ok): whether the last turn is the user's."""
    return turns.groupBy(conversation).agg((F.max_by(role, turn) == "user").alias("ok"))


def newest_within(turns: DataFrame, conversation: str, turn: str, cost: str, budget: int) -> DataFrame:
    """The newest turns of each conversation whose costs together stay within ``budget``: a running sum from the end."""
    return running_sums(turns, [conversation], [F.col(turn).desc()], F.col(cost), "_sum").where(F.col("_sum") <= budget).drop("_sum")


def fit_conversation(turns: DataFrame, conversation: str, turn: str, role: str, text: str, max_tokens: int) -> DataFrame:
    """(conversation, turn, role, text, cut): what of each conversation fits ``max_tokens`` (1.3 a word and 4 a message).

    System turns stay; others are taken from the newest on while they fit; a user's turn that doesn't is cut from its
    front if more than 20 tokens are left, and the walk ends when 20 or fewer are. Sequential within a conversation,
    so a conversation is one group.
    """
    kinds = dict(turns.dtypes)
    schema = f"{conversation} {kinds[conversation]}, {turn} {kinds[turn]}, {role} string, {text} string, cut boolean"

    def cost(value: str) -> int:
        return int(len((value or "").split()) * 1.3) + 4

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(turn)
        system = pdf[role].str.lower() == "system"
        left = max_tokens - sum(cost(t) for t in pdf.loc[system, text]) - 2
        kept = [(*r, False) for r in pdf.loc[system, [conversation, turn, role, text]].itertuples(index=False)]
        for conv, number, who, words in reversed(list(pdf.loc[~system, [conversation, turn, role, text]].itertuples(index=False))):
            need = cost(words) + 2
            if need <= left:
                kept.append((conv, number, who, words, False))
                left -= need
            elif who.lower() == "user" and left > 20:
                share = left / need
                start = int(len(words) * (1 - share + (0.1 if share < 0.5 else 0)))
                short = ("[...truncated...] " if share < 0.5 else "") + words[start:].strip()
                if cost(short) + 2 <= left:
                    kept.append((conv, number, who, short, True))
                    left -= cost(short) + 2
            if left <= 20:
                break
        return pd.DataFrame(kept, columns=[conversation, turn, role, text, "cut"]).sort_values(turn)

    return turns.select(conversation, turn, role, text).groupBy(conversation).applyInPandas(run, schema)


#: Tokens that a provider adds to each message and to each call.
OVERHEADS = {"local": (4, 2), "openai": (4, 3), "gemini": (4, 0), "claude": (10, 0)}


def message_tokens(turns: DataFrame, conversation: str, text: str, per_message: int = 4, per_call: int = 2) -> DataFrame:
    """(conversation, tokens): the estimate of 1.3 tokens a word plus the overhead of messages and of the call."""
    from quernel.functions.text import token_estimate

    return turns.groupBy(conversation).agg((F.sum(F.floor(token_estimate(text)) + per_message) + per_call).cast("long").alias("tokens"))


def ordered_dedup(rows: DataFrame, keys: list[str], order: list[str], text: str, budget: int) -> DataFrame:
    """``rows`` in ``order``, each ``text`` once per ``keys``, as long as the characters of those before are under ``budget``."""
    first = rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys, text).orderBy(*order))).where("_n = 1").drop("_n")
    before = F.coalesce(F.sum(F.length(text)).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return first.withColumn("chars_before", before).where(F.col("chars_before") < budget)


def longest_section(sections: DataFrame, keys: list[str], ordinal: str, size: str) -> DataFrame:
    """(keys, ordinal): the section with the greatest size, the first of equal ones."""
    return sections.groupBy(*keys).agg(F.max_by(ordinal, F.struct(F.col(size), -F.col(ordinal))).alias(ordinal))


def top_per_group(rows: DataFrame, keys: list[str], order: list, k: int) -> DataFrame:
    """At most ``k`` rows per ``keys``, with their ``place``; the limit is pushed below the sort."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("place") <= k)
