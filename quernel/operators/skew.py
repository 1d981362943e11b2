"""Joins that stay balanced when a few keys hold much of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys joined by broadcast. Bounded by this number, whatever the data; any other key holds at most 1/HOT_KEYS of the rows.
HOT_KEYS = 256


def split_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "left", hot_keys: int = HOT_KEYS, counts: DataFrame | None = None) -> DataFrame:
    """``left`` joined with ``right`` (at most one row per key) without a hot key ever filling one task.

    The ``hot_keys`` most frequent keys of ``left`` are joined by broadcasting their rows of ``right`` (at most
    ``hot_keys`` rows, so the broadcast is bounded); all others hold at most ``1/hot_keys`` of the rows each and
    take an ordinary shuffled join. ``counts`` (``on`` and ``n``) saves counting ``left`` where that is known.
    ``how`` is ``left`` or ``inner``. Null keys never match. Empty inputs give an empty result (``left`` join: the
    left rows with nulls). Columns of ``right`` must not clash but for ``on``.
    """
    if how not in ("left", "inner"):
        raise ValueError(how)
    key = F.xxhash64(*on)  # counting by a digest shuffles eight bytes a row, not the keys
    if counts is None:
        hot = left.groupBy(key.alias("_k")).agg(F.count(F.lit(1)).alias("n"))
    else:
        hot = counts.select(key.alias("_k"), "n")
    hot = F.broadcast(hot.orderBy(F.desc("n"), "_k").limit(hot_keys).select("_k", F.lit(True).alias("_hot")))
    kept = [c for c in right.columns if c not in on]
    hot_right = F.broadcast(right.withColumn("_k", key).join(hot, "_k", "left_semi").drop("_k"))
    flagged = left.withColumn("_k", key).join(hot, "_k", "left").drop("_k")
    near = flagged.where(F.col("_hot")).drop("_hot").join(hot_right, on, how)
    far = flagged.where(F.col("_hot").isNull()).drop("_hot").join(right.hint("merge"), on, how)
    order = [*left.columns, *kept]
    return near.select(*order).unionByName(far.select(*order))
