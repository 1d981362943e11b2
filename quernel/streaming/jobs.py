"""Streaming forms: resumed enrichment, sliding usage, admission under a rate limit."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from quernel.operators.incremental import Provider, enrich, offline


def read_table(spark: SparkSession, path: str, files_per_batch: int = 1) -> DataFrame:
    """A stream of the Parquet files that are or come to be in ``path``; batches of ``files_per_batch`` files."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def enrich_stream(stream: DataFrame, key: str, prompt: str, into: str, output: str, checkpoint: str, provider: Provider = offline) -> StreamingQuery:
    """Enriches a stream batch by batch into a Parquet folder, each key once: a batch leaves out keys that are in the output
    already, and a batch that is repeated after a failure replaces its own part."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        todo = batch.dropDuplicates([key])
        try:
            done = spark.read.parquet(output).where(F.col("batch") != number).select(key).distinct()
            todo = todo.join(done, key, "left_anti")
        except Exception as e:  # noqa: BLE001 - the output doesn't exist before the first batch
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
        enrich(todo, prompt, into, provider).write.mode("overwrite").parquet(f"{output}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def usage_stream(events: DataFrame, time: str, keys: list[str], amounts: list[str], seconds: int = 60, slide: int = 10, late: str = "2 minutes") -> DataFrame:
    """Events and sums of ``amounts`` in windows of ``seconds``, every ``slide`` seconds; rows later than ``late`` are dropped."""
    span = F.window(time, f"{seconds} seconds", f"{slide} seconds")
    grouped = events.withWatermark(time, late).groupBy(span.alias("span"), *keys).agg(F.count(F.lit(1)).alias("events"), *[F.sum(a).alias(a) for a in amounts])
    return grouped.select(F.col("span.start").alias("start"), F.col("span.end").alias("end"), *keys, "events", *amounts)


def admit(requests: DataFrame, key: str, id: str, at_ms: str, tokens: str, max_requests: int, max_tokens: int, seconds: int = 60, keep: float = 0.9) -> DataFrame:
    """(key, id, wait_ms): how long each request must wait so that of its key no more than ``keep`` of the limits start in any
    ``seconds``. State is the starts of the last window per key, so it is bounded by the limit itself. Works on streams
    and, over all rows at once, on tables.
    """
    kinds = dict(requests.dtypes)
    most, room, span = max(1, int(max_requests * keep)), max_tokens * keep, seconds * 1000

    def walk(starts: list[tuple[int, int]], rows: pd.DataFrame) -> tuple[list[tuple[int, int]], list[int]]:
        waits = []
        for at, n in rows.sort_values([at_ms, id])[[at_ms, tokens]].itertuples(index=False):
            begin = max(at, starts[-1][0] if starts else at)
            while True:
                starts = [(s, k) for s, k in starts if s > begin - span]
                if len(starts) < most and (not starts or sum(k for _, k in starts) + n <= room):
                    break
                begin = starts[0][0] + span
            starts.append((begin, n))
            waits.append(begin - at)
        return starts, waits

    slim = requests.select(key, id, at_ms, tokens)
    schema = f"{key} {kinds[key]}, {id} {kinds[id]}, wait_ms long"
    if not requests.isStreaming:

        def once(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values([at_ms, id])
            return pd.DataFrame({key: pdf[key], id: pdf[id], "wait_ms": walk([], pdf)[1]})

        return slim.groupBy(key).applyInPandas(once, schema)

    def keep_state(name: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        starts = list(zip(*state.get)) if state.exists else []
        for pdf in batches:
            pdf = pdf.sort_values([at_ms, id])
            starts, waits = walk([(int(a), int(b)) for a, b in starts], pdf)
            yield pd.DataFrame({key: pdf[key], id: pdf[id], "wait_ms": waits})
        state.update(([s for s, _ in starts], [k for _, k in starts]))

    return slim.groupBy(key).applyInPandasWithState(keep_state, schema, "starts array<long>, tokens array<long>", "append", "NoTimeout")
