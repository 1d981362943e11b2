"""Retrieval: chunks, exact similarity and substring search."""

from __future__ import annotations

import json
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernel.functions.text import chunks, col, occurrences, strip, strip_think, token_estimate, truncate_words
from quernel.operators.incremental import Provider, enrich
from quernel.operators.windows import ordered_dedup, top_per_group


def chunk_table(texts: DataFrame, source: str, text: str, size: int = 1200, overlap: int = 150) -> DataFrame:
    """(source, idx, text): fixed windows of each text, numbered from 0. Null and empty texts give none."""
    return texts.select(source, F.posexplode(chunks(text, size, overlap)).alias("idx", "text"))


def dot(a: Column | str, b: Column | str) -> Column:
    """Inner product of two arrays, summed in double."""
    return F.aggregate(F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def normalized(vector: Column | str) -> Column:
    """A vector of length 1; a zero vector stays."""
    norm = F.sqrt(dot(vector, vector))
    return F.when(norm == 0, F.transform(col(vector), lambda x: x.cast("double"))).otherwise(F.transform(col(vector), lambda x: x.cast("double") / norm))


def similar(queries: DataFrame, vectors: DataFrame, k: int, query_id: str = "query_id", id: str = "vec_id", vector: str = "embedding", block: int = 1024) -> DataFrame:
    """(query_id, id, similarity, place): the ``k`` vectors with the greatest inner product for each query, by exact
    search; ties by id.

    A stated set of queries against all vectors: queries are packed into blocks of ``block`` vectors, each a matrix of
    bounded size; a block meets a batch of vectors in one product, and only each batch's best ``k`` per query leave the
    task. No pair is ever a row, and nothing is collected.
    """
    dim = F.size(vector)
    asked = queries.select(F.col(query_id).alias("q"), F.transform(vector, lambda x: x.cast("float")).alias("v")).where(F.col("v").isNotNull())
    spread = max(1, -(-asked.count() // block))
    blocks = asked.withColumn("b", F.pmod(F.xxhash64("q"), F.lit(spread))).groupBy("b").agg(F.collect_list(F.struct("q", "v")).alias("queries"))
    blocks = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.floor((F.size("queries") - 1) / block).cast("int"))))
    blocks = blocks.select(F.slice("queries", F.col("part") * block + 1, F.lit(block)).alias("queries"))
    kinds = (dict(queries.dtypes)[query_id], dict(vectors.dtypes)[id])
    batches = vectors.where(F.col(vector).isNotNull() & (dim > 0)).select(F.col(id).alias("id"), F.transform(vector, lambda x: x.cast("float")).alias("v"))
    batches = batches.withColumn("g", F.floor(F.monotonically_increasing_id() / 4096)).groupBy("g").agg(F.collect_list(F.struct("id", "v")).alias("vectors"))

    def best(rows):
        for pdf in rows:
            for asked_, held in zip(pdf["queries"], pdf["vectors"]):
                q = np.stack([np.asarray(x["v"], dtype=np.float64) for x in asked_])
                m = np.stack([np.asarray(x["v"], dtype=np.float64) for x in held])
                ids = np.array([x["id"] for x in held])
                scores = q @ m.T
                for i, x in enumerate(asked_):
                    top = np.lexsort((ids, -scores[i]))[:k]
                    yield pd.DataFrame({query_id: [x["q"]] * len(top), id: ids[top], "similarity": scores[i][top]})

    met = batches.crossJoin(blocks)  # blocks of queries against batches of vectors: the stated query set
    found = met.select("queries", "vectors").mapInPandas(best, f"{query_id} {kinds[0]}, {id} {kinds[1]}, similarity double")
    return top_per_group(found, [query_id], [F.desc(F.round("similarity", 9)), id], k)


def substring_search(texts: DataFrame, queries: list[tuple[str, str]], id: str, text: str, k: int) -> DataFrame:
    """(query_id, id, hits, place): the ``k`` texts in which each query occurs most often (without overlap, case apart);
    texts without it are left out, ties by id. One scan for all queries, each keeps its own counts."""
    scored = texts.select(F.col(id), F.explode(F.array(*[F.struct(F.lit(n).alias("query_id"), occurrences(text, F.lit(q)).alias("hits")) for n, q in queries])).alias("m"))
    return top_per_group(scored.select("m.query_id", id, "m.hits").where("hits > 0"), ["query_id"], [F.desc("hits"), id], k)


def relevant_text(texts: DataFrame, queries: list[tuple[str, str]], source: str, order: str, text: str, k: int, budget: int) -> DataFrame:
    """(source, text) - what of a long source is relevant: its chunks searched by each query, ``k`` hits each, every text once in the
    order of queries and hits until ``budget`` characters are reached, joined by blank lines."""
    scored = texts.select(source, order, text, F.explode(F.array(*[F.struct(F.lit(i).alias("n"), occurrences(text, F.lit(q)).alias("hits")) for i, (_, q) in enumerate(queries)])).alias("m"))
    hits = top_per_group(scored.select(source, order, text, "m.n", "m.hits").where("hits > 0"), [source, "n"], [F.desc("hits"), order], k)
    kept = ordered_dedup(hits, [source], ["n", "place"], text, budget)
    ordered = F.array_sort(F.collect_list(F.struct("n", "place", text)))
    return kept.groupBy(source).agg(F.array_join(F.transform(ordered, lambda x: x[text]), "\n\n").alias("text"))


def relevant_or_whole(texts: DataFrame, queries: list[tuple[str, str]], source: str, text: str, k: int, max_tokens: int, size: int = 1200, overlap: int = 150) -> DataFrame:
    """(source, text): texts of up to ``max_tokens`` (1.3 a word) as they are; of longer ones what is relevant to ``queries``, or
    their beginning where nothing is. One row per source."""
    fits = token_estimate(text) <= max_tokens
    short = texts.where(fits).select(source, text)
    long = texts.where(~fits)
    found = relevant_text(chunk_table(long, source, text, size, overlap).withColumn("_t", strip(F.col(text))).drop(text).withColumnRenamed("_t", text), queries, source, "idx", text, k, max(512, max_tokens * 4))
    rest = long.join(found, source, "left_anti").select(source, truncate_words(text, int(max_tokens / 1.3)).alias(text))
    return short.unionByName(found).unionByName(rest)


def answer_each(asked: DataFrame, query: str, provider: Provider) -> DataFrame:
    """``asked`` with ``answer``, a struct (value, error) for each query: a failing one has its error as a text, ``Error: ...``, in
    ``value`` too, and the others go on. The provider is asked query by query."""

    def each(prompts: pd.Series) -> pd.Series:
        out = []
        for p in prompts:
            try:
                out.append(json.dumps([provider(pd.Series([p])).iloc[0], None]))
            except Exception as e:  # noqa: BLE001 - one failing query must not end the others
                out.append(json.dumps([f"Error: {e}", str(e)[:500]]))
        return pd.Series(out, index=prompts.index)

    replied = enrich(asked, query, "_answer", each)
    pair = F.from_json("_answer", "array<string>")
    return replied.withColumn("answer", F.struct(strip_think(pair[0]).alias("value"), pair[1].alias("error"))).drop("_answer", "_answer_error")


# Fixed value: where markdown is split, from the strongest boundary down; the last is between any two signs.
SEPARATORS = ("\n### ", "\n## ", "\n# ", "\n\n", "\n", " ", "")


def recursive_pieces(text: str | None, size: int = 600, overlap: int = 60, separators: tuple[str, ...] = SEPARATORS) -> list[str]:
    """``text`` in pieces of at most ``size`` characters, cut at the strongest separator that occurs; parts that are still too
    long are cut at weaker ones. Neighbouring parts are joined while they fit, and a piece begins with as many whole parts
    of the one before as fit ``overlap``. Pieces are stripped, empty ones left out; separators stay at the head of their part."""
    if not text:
        return []
    at = next((i for i, s in enumerate(separators) if s == "" or s in text), len(separators) - 1)
    mark, weaker = separators[at], separators[at + 1 :]
    if mark:
        head, *rest = text.split(mark)
        parts = [p for p in [head, *(mark + r for r in rest)] if p]
    else:
        parts = list(text)
    out: list[str] = []
    held: list[str] = []
    length = 0

    def close() -> None:
        if piece := "".join(held).strip():
            out.append(piece)

    for part in parts:
        if len(part) > size and weaker:
            close()
            held, length = [], 0
            out += recursive_pieces(part, size, overlap, weaker)
            continue
        if length + len(part) > size:
            close()
            while held and (length > overlap or length + len(part) > size):
                length -= len(held.pop(0))
        held.append(part)
        length += len(part)
    close()
    return out


def recursive_chunks(texts: DataFrame, source: str, text: str, size: int = 600, overlap: int = 60) -> DataFrame:
    """(source, idx, text): pieces of each text as by ``recursive_pieces``, numbered from 0. Null and empty texts give none."""

    @F.pandas_udf("array<string>")
    def pieces(series: pd.Series) -> pd.Series:
        return series.map(lambda t: recursive_pieces(t, size, overlap))

    return texts.select(source, F.posexplode(pieces(text)).alias("idx", text))


def gather(parts: list[DataFrame]) -> DataFrame:
    """Results of several searches as one table."""
    return reduce(DataFrame.unionByName, parts)
