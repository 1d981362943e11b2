"""Problem 7: encoding a corpus with a public tokenizer, and back."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from quernel.functions.vocabulary import PATTERN, Encoder, ranks, vocabulary_path
from quernel.session import cut

#: Distinct pre-tokens that every task knows without a shuffle: a fixed number, each of at most so many characters.
KNOWN_WORDS, KNOWN_LENGTH = 50_000, 64
#: Distinct pre-tokens a task counts at once; beyond it they are passed on.
HELD = 200_000


def _splitter():
    import regex

    return regex.compile(PATTERN).findall


def count_words(texts: DataFrame, text: str = "text") -> DataFrame:
    """(word, n): the pre-tokens of all texts and how often they occur, counted within tasks before the shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        split, seen = _splitter(), Counter()
        for batch in batches:
            for t in batch[text]:
                if t:
                    seen.update(split(t))
            if len(seen) > HELD:
                yield pd.DataFrame({"word": list(seen), "n": list(seen.values())})
                seen.clear()
        yield pd.DataFrame({"word": list(seen), "n": list(seen.values())}).astype({"word": object, "n": "int64"})

    return texts.select(text).mapInPandas(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def encode_words(words: DataFrame, encoder: Encoder) -> DataFrame:
    """(word, n, word_ids) of distinct words with their counts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(word_ids=[encoder.ids(w) for w in batch["word"]])

    return words.select("word", "n").mapInPandas(run, "word string, n long, word_ids array<int>")


def encode(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, known_words: int = KNOWN_WORDS) -> DataFrame:
    """(doc_id, ids) of every document: its token ids, without special tokens.

    Each distinct pre-token of the corpus is encoded once. Then the pre-tokens of each document are laid out with their
    positions: the ids of the ``known_words`` most frequent ones (a fixed number of short words, so their table is
    broadcast) are put in at once, so that runs of them stay together; all others are exploded, joined with their
    ids by a shuffle in which none is frequent, and put together with the runs by position. Null and empty texts give
    an empty list; strings of special tokens are ordinary text. One row per distinct (doc_id, text); a null doc_id is
    kept. Other columns are ignored. The table is read twice.
    """
    spark = documents.sparkSession
    encoder = Encoder(spark, path or vocabulary_path())
    kind = dict(documents.dtypes)[doc_id]
    rows = documents.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))  # as text, nulls keep ids exact
    coded = cut(encode_words(count_words(rows), encoder))
    frequent = coded.where(F.length("word") <= KNOWN_LENGTH).orderBy(F.desc("n"), "word").limit(known_words).select("word", "word_ids").collect()  # bounded by both numbers
    known = spark.sparkContext.broadcast({r.word: r.word_ids for r in frequent})
    schema = StructType([StructField("doc_id", StringType()), StructField("digest", LongType()), StructField("pos", IntegerType()), StructField("word", StringType()), StructField("word_ids", ArrayType(IntegerType()))])

    def lay(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        split, table = _splitter(), known.value
        for batch in batches:
            out: list[tuple] = []
            for own, t, digest in zip(batch["doc_id"], batch["text"], batch["digest"]):
                run: list[int] = []
                start = 0
                for pos, word in enumerate(split(t) if t else ()):
                    if (ids := table.get(word)) is not None:
                        run += ids
                        continue
                    if run:
                        out.append((own, digest, start, None, run))
                        run = []
                    out.append((own, digest, pos, word, None))
                    start = pos + 1
                if run or not t or not start:
                    out.append((own, digest, start, None, run))
            yield pd.DataFrame(out, columns=schema.names).astype({"digest": "int64", "pos": "int32"})

    # xxhash64 of a null text is that of nothing, so null and empty texts differ
    laid = cut(rows.withColumn("digest", F.xxhash64("text")).mapInPandas(lay, schema))
    parts = ["doc_id", "digest", "pos", "word_ids"]
    runs = laid.where(F.col("word").isNull()).select(*parts)
    rare = laid.where(F.col("word").isNotNull()).drop("word_ids").join(coded.select("word", "word_ids").hint("merge"), "word").select(*parts)
    put = runs.unionByName(rare).groupBy("doc_id", "digest").agg(F.sort_array(F.collect_list(F.struct("pos", "word_ids"))).alias("parts"))
    # copies of a row bring each position again: keep the first
    once = F.filter("parts", lambda p, i: (i == 0) | (F.get("parts", i - 1)["pos"] != p["pos"]))
    return put.select(F.col("doc_id").cast(kind).alias("doc_id"), F.flatten(F.transform(once, lambda p: p["word_ids"])).alias("ids"))


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) back from (doc_id, ids): each id joins the table of token bytes, the bytes are put together by
    position. Rows must be distinct in doc_id. Empty lists give empty texts. The joined table is the vocabulary, of fixed size."""
    spark = encoded.sparkSession
    table = [(i, b) for b, i in ranks(path or vocabulary_path()).items()]
    table = spark.createDataFrame(table, StructType([StructField("id", IntegerType()), StructField("token", BinaryType())]))
    places = encoded.select("doc_id", F.posexplode_outer("ids").alias("pos", "id"))
    joined = places.join(F.broadcast(table), "id", "left")
    parts = F.sort_array(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "token"))))
    together: Column = F.array_join(F.transform(parts, lambda p: F.hex(p["token"])), "")
    return joined.groupBy("doc_id").agg(F.decode(F.unhex(together), "UTF-8").alias("text"))


def count_tokens(documents: DataFrame, doc_id: str, text: str, path: str | None = None) -> DataFrame:
    """(doc_id, tokens, place) per row: how many ids its text has (0 for null and empty texts), and where it stands in
    its partition, which tells equal rows apart."""
    encoder = Encoder(documents.sparkSession, path or vocabulary_path())
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = 0
        for batch in batches:
            counts = [len(encoder.ids(t)) if t else 0 for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "tokens": counts, "place": range(place, place + len(counts))})
            place += len(counts)

    return rows.mapInPandas(run, f"doc_id {dict(rows.dtypes)['doc_id']}, tokens long, place long")
