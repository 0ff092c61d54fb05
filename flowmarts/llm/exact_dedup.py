"""Exact deduplication by recipes of content-defined chunks.

A rolling hash over the last 32 bytes cuts the normalised text into chunks of about 1.3 kB, so equal stretches
are cut alike wherever they stand. Chunks are deduplicated by their MD5, and each identifier is verified: all
chunks under it must agree in 120 bits of their SHA-256, or these bits become part of the identifier. A document
is the ordered list of its identifiers; documents with equal lists are equal. Neither documents nor chunks are
shuffled, only digests, combined before the shuffle.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowmarts.llm.common import ascii_lower, checkpointed, let, one_row_of_each, read

WINDOW_DOUBLINGS = 5
MIN_CHUNK, CUT_BITS, MAX_CHUNK = 256, 10, 8192
CUT_MASK = np.uint32(((1 << CUT_BITS) - 1) << (32 - CUT_BITS))


def _gear() -> np.ndarray:
    """A fixed 32-bit number for each byte value, from a multiplicative rule."""
    x = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) & np.uint64((1 << 63) - 1)
    x ^= x >> np.uint64(29)
    return ((x * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32)).astype(np.uint32)


GEAR = _gear()


def cut_points(body: bytes) -> list[int]:
    """Ends of the chunks of ``body``, the last one its length; an empty body has one empty chunk."""
    size = len(body)
    if size <= MIN_CHUNK:
        return [size]
    rolling = GEAR[np.frombuffer(body, dtype=np.uint8)]
    for k in range(WINDOW_DOUBLINGS):
        step = 1 << k
        shifted = rolling[:-step] << np.uint32(step)
        rolling[step:] += shifted
    cuts, start = [], 0
    for at in (np.flatnonzero((rolling & CUT_MASK) == 0) + 1).tolist():
        while at - start > MAX_CHUNK:
            start += MAX_CHUNK
            cuts.append(start)
        if at - start >= MIN_CHUNK:
            cuts.append(at)
            start = at
    while size - start > MAX_CHUNK:
        start += MAX_CHUNK
        cuts.append(start)
    if start < size:
        cuts.append(size)
    return cuts


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def chunk_ends(texts: pd.Series) -> pd.Series:
    return pd.Series([cut_points(t.encode()) for t in texts], dtype=object)


def chunked(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with ``body``, the normalised text in UTF-8, and ``chunks``, its pieces in order."""
    norm = ascii_lower(F.coalesce(text, F.lit("")))
    cut = docs.withColumn("__norm", norm).withColumn("__ends", chunk_ends("__norm"))
    cut = cut.withColumn("body", F.col("__norm").cast("binary"))

    def piece(end: Column, i: Column) -> Column:
        start = F.coalesce(F.get("__ends", i - 1), F.lit(0))
        return F.substring(F.col("body"), start + 1, end - start)

    return cut.withColumn("chunks", F.transform("__ends", piece)).drop("__norm", "__ends")


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: ``doc_id``, ``text_sha256`` and ``recipe``, the identifiers of its chunks in order."""
    cut = chunked(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("__text")), F.col("__text"))

    def digests(chunk: Column) -> Column:
        return let(
            F.sha2(chunk, 256),
            lambda sha: F.struct(
                F.md5(chunk).alias("id"), *[F.conv(F.substring(sha, 1 + 15 * k, 15), 16, 10).cast("long").alias(f"s{k}") for k in (0, 1)]
            ),
        )

    whole = F.sha2("body", 256).alias("text_sha256")
    named = checkpointed(cut.select("doc_id", whole, F.transform("chunks", digests).alias("chunks")))
    chunks = named.select(F.explode("chunks").alias("c")).select("c.*")
    checked = chunks.groupBy("id").agg(*[f(f"s{k}").alias(f"{n}{k}") for k in (0, 1) for f, n in ((F.min, "lo"), (F.max, "hi"))])
    # Two bodies under one MD5 take a forger: the list is empty or a handful.
    forged = [r.id for r in checked.where("lo0 <> hi0 or lo1 <> hi1").select("id").toLocalIterator()]

    def identifier(c: Column) -> Column:
        return F.when(c.id.isin(forged), F.concat_ws("-", c.id, c.s0, c.s1)).otherwise(c.id) if forged else c.id

    return named.select("doc_id", "text_sha256", F.transform("chunks", identifier).alias("recipe"))


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A to Z; null counts as empty. Of equal texts the one
    with the largest ``doc_id`` stays. A null ``doc_id`` is the smallest; if all of a group are null, so is
    ``keep_id``, and all of it counts as kept, as do repeated rows of the id that stays. An empty table gives
    an empty result; other columns play no part, whatever their names.
    """
    named = recipes(docs, id_col, text_col)
    groups = named.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    joined = named.join(groups, "recipe")
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return joined.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns: one row of each group of equal texts.

    That is the row with the largest ``doc_id``, null being the smallest; of repeated rows of that id and text one
    stays. Texts that share an id are told apart by their digest. An empty table gives none.
    """
    judged = checkpointed(duplicates(docs, id_col, text_col))
    keys = judged.select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__digest"), "kept")
    norm = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    key = {"__id": F.col(id_col).cast("long"), "__digest": F.sha2(norm.cast("binary"), 256)}
    return one_row_of_each(docs, key, keys.where("kept").drop("kept").distinct(), keys, F.lit(False))


def op9_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates(read(spark, sf_dir, "documents"))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
