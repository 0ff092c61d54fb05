"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded hash inside their source, and the k-th of a source's n rows takes the place
(k - 1/2) / n. Sorted by that place, every stretch of the order holds the sources in their overall shares, so
cutting it into equal counts gives shards that all match the mixture.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowmarts.llm.common import checkpointed, join_table, ranked, read, same

SEED = 17
SHARDS = 8


def shuffle_key(seed: int, *parts: Column) -> Column:
    """Hex digest of the seed and the parts, null parts counting as empty."""
    plain = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *plain))


def unit(digest: Column) -> Column:
    """Number in [0, 1) from the first 32 bits of a hex digest; it rises with the digest."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))


def assign(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, stratum: str = "source") -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard`` and its ``stratum``.

    The law is ``rows``: counts of two shards differ by one at most, and each shard holds each stratum in
    its overall share, within one row for each boundary. ``slot`` counts a shard's rows from 0. ``size`` is
    the text's UTF-8 bytes plus 1, null texts having none; the CRC is of the same bytes. A null stratum is a
    stratum of its own. Ties of the seeded hash fall to ``doc_id``, CRC and size; rows equal in all of these
    are interchangeable. Equal texts are spread over the shards like other rows: equal counts and groups
    that stay together exclude each other once a group is larger than a shard. An empty table gives none.
    """
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col(stratum).cast("string").alias("stratum"),
        (F.octet_length(body).cast("long") + 1).alias("size"),
        F.crc32(body).alias("text_crc32"),
    )
    rows = checkpointed(rows.withColumn("shuffled", shuffle_key(seed, F.col("doc_id"), F.col("text_crc32"), F.col("size"))))
    counts = checkpointed(rows.groupBy("stratum").agg(F.count("*").alias("n")))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    order = ["shuffled", "doc_id", "text_crc32", "size"]
    inside = join_table(ranked(rows, ["stratum"], unit(F.col("shuffled")), order, counts), counts, ["stratum"])
    placed = inside.withColumn("place", (2 * F.col("rank") + 1) / (2 * F.col("n"))).drop("rank", "n")
    whole = ranked(placed, [], F.col("place"), ["place", "stratum", *order], total)
    # Row r belongs to shard r * shards div total, whose first row is the ceiling of shard * total / shards.
    cut = whole.withColumn("shard", F.expr(f"cast(rank * {shards} div {max(total, 1)} as int)"))
    cut = cut.withColumn("slot", F.expr(f"rank - (cast(shard as bigint) * {total} + {shards - 1}) div {shards}"))
    grown = F.lit(None).cast("int").alias("grown_shard")
    return cut.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", grown, "stratum")


def write_shards(docs: DataFrame, assigned: DataFrame, path: str) -> None:
    """Parquet files of ``docs`` under ``path/shard=k``, rows of a file in slot order.

    A row meets its place by id, CRC and size of its text; rows equal in all three take their places in any order.
    """
    key = ["__id", "__crc", "__size"]
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.withColumns({"__id": F.col("doc_id").cast("long"), "__crc": F.crc32(body), "__size": F.octet_length(body).cast("long") + 1})
    rows = rows.withColumn("__copy", F.row_number().over(W.partitionBy(*key).orderBy(F.lit(0))))
    slots = assigned.select(F.col("doc_id").alias("__id"), F.col("text_crc32").alias("__crc"), F.col("size").alias("__size"), "shard", "slot")
    slots = slots.withColumn("__copy", F.row_number().over(W.partitionBy(*key).orderBy("shard", "slot")))
    placed = rows.join(slots, same(rows, slots, [*key, "__copy"])).select(*docs.columns, "shard", "slot")
    placed = placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    placed.write.partitionBy("shard").mode("errorifexists").parquet(path)


def op8_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(read(spark, sf_dir, "documents"))
