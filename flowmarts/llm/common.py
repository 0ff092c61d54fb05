"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowmarts.session import shared_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = r"[\x20\x09-\x0D]+"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to ``spark.checkpoint.dir`` and read back, so that a lost executor costs a re-read.

    A temporary folder stands in only on a local master where neither the session nor its context names one.
    """
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower case of A to Z only, the same in every engine and locale."""
    return F.translate(text, UPPER, UPPER.lower())


def words(text: Column) -> Column:
    """Maximal runs of other characters than space and \\x09 to \\x0D; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def chosen_by_hash(key: Column, share: float) -> Column:
    """Whether the 64-bit hash of ``key`` lies in the least ``share`` of all; any share above 2**-64 has rows in a large table."""
    return F.lit(True) if share >= 1 else F.xxhash64(key) < F.lit(int(share * 2**64) - 2**63)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once for a row.

    A column that a lambda refers to is otherwise evaluated again for every element.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    """Equality of the named columns, null equal to null."""
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def join_table(df: DataFrame, table: DataFrame, on: Sequence[str], broadcast_rows: int = 50_000) -> DataFrame:
    """``df`` left-joined with a table of one row per key, null keys included.

    The table is counted and broadcast up to ``broadcast_rows`` rows, so that ``df`` isn't shuffled; a
    larger one is joined by a shuffle, where AQE splits hot keys. Its key columns are dropped.
    """
    renamed = table.select(*[F.col(c).alias(f"__{c}" if c in on else c) for c in table.columns])
    condition = F.lit(True)
    for name in on:
        condition = condition & df[name].eqNullSafe(renamed[f"__{name}"])
    if table.count() <= broadcast_rows:
        renamed = F.broadcast(renamed)
    return df.join(renamed, condition, "left").drop(*[f"__{c}" for c in on])


def one_row_of_each(docs: DataFrame, key: dict[str, Column], kept: DataFrame, rows: DataFrame, free: Column) -> DataFrame:
    """The rows of ``docs`` whose ``key`` (``__id, __digest``) is in ``kept``, one of each key, and the ``free`` ones.

    ``rows`` has the key of every row of ``docs``, and ``free`` says of it whether all rows of that key stay. A key that
    one row has, as nearly all have, takes a semi-join; only rows with a repeated key are grouped.
    """
    names = list(key)
    sized = rows.groupBy(*names).agg(F.count("*").alias("__n"), F.max(free).alias("__free"))
    chosen = kept.withColumn("__kept", F.lit(True))
    fate = sized.join(chosen, same(sized, chosen, names), "left").select(*[sized[n] for n in names], "__n", "__free", "__kept")
    fate = checkpointed(fate.where("__free or __kept").withColumn("__one", F.col("__free") | (F.col("__n") == 1)))
    keyed = docs.withColumns(key)
    single, several = fate.where("__one"), fate.where("not __one")
    out = keyed.join(single, same(keyed, single, names), "left_semi").select(*docs.columns)
    if several.isEmpty():
        return out
    repeated = keyed.join(several, same(keyed, several, names), "left_semi")
    whole = F.first(F.struct(*docs.columns)).alias("__row")
    return out.union(repeated.groupBy(*names).agg(whole).select("__row.*"))


def ranked(df: DataFrame, by: Sequence[str], place: Column, order: Sequence[str], counts: DataFrame | int, per_bucket: int = 2_000) -> DataFrame:
    """Add ``rank`` (from 0) in the order of ``order`` inside each group ``by``, without one task per group.

    ``place`` is a double in [0, 1) that never falls along ``order`` and is spread evenly; it cuts a group of
    ``n`` rows into ``n / per_bucket`` buckets. A window ranks the rows of a bucket, the counts of the buckets
    before give its first rank. ``counts`` has a row of ``by`` and ``n`` for each group, or is the number of
    all rows where ``by`` is empty.
    """
    if isinstance(counts, int):
        sized = df.withColumn("n", F.lit(counts).cast("long"))
    else:
        sized = join_table(df, counts.select(*by, "n"), by)
    pieces = F.ceil(F.col("n") / F.lit(per_bucket))
    cut = checkpointed(sized.withColumn("__bucket", F.floor(place * pieces).cast("long")).drop("n"))
    keys = [*by, "__bucket"]
    before = W.partitionBy(*by).orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    firsts = cut.groupBy(*keys).agg(F.count("*").alias("__rows"))
    firsts = firsts.select(*keys, F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__first"))
    inside = W.partitionBy(*keys).orderBy(*order)
    out = cut.withColumn("rank", F.row_number().over(inside).cast("long") - 1)
    out = join_table(out, checkpointed(firsts), keys)
    return out.withColumn("rank", F.col("rank") + F.col("__first")).drop("__bucket", "__first")
