"""Mixing sources to target weights by Poisson replication.

A source with a share w of the target and n documents repeats each of them w * target / n times in the mean.
The count of a document is drawn from the Poisson distribution with that mean, by inverting it at a number
that is a hash of the seed and the document: no state, the same on every run. Copies are exploded and dealt
out by another hash, so that the result is in a global random order.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmarts.llm.common import checkpointed, join_table, let, read
from flowmarts.llm.shards import shuffle_key

SEED = 29
TEMPERATURE = 0.5
MOST_RATE = 700


def source_rates(docs: DataFrame, weights: Mapping[str, float] | None = None, target_rows: int | None = None, temperature: float = TEMPERATURE) -> DataFrame:
    """``source, n, rate``: the mean number of copies of a document of each source.

    ``weights`` are relative shares of the named sources; others have none. Without them a source's share
    goes with ``n ** temperature``: 1 keeps the input's shares, 0 makes all sources equal. The target is
    ``target_rows`` rows in the mean, or as many as the input has.
    """
    counts = docs.groupBy(F.col("source").cast("string").alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        weight = F.pow(F.col("n").cast("double"), F.lit(float(temperature)))
    else:
        weight = F.lit(0.0)
        for name, value in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(value))).otherwise(weight)
    counts = checkpointed(counts.withColumn("weight", weight))
    total, rows = counts.agg(F.sum("weight"), F.sum("n")).first()
    goal = float(rows or 0) if target_rows is None else float(target_rows)
    rate = F.col("weight") * F.lit(goal) / (F.lit(float(total or 1.0)) * F.col("n"))
    return counts.select("source", "n", rate.alias("rate"))


def poisson_count(u: Column, rate: Column) -> Column:
    """The least k at which the distribution function with mean ``rate`` exceeds ``u`` in [0, 1).

    The fold keeps the running term and sum until ``u`` is passed, over at most ``rate + 12 * sqrt(rate) + 30`` terms, beyond which less than 2 ** -53 is left.
    It starts at ``exp(-rate)``, so the rate must not be above ``MOST_RATE``: that is 0 in a double from about 745.
    """
    most = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    start = F.struct(F.exp(-rate).alias("term"), F.exp(-rate).alias("below"), F.lit(0).alias("k"))

    def step(state: Column, k: Column) -> Column:
        term = state.term * rate / k
        passed = state.below > u
        return F.struct(
            F.when(passed, state.term).otherwise(term).alias("term"),
            F.when(passed, state.below).otherwise(state.below + term).alias("below"),
            F.when(passed, state.k).otherwise(k).alias("k"),
        )

    return F.aggregate(F.sequence(F.lit(1), most), start, step, lambda state: state.k)


def mix(docs: DataFrame, weights: Mapping[str, float] | None = None, target_rows: int | None = None, temperature: float = TEMPERATURE, seed: int = SEED) -> DataFrame:
    """``docs`` with each row repeated by its draw, in a global random order, with ``copy`` (from 1), ``copies`` and ``mix_key``.

    A rate above ``MOST_RATE`` is drawn as a sum of independent draws with equal parts of it, which is the same distribution.
    A row's draw depends on the seed, its ``doc_id`` and its text, so repeated rows are drawn alike and kept
    apart. A null source is a source of its own; a null id or text counts as empty. Columns of the input
    called like the added ones are replaced. An empty table gives an empty result.
    """
    docs = docs.drop("copy", "copies", "mix_key")
    rates = source_rates(docs, weights, target_rows, temperature).select("source", F.col("rate").alias("__rate"))
    plain = docs.withColumn("source", F.col("source").cast("string"))
    digest = shuffle_key(seed, F.col("doc_id"), F.md5(F.coalesce(F.col("text"), F.lit(""))))
    joined = join_table(plain, rates, ["source"])

    parts = F.greatest(F.lit(1), F.ceil(F.col("__rate") / MOST_RATE)).cast("int")

    def uniform(digest: Column) -> Column:
        high, low = (F.conv(F.substring(digest, at, size), 16, 10).cast("double") for at, size in ((1, 8), (9, 5)))
        return (high * float(1 << 20) + low) / F.lit(math.ldexp(1.0, 52))

    def drawn(digest: Column) -> Column:
        def count(part: Column) -> Column:
            own = F.when(part == 0, digest).otherwise(shuffle_key(seed, digest, F.lit("part"), part))
            return let(uniform(own), lambda u: poisson_count(u, F.col("__rate") / F.col("__parts")))

        counts = F.transform(F.sequence(F.lit(0), F.col("__parts") - 1), count)
        return F.struct(digest.alias("digest"), F.aggregate(counts, F.lit(0), lambda a, k: a + k).alias("copies"))

    joined = joined.withColumn("__parts", parts).withColumn("__draw", let(digest, drawn))
    at = F.posexplode(F.array_repeat(F.lit(True), F.col("__draw.copies")))
    copies = joined.select(*[joined[c] for c in plain.columns], "__draw", at.alias("__at", "__one"))
    keyed = copies.select(
        *plain.columns,
        F.col("__draw.copies").alias("copies"),
        (F.col("__at") + 1).alias("copy"),
        shuffle_key(seed, F.col("__draw.digest"), F.col("__at") + 1).alias("mix_key"),
    )
    return keyed.repartition("mix_key").sortWithinPartitions("mix_key")


def op7_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents"))
