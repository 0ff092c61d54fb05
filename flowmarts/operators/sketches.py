"""Percentiles and distinct counts by sketches that merge.

A sketch of a part of the flows is a few kilobytes, and sketches of parts merge into that of the
whole: of splits into salts, of salts into categories, and of dates into any range of dates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmarts.operators.percentiles import BYTES_PERCENTILES, DURATION_PERCENTILES, GROUP

# A KLL sketch with k = 4096 holds about 70 kB at most.
KLL_K = 4096
SALTS = 1024
# HLL sketches of 2^14 registers: a standard error of 1.04 / sqrt(2^14), 0.8 %.
HLL_BITS = 14

DISTINCT = ("source_ip", "destination_ip", "destination_port")


def kll_rank_error(k: int = KLL_K) -> float:
    """Rank error that a KLL sketch exceeds less than once in a million times.

    The sketch's published error is 2.296 / k^0.9021 at 99 %; twice that is five standard deviations.
    """
    return 2 * 2.296 / k**0.9021


def percentile_sketches(flows: DataFrame, by: Sequence[str] = (GROUP,), k: int = KLL_K, salts: int = SALTS) -> DataFrame:
    """``by``, ``bytes_sketch`` and ``duration_sketch``: KLL sketches of the byte rates and of the durations.

    Each split makes a sketch per group. They are merged in two levels: the splits of a salt, then the salts of a group,
    so that with up to ``salts`` squared splits no task merges more than ``salts`` sketches of a group. Nulls count
    nowhere; a group without values has empty sketches.
    """
    salt = (F.spark_partition_id() % salts).alias("_salt")
    rows = flows.select(*by, salt, F.col("flow_bytes_s").cast("double").alias("_bytes"), F.col("flow_duration").cast("bigint").alias("_duration"))
    salted = rows.groupBy(*by, "_salt").agg(
        F.kll_sketch_agg_double("_bytes", F.lit(k)).alias("bytes_sketch"),
        F.kll_sketch_agg_bigint("_duration", F.lit(k)).alias("duration_sketch"),
    )
    return merged_percentiles(salted, by, k)


def merged_percentiles(sketches: DataFrame, by: Sequence[str] = (GROUP,), k: int = KLL_K) -> DataFrame:
    """Sketches of parts, such as dates, merged per ``by``."""
    return sketches.groupBy(*by).agg(
        F.kll_merge_agg_double("bytes_sketch", F.lit(k)).alias("bytes_sketch"),
        F.kll_merge_agg_bigint("duration_sketch", F.lit(k)).alias("duration_sketch"),
    )


def percentiles_of(sketches: DataFrame, by: Sequence[str] = (GROUP,)) -> DataFrame:
    """The five columns of the percentile report from sketches: values that occur, null without any."""

    def quantiles(kind: str, column: str, shares: Sequence[float]) -> Column:
        # An empty sketch has no quantile to ask for.
        some = getattr(F, f"kll_sketch_get_n_{kind}")(column) > 0
        asked = F.array(*[F.lit(p) for p in shares])
        return F.when(some, getattr(F, f"kll_sketch_get_quantile_{kind}")(F.when(some, F.col(column)), asked))

    found = sketches.select(
        *by,
        quantiles("double", "bytes_sketch", BYTES_PERCENTILES).alias("_bytes"),
        quantiles("bigint", "duration_sketch", DURATION_PERCENTILES).alias("_duration"),
    )
    columns = [F.round(F.get("_bytes", F.lit(i)), 2).alias(f"p{int(p * 100)}_bytes") for i, p in enumerate(BYTES_PERCENTILES)]
    columns += [F.get("_duration", F.lit(i)).alias(f"p{int(p * 100)}_duration_us") for i, p in enumerate(DURATION_PERCENTILES)]
    return found.select(*by, *columns)


def flow_percentiles_sketched(flows: DataFrame, k: int = KLL_K, salts: int = SALTS) -> DataFrame:
    """p50, p90 and p99 of the byte rate, p50 and p90 of the duration per category, with the rank error of
    ``kll_rank_error(k)``."""
    found = percentiles_of(percentile_sketches(flows, k=k, salts=salts))
    return found.orderBy(F.col("p99_bytes").desc(), GROUP)


def within_rank_error(flows: DataFrame, report: DataFrame, error: float) -> DataFrame:
    """For each value of a percentile report whether its rank is within ``error`` of the one asked for, counted
    over the flows: a row per category with the report's columns as booleans, null for null.

    The report has a row per category of the closed list, so it is broadcast. Its rates are rounded to two
    digits, so a rank counts all flows that round to the value.
    """
    asked = [(f"p{int(p * 100)}_bytes", p, F.round("flow_bytes_s", 2)) for p in BYTES_PERCENTILES]
    asked += [(f"p{int(p * 100)}_duration_us", p, F.col("flow_duration")) for p in DURATION_PERCENTILES]
    met = flows.select(F.col(GROUP).alias("_category"), "flow_bytes_s", "flow_duration")
    rows = met.join(F.broadcast(report), F.col("_category").eqNullSafe(F.col(GROUP)))
    checks = []
    for column, share, value in asked:
        n = F.count(value)
        below, upto = F.count_if(value < F.col(column)), F.count_if(value <= F.col(column))
        near = (below <= F.ceil(share * n) + error * n) & (upto >= F.floor(share * n) - error * n)
        checks.append(F.when(n > 0, near).alias(column))
    return rows.groupBy(GROUP).agg(*checks)


def percentile_sketch_errors(flows: DataFrame, k: int = KLL_K) -> DataFrame:
    """The sketched percentile report with, instead of each value, whether its rank is within the sketch's error."""
    return within_rank_error(flows, flow_percentiles_sketched(flows, k), kll_rank_error(k))


def distinct_sketches(flows: DataFrame, by: Sequence[str], columns: Sequence[str] = DISTINCT, bits: int = HLL_BITS) -> DataFrame:
    """``by`` and for each column an HLL sketch of its values, ``{column}_hll``. Nulls count nowhere."""
    sketches = [F.hll_sketch_agg(c, F.lit(bits)).alias(f"{c}_hll") for c in columns]
    return flows.groupBy(*by).agg(*sketches)


def merged_distinct(sketches: DataFrame, by: Sequence[str], columns: Sequence[str] = DISTINCT) -> DataFrame:
    """Sketches of parts, such as dates, merged per ``by``; no flow is read again."""
    return sketches.groupBy(*by).agg(*[F.hll_union_agg(f"{c}_hll").alias(f"{c}_hll") for c in columns])


def distinct_of(sketches: DataFrame, by: Sequence[str], columns: Sequence[str] = DISTINCT) -> DataFrame:
    """Estimated numbers of distinct values, ``unique_{column}``, with the standard error of the sketches."""
    return sketches.select(*by, *[F.hll_sketch_estimate(f"{c}_hll").alias(f"unique_{c}") for c in columns])
