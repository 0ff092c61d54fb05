"""Comparison of two sets of task timings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmarts.functions.numbers import title_words


def _speedup(baseline: Column, candidate: Column) -> Column:
    ratio = F.when(candidate > 0, F.round(baseline / candidate, 2))
    return F.coalesce(ratio, F.lit(0.0))


def compare_timings(tasks: DataFrame, baseline: DataFrame, candidate: DataFrame) -> DataFrame:
    """Seconds of both sides per task, speed-up and the faster side.

    ``tasks`` has ``task``; the other two have ``task`` and ``seconds``, one row per
    task.  A task without a timing counts 0 s, and a 0 s candidate gives speed-up 0.
    """
    before, after = F.col("baseline_s"), F.col("candidate_s")
    return (
        tasks.join(baseline.select("task", F.col("seconds").alias("baseline_s")), "task", "left")
        .join(candidate.select("task", F.col("seconds").alias("candidate_s")), "task", "left")
        .na.fill(0.0, ["baseline_s", "candidate_s"])
        .select(
            title_words(F.col("task")).alias("task"),
            "baseline_s",
            "candidate_s",
            _speedup(before, after).alias("speedup"),
            F.when(after < before, "Candidate").otherwise("Baseline").alias("faster"),
        )
    )


def overall_speedup(comparison: DataFrame) -> DataFrame:
    """Total seconds of both sides and the overall speed-up, one row."""
    totals = comparison.agg(
        F.coalesce(F.sum("baseline_s"), F.lit(0.0)).alias("baseline_total_s"),
        F.coalesce(F.sum("candidate_s"), F.lit(0.0)).alias("candidate_total_s"),
    )
    speedup = _speedup(F.col("baseline_total_s"), F.col("candidate_total_s"))
    return totals.withColumn("overall_speedup", speedup)
