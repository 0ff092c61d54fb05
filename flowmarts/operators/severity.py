"""Severity per flow and its distribution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmarts.functions.severity import severity_classifier, severity_of
from flowmarts.operators.counting import WEIGHT, flow_count

_INPUTS = ("attack_category", "flow_bytes_s", "syn_flag_count")


def with_severity(flows: DataFrame, user_function: bool = False) -> DataFrame:
    """Adds ``severity``, in place of a column of that name; the user-function form crosses to Python in Arrow batches."""
    if "severity" in flows.columns and WEIGHT in flows.columns:  # a rollup, graded before it was counted
        return flows
    rule = severity_classifier() if user_function else severity_of
    return flows.withColumn("severity", rule(*[F.col(c) for c in _INPUTS]))


def severity_distribution(flows: DataFrame, user_function: bool = False) -> DataFrame:
    graded = with_severity(flows, user_function)
    counts = graded.groupBy("attack_category", "severity").agg(flow_count(graded).alias("count"))
    return counts.orderBy("attack_category", F.col("count").desc(), "severity")


def severity_totals(flows: DataFrame) -> DataFrame:
    """Flows per severity over all categories."""
    graded = with_severity(flows)
    return graded.groupBy("severity").agg(flow_count(graded).alias("count")).orderBy("severity")
