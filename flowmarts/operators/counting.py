"""Counting that works on flows and on rollups of flows alike.

A rollup carries ``flow_weight``, the number of flows each of its rows stands for.
An operator built on these helpers gives the same result on the flow table and on
any rollup that keeps the columns it groups by.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmarts.schema import BENIGN

WEIGHT = "flow_weight"


def is_rollup(df: DataFrame) -> bool:
    return WEIGHT in df.columns


def flow_count(df: DataFrame) -> Column:
    """Number of flows (0 on no rows)."""
    return F.coalesce(F.sum(WEIGHT), F.lit(0)) if is_rollup(df) else F.count(F.lit(1))


def flow_count_if(df: DataFrame, condition: Column) -> Column:
    """Number of flows for which ``condition`` is true (0 on no rows)."""
    if is_rollup(df):
        return F.coalesce(F.sum(F.when(condition, F.col(WEIGHT)).otherwise(0)), F.lit(0))
    return F.count_if(condition)


def attack() -> Column:
    """True for hostile flows, ``Other`` included; null for a null category."""
    return F.col("attack_category") != BENIGN


def attacks_only(flows: DataFrame) -> DataFrame:
    return flows.filter(attack())


def of_category(flows: DataFrame, category: str) -> DataFrame:
    return flows.filter(F.col("attack_category") == category)
