"""How flows spread over categories, labels and hours."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowmarts.functions.numbers import percent
from flowmarts.operators.counting import attacks_only, flow_count, flow_count_if
from flowmarts.schema import BENIGN


def total_flows(flows: DataFrame) -> DataFrame:
    return flows.agg(flow_count(flows).alias("total_flows"))


def attack_distribution(flows: DataFrame, ascending: bool = False) -> DataFrame:
    """Flows per category and their share of all flows.

    The share is a window over the aggregated rows (one per category), which
    spares a second scan for the total.
    """
    counts = flows.groupBy("attack_category").agg(flow_count(flows).alias("count"))
    total = F.sum("count").over(Window.partitionBy())
    order = F.col("count").asc() if ascending else F.col("count").desc()
    return counts.withColumn("percentage", percent(F.col("count"), total, 2)).orderBy(
        order, "attack_category"
    )


def label_distribution(flows: DataFrame) -> DataFrame:
    counts = flows.groupBy("label").agg(flow_count(flows).alias("count"))
    return counts.orderBy(F.col("count").desc(), "label")


def distinct_categories(flows: DataFrame) -> DataFrame:
    return flows.select("attack_category").distinct().orderBy("attack_category")


def malicious_split(flows: DataFrame) -> DataFrame:
    """Two rows, hostile and benign; whatever is not benign is hostile, null included."""
    benign = F.col("attack_category").eqNullSafe(BENIGN)
    both = flows.agg(
        flow_count_if(flows, ~benign).alias("attack"), flow_count_if(flows, benign).alias("benign")
    )
    slices = F.stack(F.lit(2), F.lit("Attack"), F.col("attack"), F.lit("Benign"), F.col("benign"))
    return both.select(slices.alias("traffic", "flows"))


def attack_hour_matrix(flows: DataFrame) -> DataFrame:
    """Hostile flows, one row per category and one column per hour, 0 where none; ``no_hour`` counts those
    whose hour is unknown.

    The hours are listed, so no extra job looks for them.
    """
    hostile = attacks_only(flows).withColumn("hour", F.coalesce(F.col("hour").cast("int"), F.lit(-1)))
    matrix = hostile.groupBy("attack_category").pivot("hour", [*range(24), -1])
    counted = matrix.agg(flow_count(hostile)).na.fill(0)
    named = {str(h): f"h{h:02d}" for h in range(24)} | {"-1": "no_hour"}
    return counted.withColumnsRenamed(named).orderBy("attack_category")
