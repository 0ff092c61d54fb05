"""Rankings inside a category and change from hour to hour."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowmarts.functions.numbers import percent
from flowmarts.operators.counting import WEIGHT, attacks_only, flow_count
from flowmarts.operators.ip import IP, ip_category_counts
from flowmarts.schema import TOP_RANK


def rank_levels(per_ip: DataFrame) -> DataFrame:
    """Rank, dense rank and share of each (category, flow count) pair.

    A rank depends on how many addresses have a larger count, so it can be read off
    a histogram of counts.  A category with N flows has fewer than sqrt(2 N)
    different counts however many addresses it has: 1.5 million for 10^12 flows.
    A window over the histogram stays small where one over addresses would pull a
    whole category into one task.
    """
    histogram = per_ip.groupBy("attack_category", F.col(WEIGHT).alias("flow_count")).agg(
        F.count("*").alias("addresses")
    )
    category = Window.partitionBy("attack_category")
    larger = category.orderBy(F.col("flow_count").desc())
    up_to_here = larger.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    flows_in_category = F.sum(F.col("flow_count") * F.col("addresses")).over(category)
    return histogram.select(
        "attack_category",
        "flow_count",
        (F.sum("addresses").over(up_to_here) - F.col("addresses") + 1).alias("rank"),
        F.row_number().over(larger).alias("dense_rank"),
        percent(F.col("flow_count"), flows_in_category, 2).alias("pct_of_category"),
    )


def top_ips_per_attack(flows: DataFrame, max_rank: int = TOP_RANK) -> DataFrame:
    """Addresses ranked 1 to ``max_rank`` by flows in each attack category, ties kept.

    The share is of all flows in the category.  The levels kept are at most
    ``max_rank`` per category, which bounds the broadcast; addresses that tie stay
    spread over the cluster.
    """
    per_ip = ip_category_counts(attacks_only(flows))
    kept = rank_levels(per_ip).filter(F.col("rank") <= max_rank)
    kept = kept.withColumn("rank", F.col("rank").cast("int"))
    return (
        per_ip.withColumnRenamed(WEIGHT, "flow_count")
        .join(F.broadcast(kept), ["attack_category", "flow_count"])
        .select(IP, "attack_category", "flow_count", "rank", "dense_rank", "pct_of_category")
        .orderBy("attack_category", "rank", IP)
    )


def hourly_attacks(flows: DataFrame) -> DataFrame:
    """Hostile flows per hour and category: at most 25 rows per category."""
    hostile = attacks_only(flows)
    return hostile.groupBy("hour", "attack_category").agg(flow_count(hostile).alias("flows"))


def hourly_attack_delta(flows: DataFrame) -> DataFrame:
    """Change against the previous hour that has flows; 0 for the first hour."""
    return _with_delta(hourly_attacks(flows))


def hourly_attack_delta_dense(flows: DataFrame) -> DataFrame:
    """Change against the previous hour of the clock; hours without flows count 0."""
    # At most 24 entries per category; rows without an hour have no place on the clock.
    entry = F.when(F.col("hour").isNotNull(), F.struct("hour", "flows"))
    by_hour = F.map_from_entries(F.collect_list(entry)).alias("by_hour")
    dense = (
        hourly_attacks(flows)
        .groupBy("attack_category")
        .agg(by_hour)
        .withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
        .withColumn("flows", F.coalesce(F.element_at("by_hour", F.col("hour")), F.lit(0)))
    )
    return _with_delta(dense.select("hour", "attack_category", "flows"))


def _with_delta(hourly: DataFrame) -> DataFrame:
    flows, before = F.col("flows"), F.col("prev_hour_flows")
    by_hour = Window.partitionBy("attack_category").orderBy("hour")
    growth = F.when(before > 0, (flows - before) / before * 100).otherwise(0)
    return (
        hourly.withColumn("prev_hour_flows", F.lag("flows").over(by_hour))
        .withColumn("delta", flows - F.coalesce(before, flows))
        .withColumn("pct_change", F.round(growth, 1))
        .orderBy("attack_category", "hour")
    )


def attack_running_total(flows: DataFrame) -> DataFrame:
    """Hostile flows accumulated over the hours of the day, per category."""
    so_far = (
        Window.partitionBy("attack_category")
        .orderBy("hour")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    totals = hourly_attacks(flows).withColumn("running_total", F.sum("flows").over(so_far))
    return totals.orderBy("attack_category", "hour")
