"""Protocols, ports, hours and per-category traffic statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmarts.functions.network import protocol_name
from flowmarts.functions.numbers import percent
from flowmarts.operators.counting import attack, flow_count, flow_count_if, is_rollup
from flowmarts.schema import TOP_PORTS


def protocol_distribution(flows: DataFrame) -> DataFrame:
    counts = flows.groupBy("protocol").agg(flow_count(flows).alias("flow_count"))
    return counts.orderBy(F.col("flow_count").desc(), "protocol")


def protocol_names(flows: DataFrame) -> DataFrame:
    """``protocol_distribution`` with the protocol's name beside its number."""
    named = protocol_distribution(flows).withColumn("protocol_name", protocol_name(F.col("protocol")))
    return named.select("protocol", "protocol_name", "flow_count")


def port_activity(flows: DataFrame) -> DataFrame:
    """Flows, hostile flows and their share per destination port."""
    hostile = F.sum("attack_weight") if "attack_weight" in flows.columns else flow_count_if(flows, attack())
    counts = flows.groupBy("destination_port").agg(
        flow_count(flows).alias("total_flows"), hostile.alias("attack_flows")
    )
    return counts.withColumn(
        "attack_ratio", percent(F.col("attack_flows"), F.col("total_flows"), 1)
    )


def top_ports(flows: DataFrame, k: int = TOP_PORTS) -> DataFrame:
    """The ``k`` busiest ports, smaller port first on a tie."""
    return port_activity(flows).orderBy(F.col("total_flows").desc(), "destination_port").limit(k)


def hourly_traffic(flows: DataFrame) -> DataFrame:
    counts = flows.groupBy("hour", "attack_category").agg(flow_count(flows).alias("flows"))
    return counts.orderBy("hour", "attack_category")


def dos_ddos_counts(flows: DataFrame) -> DataFrame:
    """Both flood counts from one scan."""
    category = F.col("attack_category")
    return flows.agg(
        flow_count_if(flows, category == "DoS").alias("dos_flows"),
        flow_count_if(flows, category == "DDoS").alias("ddos_flows"),
    )


def mean_of(flows: DataFrame, column: str) -> Column:
    """Average over flows; a rollup carries ``<column>_sum`` and ``<column>_n``."""
    if is_rollup(flows):
        return F.try_divide(F.sum(f"{column}_sum"), F.sum(f"{column}_n"))
    return F.avg(column)


def flow_profile(flows: DataFrame) -> DataFrame:
    """Mean rates and duration per category, busiest first."""
    return (
        flows.groupBy("attack_category")
        .agg(
            F.round(mean_of(flows, "flow_bytes_s"), 2).alias("avg_bytes_per_s"),
            F.round(mean_of(flows, "flow_packets_s"), 2).alias("avg_packets_per_s"),
            F.round(mean_of(flows, "flow_duration"), 2).alias("avg_duration_us"),
        )
        .orderBy(F.col("avg_bytes_per_s").desc(), "attack_category")
    )
