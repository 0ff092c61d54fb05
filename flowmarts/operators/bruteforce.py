"""Password guessing: targeted ports, sources, hours and SYN indicators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmarts.functions.network import is_login_port
from flowmarts.operators.counting import flow_count, of_category
from flowmarts.schema import BRUTE_FORCE, SYN_THRESHOLD, TOP_BRUTE


def brute_flows(flows: DataFrame, login_ports_only: bool = False) -> DataFrame:
    """Flows of the category, optionally only those to remote-login ports."""
    brute = of_category(flows, BRUTE_FORCE)
    return brute.filter(is_login_port(F.col("destination_port"))) if login_ports_only else brute


def brute_total(flows: DataFrame) -> DataFrame:
    brute = brute_flows(flows)
    return brute.agg(flow_count(brute).alias("brute_flows"))


def _top(flows: DataFrame, key: str, name: str, k: int) -> DataFrame:
    brute = brute_flows(flows)
    counts = brute.groupBy(key).agg(flow_count(brute).alias(name))
    return counts.orderBy(F.col(name).desc(), key).limit(k)


def brute_ports_top(flows: DataFrame, k: int = TOP_BRUTE) -> DataFrame:
    return _top(flows, "destination_port", "brute_flows", k)


def brute_ips_top(flows: DataFrame, k: int = TOP_BRUTE) -> DataFrame:
    return _top(flows, "source_ip", "attack_flows", k)


def brute_hourly(flows: DataFrame) -> DataFrame:
    brute = brute_flows(flows)
    return brute.groupBy("hour").agg(flow_count(brute).alias("brute_flows")).orderBy("hour")


def high_syn_flows(flows: DataFrame, threshold: int = SYN_THRESHOLD) -> DataFrame:
    return flows.filter(F.col("syn_flag_count") > threshold)


def high_syn(flows: DataFrame, threshold: int = SYN_THRESHOLD) -> DataFrame:
    """Number of flows with many SYN flags, of any category."""
    if "high_syn_weight" in flows.columns:  # rollup, counted with the default threshold
        if threshold != SYN_THRESHOLD:
            raise ValueError(f"a rollup counts above {SYN_THRESHOLD} only; give the flows for another threshold")
        counted = F.coalesce(F.sum("high_syn_weight"), F.lit(0))
    else:
        counted = F.count_if(F.col("syn_flag_count") > threshold)
    return flows.agg(counted.alias("high_syn_flows"))


def top_targeted_port(flows: DataFrame) -> DataFrame:
    """The port with most guessing flows as text (smallest on a tie), ``N/A`` if none."""
    brute = brute_flows(flows)
    counts = brute.groupBy("destination_port").agg(flow_count(brute).alias("n"))
    best = F.max_by("destination_port", F.struct("n", -F.col("destination_port")))
    return counts.agg(F.coalesce(best.cast("string"), F.lit("N/A")).alias("top_port"))
