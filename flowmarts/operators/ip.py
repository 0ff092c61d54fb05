"""Source addresses: threat profiles, levels, target ports.

One address may send a third of all flows.  Counts are therefore combined before
each shuffle, and anything that looks at the rows of one address (a rank over its
ports, the set of its categories) runs on rows already aggregated by address and
port or category: at most 65,536 and about ten of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowmarts.functions.numbers import percent
from flowmarts.operators.counting import WEIGHT, attack, attacks_only, flow_count, flow_count_if
from flowmarts.schema import ATTACK_THRESHOLD, BENIGN, TOP_CORRELATED, TOP_SUSPICIOUS

IP = "source_ip"


def ip_category_counts(flows: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Rollup: flows per address and category; a frame that already is one passes.  ``extra`` are keys before these."""
    if set(flows.columns) == {*extra, IP, "attack_category", WEIGHT}:
        return flows
    return flows.groupBy(*extra, IP, "attack_category").agg(flow_count(flows).alias(WEIGHT))


def ip_port_counts(flows: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Rollup: flows and hostile flows per address and destination port."""
    return flows.groupBy(*extra, IP, "destination_port").agg(
        flow_count(flows).alias(WEIGHT), flow_count_if(flows, attack()).alias("attack_weight")
    )


def ip_category_stats(flows: DataFrame, approx: bool = False) -> DataFrame:
    """Flows, distinct targets and distinct target ports per address and category.

    Exact by default: Spark expands each row by the two distinct columns and
    shuffles distinct values only.  ``approx`` uses fixed-size sketches instead.
    """
    distinct = F.approx_count_distinct if approx else F.count_distinct
    return flows.groupBy(IP, "attack_category").agg(
        F.count("*").alias("flow_count"),
        distinct("destination_ip").alias("unique_targets"),
        distinct("destination_port").alias("unique_ports"),
    )


def ip_totals(flows: DataFrame) -> DataFrame:
    return flows.groupBy(IP).agg(flow_count(flows).alias("total_flows"))


def ip_attacks(flows: DataFrame) -> DataFrame:
    """Hostile flows and the sorted set of attack categories per address.

    The set is built from one row per address and category, not from flows: that
    keeps the heavy step in hash aggregation and the set step small.
    """
    per_category = ip_category_counts(attacks_only(flows))
    return per_category.groupBy(IP).agg(
        F.sum(WEIGHT).alias("attack_flows"),
        F.array_sort(F.collect_set("attack_category")).alias("attack_types"),
    )


def threat_level(attack_flows: Column, threshold: int = ATTACK_THRESHOLD) -> Column:
    return (
        F.when(attack_flows >= threshold, "HIGH").when(attack_flows > 0, "MEDIUM").otherwise("LOW")
    )


def _hostile_known() -> Column:
    # An unknown address never matches in the join form, so it has no attacks.
    return attack() & F.col(IP).isNotNull()


def ip_threat_profile(flows: DataFrame, threshold: int = ATTACK_THRESHOLD) -> DataFrame:
    """Totals, attacks, attack types, level and attack rate of every address.

    Same rows as ``ip_threat_profile_joined`` from a single scan.  One row per
    address is unbounded, so it is left unsorted; ``top_suspicious_ips`` sorts.
    """
    types = F.array_sort(F.collect_set(F.when(_hostile_known(), F.col("attack_category"))))
    profile = (
        ip_category_counts(flows)
        .groupBy(IP)
        .agg(
            F.sum(WEIGHT).alias("total_flows"),
            F.sum(F.when(_hostile_known(), F.col(WEIGHT)).otherwise(0)).alias("attack_flows"),
            types.alias("attack_types"),
        )
        .withColumn("attack_types", F.when(F.size("attack_types") > 0, F.col("attack_types")))
    )
    return _graded(profile, threshold)


def ip_threat_profile_joined(flows: DataFrame, threshold: int = ATTACK_THRESHOLD) -> DataFrame:
    """The profile as totals LEFT JOIN attacks, both unique per address."""
    joined = ip_totals(flows).join(ip_attacks(flows), IP, "left").na.fill({"attack_flows": 0})
    return _graded(joined, threshold)


def _graded(profile: DataFrame, threshold: int) -> DataFrame:
    return profile.withColumns(
        {
            "threat_level": threat_level(F.col("attack_flows"), threshold),
            "attack_rate_pct": percent(F.col("attack_flows"), F.col("total_flows"), 2),
        }
    )


def top_suspicious_ips(
    flows: DataFrame, k: int = TOP_SUSPICIOUS, threshold: int = ATTACK_THRESHOLD
) -> DataFrame:
    """The ``k`` HIGH addresses with most hostile flows, ties by address."""
    high = ip_threat_profile(flows, threshold).filter(F.col("threat_level") == "HIGH")
    return high.orderBy(F.col("attack_flows").desc(), IP).limit(k)


def ip_class(flows: DataFrame, threshold: int = ATTACK_THRESHOLD) -> DataFrame:
    """clean, malicious or mixed.

    Read as: at or above the threshold is malicious, no attack at all is clean,
    both kinds below the threshold is mixed.  Attacks only, below the threshold,
    fit none of the three and give null.
    """
    counts = flows.groupBy(IP).agg(
        flow_count_if(flows, attack()).alias("attack_flows"),
        flow_count_if(flows, F.col("attack_category") == BENIGN).alias("benign_flows"),
    )
    kind = (
        F.when(F.col("attack_flows") >= threshold, "malicious")
        .when(F.col("attack_flows") == 0, "clean")
        .when(F.col("benign_flows") > 0, "mixed")
    )
    return counts.withColumn("ip_class", kind)


def _attack_counts(flows: DataFrame) -> DataFrame:
    return flows.groupBy(IP).agg(
        flow_count(flows).alias("total_flows"),
        flow_count_if(flows, _hostile_known()).alias("attack_flows"),
    )


def threat_summary(flows: DataFrame, threshold: int = ATTACK_THRESHOLD) -> DataFrame:
    """Addresses per threat level."""
    level = threat_level(F.col("attack_flows"), threshold).alias("threat_level")
    return _attack_counts(flows).groupBy(level).agg(F.count("*").alias("count"))


def threat_kpis(flows: DataFrame, threshold: int = ATTACK_THRESHOLD) -> DataFrame:
    """Addresses per level in one row, with the share of HIGH (0 without addresses)."""
    level = threat_level(F.col("attack_flows"), threshold)
    counts = _attack_counts(flows).agg(
        *[F.count_if(level == name.upper()).alias(name) for name in ("high", "medium", "low")],
        F.count("*").alias("total_ips"),
    )
    share = F.coalesce(F.try_divide("high", "total_ips") * 100, F.lit(0.0))
    return counts.withColumn("high_pct", share)


def high_threat_ip_count(flows: DataFrame, threshold: int = ATTACK_THRESHOLD) -> DataFrame:
    """Number of addresses with at least ``threshold`` hostile flows."""
    hostile = attacks_only(flows)
    counts = hostile.groupBy(IP).agg(flow_count(hostile).alias("n"))
    return counts.filter(F.col("n") >= threshold).agg(F.count("*").alias("high_threat_ips"))


def overview_kpis(flows: DataFrame, threshold: int = ATTACK_THRESHOLD) -> DataFrame:
    """Totals, hostile and benign flows, HIGH addresses and flood flows in one row."""
    benign = F.col("attack_category").eqNullSafe(BENIGN)
    flood = F.col("attack_category").isin("DoS", "DDoS")
    per_ip = flows.groupBy(IP).agg(
        flow_count(flows).alias("total"),
        flow_count_if(flows, ~benign).alias("hostile"),
        flow_count_if(flows, flood).alias("flood"),
        flow_count_if(flows, _hostile_known()).alias("attack_flows"),
    )

    def summed(column: str) -> Column:
        return F.coalesce(F.sum(column), F.lit(0))

    return per_ip.agg(
        summed("total").alias("total_records"),
        summed("hostile").alias("attack_flows"),
        (summed("total") - summed("hostile")).alias("benign_flows"),
        F.count_if(F.col("attack_flows") >= threshold).alias("high_threat_ips"),
        summed("flood").alias("dos_ddos_flows"),
    )


def _port_counts(flows: DataFrame) -> DataFrame:
    """``ip_port_counts``, unless ``flows`` already is that rollup."""
    return flows if "attack_weight" in flows.columns else ip_port_counts(flows)


def ip_profile(flows: DataFrame) -> DataFrame:
    """Flows, hostile flows, distinct target ports and attack ratio per address.

    Distinct ports are the rows of the address-and-port rollup that have a port.
    """
    profile = _port_counts(flows).groupBy(IP).agg(
        F.sum(WEIGHT).alias("total_flows"),
        F.sum("attack_weight").alias("attack_flows"),
        F.count("destination_port").alias("unique_ports_targeted"),
    )
    return profile.withColumn(
        "attack_ratio", percent(F.col("attack_flows"), F.col("total_flows"), 1)
    )


def top_port_per_ip(flows: DataFrame) -> DataFrame:
    """Most used target port of every address; ports that tie are all kept."""
    most_used = Window.partitionBy(IP).orderBy(F.col("port_count").desc())
    return (
        _port_counts(flows)
        .select(IP, F.col("destination_port"), F.col(WEIGHT).alias("port_count"))
        .withColumn("port_rank", F.rank().over(most_used))
        .filter(F.col("port_rank") == 1)
        .select(IP, F.col("destination_port").alias("primary_target_port"), "port_count")
    )


def ip_port_correlation(
    flows: DataFrame, k: int = TOP_CORRELATED, min_ratio: float = 50
) -> DataFrame:
    """Mostly hostile addresses with their primary port(s), ``k`` rows.

    The ratio is compared after rounding.  An address with tied ports has a row for
    each.  Totals and ranks are windows over the address-and-port rollup, so there is
    one scan, and an address brings at most 65,537 rows to its task.
    """
    address = Window.partitionBy(IP)
    most_used = address.orderBy(F.col(WEIGHT).desc())
    known = F.col(IP).isNotNull()
    # Flows without an address have no primary port: one row stands for them.
    place = F.when(known, F.rank().over(most_used)).otherwise(F.row_number().over(most_used))
    profiled = _port_counts(flows).select(
        IP,
        F.sum(WEIGHT).over(address).alias("total_flows"),
        F.sum("attack_weight").over(address).alias("attack_flows"),
        F.count("destination_port").over(address).alias("unique_ports_targeted"),
        F.when(known, F.col("destination_port")).alias("primary_target_port"),
        F.when(known, F.col(WEIGHT)).alias("port_count"),
        place.alias("place"),
    )
    ratio = percent(F.col("attack_flows"), F.col("total_flows"), 1)
    return _top_correlated(profiled.filter("place = 1").withColumn("attack_ratio", ratio), k, min_ratio)


def ip_port_correlation_joined(
    flows: DataFrame, k: int = TOP_CORRELATED, min_ratio: float = 50
) -> DataFrame:
    """The correlation as address profile LEFT JOIN primary ports."""
    counts = _port_counts(flows)
    return _top_correlated(ip_profile(counts).join(top_port_per_ip(counts), IP, "left"), k, min_ratio)


def _top_correlated(profiled: DataFrame, k: int, min_ratio: float) -> DataFrame:
    columns = (
        IP,
        "total_flows",
        "attack_flows",
        "unique_ports_targeted",
        "attack_ratio",
        "primary_target_port",
        "port_count",
    )
    hostile = profiled.filter(F.col("attack_ratio") > min_ratio).select(*columns)
    return hostile.orderBy(F.col("attack_flows").desc(), IP, "primary_target_port").limit(k)
