"""The batch runs: ingest of raw captures and the five mart jobs."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from flowmarts.operators import bruteforce, distribution, ip, percentiles, ranking
from flowmarts.operators import severity, traffic
from flowmarts.plans.capture_load import LoadReport, load_captures
from flowmarts.plans.rollups import Rollups, attack_profile
from flowmarts.sources.flow_table import conform
from flowmarts.sources.sinks import write_document, write_marts

Marts = dict[str, DataFrame]
Job = Callable[[DataFrame, Rollups], Marts]


def attack_distribution_job(flows: DataFrame, rollups: Rollups) -> Marts:
    cube = rollups["traffic_cube"]
    return {
        "total_records": distribution.total_flows(cube),
        "attack_categories": distribution.attack_distribution(cube),
        "label_distribution": distribution.label_distribution(cube),
        "attack_hour_matrix": distribution.attack_hour_matrix(cube),
    }


def suspicious_ip_job(flows: DataFrame, rollups: Rollups) -> Marts:
    per_category = rollups["ip_category"]
    return {
        "threat_summary": ip.threat_summary(per_category),
        "top_suspicious_ips": ip.top_suspicious_ips(per_category),
        "threat_kpis": ip.threat_kpis(per_category),
    }


def failed_logins_job(flows: DataFrame, rollups: Rollups) -> Marts:
    cube, ports = rollups["traffic_cube"], rollups["category_port"]
    return {
        "total_brute_force": bruteforce.brute_total(cube),
        "top_targeted_ports": bruteforce.brute_ports_top(ports),
        "top_attacking_ips": bruteforce.brute_ips_top(rollups["ip_category"]),
        "hourly_pattern": bruteforce.brute_hourly(cube),
        "high_syn": bruteforce.high_syn(cube),
        "top_targeted_port": bruteforce.top_targeted_port(ports),
    }


def traffic_analysis_job(flows: DataFrame, rollups: Rollups) -> Marts:
    cube = rollups["traffic_cube"]
    return {
        "protocol_distribution": traffic.protocol_names(cube),
        "top_ports": traffic.top_ports(rollups["category_port"]),
        "dos_ddos": traffic.dos_ddos_counts(cube),
        "flow_bytes_by_attack": traffic.flow_profile(cube),
        "hourly_traffic": traffic.hourly_traffic(cube),
    }


def advanced_analytics_job(flows: DataFrame, rollups: Rollups) -> Marts:
    cube, per_category = rollups["traffic_cube"], rollups["ip_category"]
    return {
        "sql_attack_profile": attack_profile(cube, per_category, rollups["category_port"]),
        "top_ips_per_attack": ranking.top_ips_per_attack(per_category),
        "hourly_attack_delta": ranking.hourly_attack_delta(cube),
        "attack_running_total": ranking.attack_running_total(cube),
        "ip_port_correlation": ip.ip_port_correlation(rollups["ip_port"]),
        "severity_distribution": severity.severity_distribution(cube),
        "flow_percentiles": percentiles.flow_percentiles_exact(flows),
    }


JOBS: dict[str, Job] = {
    "attack_distribution": attack_distribution_job,
    "suspicious_ip": suspicious_ip_job,
    "failed_logins": failed_logins_job,
    "traffic_analysis": traffic_analysis_job,
    "advanced_analytics": advanced_analytics_job,
}

TIMINGS_SCHEMA = "job string, seconds double, status string, error string"


def run_marts(
    spark: SparkSession,
    flows: DataFrame,
    out: str,
    fmt: str = "json",
    jobs: Mapping[str, Job] | None = None,
) -> DataFrame:
    """Run the jobs on one session and write their marts under ``out``.

    ``fmt`` is a Spark format (a folder per mart) or ``document`` (a JSON folder per job).

    The jobs are submitted together: while one waits for its last tasks another fills
    the cluster, so the seconds of the jobs overlap and ``total`` is the wall clock.
    A job that fails is recorded and the others go on.  Returns one row per job plus
    ``total``; the same rows are written as ``job_timings``.
    """
    # A table without an optional column loses what is computed from it, not whole jobs.
    flows = conform(flows)
    rollups = Rollups(spark, flows)

    def run(name: str, job: Job) -> tuple:
        started = time.perf_counter()
        try:
            marts = job(flows, rollups)
            if fmt == "document":
                write_document(out, name, marts)
            else:
                write_marts(out, name, marts, fmt)
            status, error = "ok", None
        except Exception as failure:  # a report must not take the others down
            status, error = "failed", f"{type(failure).__name__}: {failure}"
        return name, round(time.perf_counter() - started, 2), status, error

    begun = time.perf_counter()
    chosen = JOBS if jobs is None else jobs
    try:
        with ThreadPoolExecutor(max_workers=max(1, len(chosen))) as pool:
            rows = list(pool.map(run, chosen.keys(), chosen.values()))
    finally:
        rollups.drop()

    failed = any(row[2] == "failed" for row in rows)
    total = round(time.perf_counter() - begun, 2)
    rows.append(("total", total, "failed" if failed else "ok", None))
    timings = spark.createDataFrame(rows, TIMINGS_SCHEMA)
    summary = {"job_timings": timings.coalesce(1)}
    if fmt == "document":
        write_document(out, "run", summary)
    else:
        write_marts(out, "run", summary, fmt)
    return timings


def run_ingest(
    spark: SparkSession,
    raw_paths: str | Sequence[str],
    table: str,
    fmt: str = "parquet",
    types: Mapping[str, str] | None = None,
) -> LoadReport:
    """Raw captures to the partitioned flow table, with one read of the files and one shuffle of whole rows.

    Returns the audit per file and the saved flows per category. What a capture lacks is added by its own
    header, then the captures are united. ``types`` gives types to columns beyond the listed ones;
    others get a type from their values.
    """
    return load_captures(spark, raw_paths, table, fmt, types)
