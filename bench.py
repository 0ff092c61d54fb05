"""Headline timings.  Prints one JSON line.

The events of ``$BENCH_SF_DIR`` are repeated with shifted ids and users until their flows number about
2.57 million, the size of the published runs, with 12,650 addresses, and written as CSV once.  Timed are:
loading that CSV (fixed schema, full parse of the columns used), converting it to the
Parquet flow table, and then each task on the Parquet table, uncached, every result
row fetched.  Tasks do the full work of the report; the ``published_`` steps do what the published
micro-steps do, on a cached frame.  Names ending
in ``_warm`` are the same steps once more in the same session.
"""

from __future__ import annotations

import json
import math
import os
import sys
import tempfile
import time
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from flowmarts.operators import bruteforce, distribution, ip, percentiles  # noqa: E402
from flowmarts.operators import ranking, severity, traffic  # noqa: E402
from flowmarts.plans import jobs, sql  # noqa: E402
from flowmarts.schema import NAME_TO_HEADER  # noqa: E402
from flowmarts.session import get_spark  # noqa: E402
from checks import events as source  # noqa: E402
from flowmarts.sources import flow_table  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
TARGET_ROWS = int(os.environ.get("BENCH_ROWS", "2572640"))


def main() -> None:
    spark = get_spark(
        "bench",
        **{
            "spark.master": f"local[{CPUS}]",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = tempfile.mkdtemp(prefix="flowmarts-bench-")
    csv, table = f"{folder}/csv", f"{folder}/flows"

    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    copies = math.ceil(TARGET_ROWS / source.flows_of(events).count())
    every = source.flows_of(source.repeated(events.repartition(int(CPUS)), copies))
    base = flow_table.conform(every.drop("source_file"))
    base.withColumnsRenamed(NAME_TO_HEADER).write.option("header", True).csv(csv)

    seconds: dict[str, float] = {}

    def timed(name, action):
        started = time.perf_counter()
        result = action()
        seconds[name] = round(time.perf_counter() - started, 3)
        return result

    loaded = flow_table.read_flows(spark, csv, "csv")
    used = ["source_ip", "destination_ip", "destination_port", "protocol", "flow_duration"]
    used += ["flow_bytes_s", "flow_packets_s", "syn_flag_count", "label", "attack_category", "hour"]
    rows = timed("load_csv", lambda: loaded.select(F.count("*"), *map(F.max, used)).first()[0])
    timed("write_table", lambda: flow_table.write_flows(loaded, table))
    flows = flow_table.read_flows(spark, table)

    def fetch(*operators):
        """Build the frames and fetch all their rows, the frames of a task side by side."""

        def run():
            with ThreadPoolExecutor(max_workers=len(operators)) as pool:
                return list(pool.map(lambda operator: operator(flows).collect(), operators))

        return run

    # The published steps: on a frame that the first of them caches, with their reduced work.
    cached = loaded.select("label", *[c for c in used if c != "label"]).persist()
    published = {
        "attack_distribution": (distribution.attack_distribution,),
        "suspicious_ip": (ip.high_threat_ip_count,),
        "failed_logins": (bruteforce.brute_total,),
        "traffic_analysis": (traffic.protocol_distribution, lambda f: f.groupBy("destination_port").count()),
    }
    for name, operators in published.items():
        timed(f"published_{name}", lambda: [operator(cached).collect() for operator in operators])
    cached.unpersist()

    tasks = {
        "attack_distribution": (distribution.attack_distribution, distribution.label_distribution),
        "suspicious_ip": (ip.threat_summary, ip.top_suspicious_ips),
        "failed_logins": (
            bruteforce.brute_total,
            bruteforce.brute_ports_top,
            bruteforce.brute_ips_top,
            bruteforce.brute_hourly,
            bruteforce.high_syn,
        ),
        "traffic_analysis": (
            traffic.protocol_distribution,
            traffic.top_ports,
            traffic.dos_ddos_counts,
            traffic.flow_profile,
            traffic.hourly_traffic,
        ),
        "sql_attack_profile": (sql.sql_attack_profile,),
        "top_ips_per_attack": (ranking.top_ips_per_attack,),
        "hourly_attack_delta": (ranking.hourly_attack_delta,),
        "ip_port_correlation": (ip.ip_port_correlation,),
        "severity_distribution": (severity.severity_distribution,),
        "flow_percentiles": (sql.flow_percentiles,),
        "flow_percentiles_exact": (percentiles.flow_percentiles_exact,),
    }
    for turn in ("", "_warm"):
        for name, operators in tasks.items():
            timed(name + turn, fetch(*operators))
        marts = f"{folder}/marts{turn}"
        timed("all_jobs" + turn, lambda: jobs.run_marts(spark, flows, marts).collect())

    first = {name: s for name, s in seconds.items() if not name.endswith("_warm")}
    print(
        json.dumps(
            {
                "metric": "flow marts, total of all timed steps, first run of each",
                "value": round(sum(first.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": SF_DIR.rsplit("sf", 1)[-1],
                "rows": rows,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
