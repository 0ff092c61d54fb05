"""Rollups that most marts are computed from.

A batch run would otherwise scan the flow table once per mart.  Four rollups, each
from one scan of a few columns, hold all that the counting marts need.  They are
written to the shared folder as tables: later marts read a fraction of the data,
and a lost executor costs a re-read, not a recomputation.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmarts.operators.counting import WEIGHT
from flowmarts.operators.ip import ip_category_counts, ip_port_counts
from flowmarts.operators.severity import with_severity
from flowmarts.schema import SYN_THRESHOLD
from flowmarts.session import shared_dir

MEASURES = ("flow_bytes_s", "flow_packets_s", "flow_duration", "syn_flag_count")


def traffic_cube(flows: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Counts and sums by category, label, protocol, hour and severity: a few thousand
    rows for the known labels, more as unknown ones occur.  Sums are doubles, as a sum of microseconds over 10^12
    flows leaves the range of a 64-bit integer.  ``extra`` are keys before these."""
    keys = [*extra, "attack_category", "label", "protocol", "hour", "severity"]
    sums = [
        measure
        for c in MEASURES
        for measure in (F.sum(F.col(c).cast("double")).alias(f"{c}_sum"), F.count(c).alias(f"{c}_n"))
    ]
    return with_severity(flows).groupBy(*keys).agg(
        F.count("*").alias(WEIGHT),
        *sums,
        F.max("flow_bytes_s").alias("flow_bytes_s_max"),
        F.count_if(F.col("syn_flag_count") > SYN_THRESHOLD).alias("high_syn_weight"),
    )


def category_port_counts(flows: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Flows per category and destination port: at most 65,537 rows per category."""
    return flows.groupBy(*extra, "attack_category", "destination_port").agg(F.count("*").alias(WEIGHT))


BUILDERS = {
    "traffic_cube": traffic_cube,
    "category_port": category_port_counts,
    "ip_category": ip_category_counts,
    "ip_port": ip_port_counts,
}


class Rollups:
    """Rollups of one flow table, each written once, when first asked for."""

    def __init__(self, spark: SparkSession, flows: DataFrame, base: str | None = None):
        self.spark = spark
        self.flows = flows
        self.base = base or f"{shared_dir(spark)}/flowmarts-rollups-{uuid.uuid4().hex}"
        self._pool = ThreadPoolExecutor(max_workers=len(BUILDERS))
        self._writing: dict[str, Future[DataFrame]] = {}
        self._lock = Lock()

    def request(self, *names: str) -> None:
        """Start writing the named rollups that are not under way yet."""
        with self._lock:
            for name in names:
                known = self._writing.get(name)
                # One that has failed is tried again by the next job that asks.
                if known is None or known.done() and known.exception() is not None:
                    self._writing[name] = self._pool.submit(self._write, name)

    def _write(self, name: str) -> DataFrame:
        path = f"{self.base}/{name}"
        rollup = BUILDERS[name](self.flows)
        rollup.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rollup.schema).parquet(path)

    def __getitem__(self, name: str) -> DataFrame:
        self.request(name)
        return self._writing[name].result()

    def drop(self) -> None:
        """Remove the tables written here."""
        self._pool.shutdown(wait=True)
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.base)
        hadoop = self.spark.sparkContext._jsc.hadoopConfiguration()
        folder.getFileSystem(hadoop).delete(folder, True)


def attack_profile(
    cube: DataFrame, ip_category: DataFrame, category_port: DataFrame
) -> DataFrame:
    """The SQL attack profile computed from rollups.

    A distinct count is the number of rollup rows with the value present, so no row
    is expanded per distinct column.  The three parts have one row per category.
    """
    key = "attack_category"

    def mean(column: str, digits: int):
        return F.round(F.try_divide(F.sum(f"{column}_sum"), F.sum(f"{column}_n")), digits)

    parts = [
        cube.groupBy(key).agg(
            F.sum(WEIGHT).alias("total_flows"),
            mean("flow_bytes_s", 2).alias("avg_bytes_per_sec"),
            mean("flow_duration", 2).alias("avg_duration_us"),
            mean("syn_flag_count", 3).alias("avg_syn_flags"),
            F.round(F.max("flow_bytes_s_max"), 2).alias("max_bytes_per_sec"),
        ),
        ip_category.groupBy(key).agg(F.count("source_ip").alias("unique_src_ips")),
        category_port.groupBy(key).agg(F.count("destination_port").alias("unique_dst_ports")),
    ]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    columns = [
        "total_flows",
        "unique_src_ips",
        "unique_dst_ports",
        "avg_bytes_per_sec",
        "avg_duration_us",
        "avg_syn_flags",
        "max_bytes_per_sec",
    ]
    merged = stacked.groupBy(key).agg(*[F.max(c).alias(c) for c in columns])
    return merged.orderBy(F.col("total_flows").desc(), key)
