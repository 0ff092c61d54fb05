"""Rollups kept per date, so that a run reads the flows of new dates only.

Every table of the store is additive: counts and sums add up, maxima and sketches merge. The rollup of
any range of dates comes from the rows of its dates, and no flow is read again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmarts.operators import sketches
from flowmarts.operators.counting import WEIGHT
from flowmarts.plans import rollups

DATE = "date"
CATEGORY = "attack_category"

_SUMS = [f"{c}_{kind}" for c in rollups.MEASURES for kind in ("sum", "n")]

# Keys of a table and how each of its other columns merges.
KEYS = {
    "traffic_cube": [CATEGORY, "label", "protocol", "hour", "severity"],
    "category_port": [CATEGORY, "destination_port"],
    "ip_category": ["source_ip", CATEGORY],
    "ip_port": ["source_ip", "destination_port"],
    "percentiles": [CATEGORY],
    "distinct": [CATEGORY],
}

# Columns of the flows that any table needs; a frame of counted flows has their weight too.
_READ = {DATE, CATEGORY, "label", "protocol", "hour", *rollups.MEASURES, *sketches.DISTINCT, WEIGHT}


def _merges(name: str) -> list[Column]:
    if name == "traffic_cube":
        added = [F.sum(c).alias(c) for c in (WEIGHT, *_SUMS, "high_syn_weight")]
        return [*added, F.max("flow_bytes_s_max").alias("flow_bytes_s_max")]
    columns = [WEIGHT, "attack_weight"] if name == "ip_port" else [WEIGHT]
    return [F.sum(c).alias(c) for c in columns]


def merged(name: str, rows: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """Rows of several dates as the rollup of all of them; ``by`` keeps other keys than the table's own."""
    keys = KEYS[name] if by is None else list(by)
    if name == "percentiles":
        return sketches.merged_percentiles(rows, keys)
    if name == "distinct":
        return sketches.merged_distinct(rows, keys)
    return rows.groupBy(*keys).agg(*_merges(name))


def _per_date(name: str) -> Callable[[DataFrame], DataFrame]:
    keys = [DATE, *KEYS[name]]
    if name == "percentiles":
        return lambda flows: sketches.percentile_sketches(flows, keys)
    if name == "distinct":
        return lambda flows: sketches.distinct_sketches(flows, keys)
    return lambda flows: rollups.BUILDERS[name](flows, (DATE,))


class RollupStore:
    """Tables under ``base``, each partitioned by date; a null date is a partition too."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def _path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def _rows(self, name: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(self._path(name))
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None

    def dates(self) -> set[date | None]:
        """Dates that every table holds; one that a failed run has left in some tables only isn't among them."""
        held = []
        for name in KEYS:
            rows = self._rows(name)
            held.append(set() if rows is None else {r[0] for r in rows.select(DATE).distinct().collect()})
        return set.intersection(*held)

    def add(self, flows: DataFrame) -> list[date | None]:
        """Roll up the dates of ``flows`` that are new and return them, the null date first.

        The flows of known dates aren't read but for their date, which a table partitioned by it has in its paths. Those of
        new dates are read once: the columns that are needed are kept under ``base`` while the tables are built. A
        date is complete in the flows when it is added. A rerun after a failure replaces the partitions that are there.
        """
        here = {r[0] for r in flows.select(F.col(DATE).cast("date")).distinct().collect()}
        new = sorted(here - self.dates(), key=lambda d: (d is not None, d))
        if not new:
            return []
        wanted = F.col(DATE).isin([d for d in new if d is not None])
        wanted = wanted | F.col(DATE).isNull() if None in new else wanted
        fresh = flows.withColumn(DATE, F.col(DATE).cast("date")).filter(wanted)
        with self._staged(fresh.select(*[c for c in fresh.columns if c in _READ])) as rows:

            def write(name: str) -> None:
                writer = _per_date(name)(rows).repartition(DATE, *KEYS[name][-1:]).write.partitionBy(DATE)
                writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self._path(name))

            with ThreadPoolExecutor(max_workers=len(KEYS)) as pool:
                runs = [pool.submit(write, name) for name in KEYS]
            for run in runs:
                run.result()
        return new

    @contextmanager
    def _staged(self, rows: DataFrame) -> Iterator[DataFrame]:
        """``rows`` as a table that is removed in the end, so that what they come from is computed once for all tables."""
        path = self._path(f"_staged-{uuid.uuid4().hex}")
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        files = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        try:
            rows.write.parquet(path)
            yield self.spark.read.schema(rows.schema).parquet(path)
        finally:
            files.delete(folder, True)

    def read(self, name: str, first: date | None = None, last: date | None = None) -> DataFrame:
        """The rollup ``name`` of all dates, or of those from ``first`` to ``last``; empty frames need one ``add``."""
        rows = self._rows(name)
        if rows is None:
            raise FileNotFoundError(f"no rollup {name} under {self.base}")
        return merged(name, self._between(rows, first, last))

    def _between(self, rows: DataFrame, first: date | None, last: date | None) -> DataFrame:
        bounds = [F.col(DATE) >= F.lit(first)] if first is not None else []
        bounds += [F.col(DATE) <= F.lit(last)] if last is not None else []
        return rows.filter(reduce(Column.__and__, bounds)) if bounds else rows

    def percentiles(self, first: date | None = None, last: date | None = None) -> DataFrame:
        """The percentile report of a range of dates, from sketches."""
        return sketches.percentiles_of(self.read("percentiles", first, last))

    def distinct(self, first: date | None = None, last: date | None = None) -> DataFrame:
        """Distinct addresses, targets and ports per category in a range of dates, from sketches."""
        return sketches.distinct_of(self.read("distinct", first, last), [CATEGORY])
