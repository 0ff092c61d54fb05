"""Raw captures to the flow table in one read of the files and one shuffle of whole rows.

1. The captures are parsed once, repaired row by row and staged as Parquet in the shared folder.
2. Types of unlisted columns come from an aggregate over those columns.
3. Each row has a SHA-256 of its content. Copies are counted by it, which shuffles digests; from the counts come
   the audit per file, the summary per category and the rows of each date.
4. Copies of much repeated rows are dropped where they lie. The others meet in the one shuffle of whole rows, which
   deals every date over as many tasks as it has files, and there the first of equal rows stays.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowmarts.operators import ingest
from flowmarts.schema import RATE_COLUMNS
from flowmarts.session import shared_dir
from flowmarts.sources.flow_table import conform, save_laid_out
from flowmarts.sources.raw import read_captures, union_captures

# A file of the table has about so many rows, and a task sorts those of one file or a few, whatever the table's size.
ROWS_PER_FILE = 250_000
# At most so many digests are broadcast: those of rows with more than a 100,000th of all rows as copies.
HOT_KEYS = 100_000

AUDIT_SCHEMA = "source_file string, raw_rows bigint, bad_rate_rows bigint, repeated_rows bigint, saved_rows bigint"
CATEGORIES_SCHEMA = "attack_category string, flows bigint"


class LoadReport(NamedTuple):
    """``audit``: rows read, dropped and saved per file. ``categories``: rows saved per category."""

    audit: DataFrame
    categories: DataFrame


def _stage(spark: SparkSession, paths: str | Sequence[str], folder: str) -> list[DataFrame]:
    """The repaired rows of each header, written and read back with a number for each place in the files."""

    def write(capture: tuple[int, DataFrame]) -> DataFrame:
        place, raw = capture
        rows = ingest.repaired(raw)
        rows.write.parquet(f"{folder}/rows-{place}")
        back = spark.read.schema(rows.schema).parquet(f"{folder}/rows-{place}")
        at = F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
        return back.withColumn("_at", at)

    captures = list(enumerate(read_captures(spark, paths)))
    with ThreadPoolExecutor(max_workers=max(1, min(8, len(captures)))) as pool:
        return list(pool.map(write, captures))


def _keyed(staged: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Rows in the form in which repeats are compared, with ``_key``, ``_bad`` and ``date``."""
    # Adding 0.0 makes -0.0 and 0.0 one value.
    rows = ingest.alike(staged, types).withColumns({c: F.col(c) + 0.0 for c in RATE_COLUMNS})
    content = [F.col(c) for c in staged.columns if c != "_at"]
    bad = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in RATE_COLUMNS])
    return ingest.add_date(rows.withColumns({"_key": ingest.content_key(content), "_bad": bad}))


def _counts(keyed: Sequence[DataFrame]) -> DataFrame:
    """Copies of each distinct row and one of their places; only digests are shuffled, combined before."""
    names = [ingest.FILE, "date", "attack_category", "_bad", "_key"]
    narrow = reduce(DataFrame.union, [k.select(*names, "_at") for k in keyed])
    return narrow.groupBy(*names).agg(F.count("*").alias("_copies"), F.min("_at").alias("_first"))


def _report(counts: DataFrame) -> LoadReport:
    copies, good = F.col("_copies"), ~F.col("_bad")
    audit = counts.groupBy(ingest.FILE).agg(
        F.sum(copies).alias("raw_rows"),
        F.sum(F.when(~good, copies).otherwise(0)).alias("bad_rate_rows"),
        F.sum(F.when(good, copies - 1).otherwise(0)).alias("repeated_rows"),
        F.count_if(good).alias("saved_rows"),
    )
    categories = counts.where(good).groupBy("attack_category").agg(F.count("*").alias("flows"))
    spark = counts.sparkSession
    # A row per file, as many as the driver lists anyway, and a row per category of the closed list.
    return LoadReport(
        spark.createDataFrame(audit.orderBy(ingest.FILE).collect(), AUDIT_SCHEMA),
        spark.createDataFrame(categories.orderBy(F.desc("flows"), "attack_category").collect(), CATEGORIES_SCHEMA),
    )


def _slots(counts: DataFrame, rows_per_file: int) -> tuple[DataFrame, int]:
    """For each date the number of its files and of the files before; one row per date."""
    dated = counts.where(~F.col("_bad")).groupBy("date").agg(F.count("*").alias("n"))
    rows, before = [], 0
    for day, n in dated.orderBy("date").collect():
        parts = -(-n // rows_per_file)
        rows.append((day, before, parts))
        before += parts
    return counts.sparkSession.createDataFrame(rows, "_date date, _before bigint, _parts bigint"), max(1, before)


def _unrepeated(keyed: DataFrame, hot: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Finished rows of one header, of which much repeated ones are there once."""
    rows = keyed.where(~F.col("_bad")).join(F.broadcast(hot), F.col("_key") == F.col("_hot"), "left")
    rows = rows.where(F.col("_hot").isNull() | (F.col("_at") == F.col("_kept")))
    own = [c for c in keyed.columns if c not in ("_key", "_bad", "_at", "date")]
    return ingest.finished(rows.select(*own, "_key"), keys=own, types=types)


def laid_out(keyed: Sequence[DataFrame], counts: DataFrame, types: Mapping[str, str], rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """The rows of the flow table, without repeats, dealt and sorted as they are written."""
    total = counts.agg(F.coalesce(F.sum("_copies"), F.lit(0))).first()[0]
    many = F.col("_copies") > max(1, total // HOT_KEYS)
    hot = counts.where(~F.col("_bad") & many).select(F.col("_key").alias("_hot"), F.col("_first").alias("_kept"))
    flows = union_captures(*[_unrepeated(k, hot, types) for k in keyed])
    flows = conform(flows.drop(ingest.FILE))

    slots, files = _slots(counts, rows_per_file)
    placed = flows.join(F.broadcast(slots), F.col("date").eqNullSafe(F.col("_date")))
    slot = F.col("_before") + F.pmod(F.xxhash64("_key"), F.col("_parts"))
    # With four partitions a file few tasks get more than one; AQE joins no partitions that were asked for.
    dealt = placed.withColumn("_slot", slot).drop("_date", "_before", "_parts").repartition(4 * files, "_slot")
    # Sorted by date for the writer, and inside a file by category; equal rows are neighbours then.
    equal = Window.partitionBy("date", "_slot", "attack_category", "_key").orderBy("_key")
    return dealt.withColumn("_n", F.row_number().over(equal)).where("_n = 1").drop("_n", "_slot", "_key")


def load_captures(
    spark: SparkSession,
    raw_paths: str | Sequence[str],
    table: str,
    fmt: str = "parquet",
    types: Mapping[str, str] | None = None,
    rows_per_file: int = ROWS_PER_FILE,
) -> LoadReport:
    """Clean the captures into the flow table and say what became of their rows.

    ``types`` gives types to columns beyond the listed ones; others get theirs from their values. Repeats are rows of
    one file that agree in all columns, numbers by value. The staged rows are removed at the end.
    """
    folder = f"{shared_dir(spark)}/flowmarts-load-{uuid.uuid4().hex}"
    try:
        staged = _stage(spark, raw_paths, folder)
        if not staged:
            raise FileNotFoundError(f"no capture with a header under {raw_paths}")
        known = {**ingest.inferred_types([s.drop("_at") for s in staged], types), **(types or {})}
        keyed = [_keyed(s, known) for s in staged]
        _counts(keyed).write.parquet(f"{folder}/counts")
        counts = spark.read.parquet(f"{folder}/counts")
        report = _report(counts)
        save_laid_out(laid_out(keyed, counts, known, rows_per_file), table, fmt)
        return report
    finally:
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
