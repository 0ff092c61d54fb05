"""Result marts on disk and back."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmarts.schema import MART_SCHEMAS


_POINTER = "_current"
_KEPT_VERSIONS = 2


def _file_system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def current_version(spark: SparkSession, folder: str) -> str | None:
    """The version that the pointer of a report's folder names; None before the first publication."""
    files, path = _file_system(spark, folder)
    pointer = spark._jvm.org.apache.hadoop.fs.Path(path, _POINTER)
    if not files.exists(pointer):
        return None
    jvm = spark._jvm
    stream = files.open(pointer)
    try:
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()


def _publish(spark: SparkSession, folder: str, version: str) -> None:
    """Point to ``version`` by one rename, then remove all but the newest versions.

    The version before stays, for those who are still reading it.
    """
    jvm = spark._jvm
    files, path = _file_system(spark, folder)
    new = jvm.org.apache.hadoop.fs.Path(path, f"{_POINTER}-{version}")
    out = files.create(new, True)
    try:
        out.write(bytearray(f"{version}\n".encode()))
    finally:
        out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.makeQualified(path).toUri(), conf)
    context.rename(files.makeQualified(new), files.makeQualified(jvm.org.apache.hadoop.fs.Path(path, _POINTER)), how)
    versions = sorted(s.getPath().getName() for s in files.listStatus(path) if s.getPath().getName().startswith("v-"))
    for old in [v for v in versions if v <= version][:-_KEPT_VERSIONS]:
        files.delete(jvm.org.apache.hadoop.fs.Path(path, old), True)


def _new_version() -> str:
    """Names that sort by time."""
    return f"v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def job_path(base: str, job: str) -> str:
    return f"{base.rstrip('/')}/{job}"


def mart_path(spark: SparkSession, base: str, job: str, mart: str) -> str:
    """Where the published version of a mart lies; a path without anything before the first publication."""
    folder = job_path(base, job)
    return f"{folder}/{current_version(spark, folder) or 'v-none'}/{mart}"


def write_marts(base: str, job: str, marts: Mapping[str, DataFrame], fmt: str = "json") -> None:
    """One folder per mart, written by the executors; nothing passes the driver.

    The marts of a job are a version of its report: they are written beside the former one, and a pointer is switched when
    all of them are there. If one fails, the former report stays as it was, and what was written is removed.
    The writes are submitted together, so that short marts run beside a long one; the first failure is raised.
    """
    if not marts:
        return
    spark = next(iter(marts.values())).sparkSession
    folder, version = job_path(base, job), _new_version()

    def write(name: str) -> None:
        marts[name].write.format(fmt).save(f"{folder}/{version}/{name}")

    _written(spark, folder, version, [lambda name=name: write(name) for name in marts])


def _written(spark: SparkSession, folder: str, version: str, writes: list[Callable[[], None]]) -> None:
    with ThreadPoolExecutor(max_workers=len(writes)) as pool:
        pending = [pool.submit(w) for w in writes]
    try:
        for outcome in pending:
            outcome.result()
    except BaseException:
        files, path = _file_system(spark, f"{folder}/{version}")
        files.delete(path, True)
        raise
    _publish(spark, folder, version)


def write_document(base: str, job: str, marts: Mapping[str, DataFrame]) -> None:
    """All marts of a job as one JSON folder, in which a row names its mart and its place in the report.

    The executors write it, whatever the number of rows. ``place`` rises with the order of the mart. It is published
    like marts are: a failure leaves the former document readable.
    """

    def rows(name: str) -> DataFrame:
        line = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
        return marts[name].select(F.lit(name).alias("mart"), F.monotonically_increasing_id().alias("place"), line.alias("row"))

    document = reduce(DataFrame.union, map(rows, marts))
    folder, version = f"{job_path(base, job)}.json", _new_version()
    _written(document.sparkSession, folder, version, [lambda: document.write.json(f"{folder}/{version}/rows")])


def document_path(spark: SparkSession, base: str, job: str) -> str:
    folder = f"{job_path(base, job)}.json"
    return f"{folder}/{current_version(spark, folder) or 'v-none'}/rows"


def read_document(spark: SparkSession, base: str, job: str) -> dict[str, list[dict]]:
    """The document of a job, for reports that fit the driver; empty if it has not been written."""
    try:
        stored = spark.read.schema("mart string, place bigint, row string").json(document_path(spark, base, job))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    document: dict[str, list[dict]] = {}
    for line in stored.orderBy("mart", "place").toLocalIterator():
        document.setdefault(line.mart, []).append(json.loads(line.row))
    return document


def document_mart(spark: SparkSession, base: str, job: str, mart: str) -> DataFrame:
    """A mart out of a job's document, of any size: its declared columns and its ``place`` in the report."""
    stored = spark.read.schema("mart string, place bigint, row string").json(document_path(spark, base, job))
    row = F.from_json("row", MART_SCHEMAS[job][mart])
    return stored.where(F.col("mart") == mart).select(row.alias("row"), "place").select("row.*", "place")


def read_mart(spark: SparkSession, base: str, job: str, mart: str, fmt: str = "json") -> DataFrame:
    """A mart with its declared schema; empty if the job has not run yet."""
    schema = MART_SCHEMAS[job][mart]
    try:
        return spark.read.schema(schema).format(fmt).load(mart_path(spark, base, job, mart))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def results_available(spark: SparkSession, base: str, fmt: str = "json") -> bool:
    """True once the attack distribution has been written."""
    try:
        spark.read.format(fmt).schema("attack_category string").load(
            mart_path(spark, base, "attack_distribution", "attack_categories")
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True
