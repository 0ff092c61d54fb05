"""Raw capture files: many CSVs whose headers differ from drop to drop."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowmarts.schema import snake_case


def unique_names(headers: Sequence[str]) -> list[str]:
    """Our column names in header order; a repeated header gets ``_1``, ``_2``."""
    seen: dict[str, int] = {}
    names = []
    for header in headers:
        name = snake_case(header)
        repeat = seen.get(name, 0)
        seen[name] = repeat + 1
        names.append(name if repeat == 0 else f"{name}_{repeat}")
    return names


def _first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a file in any store that Spark reads, decompressed by its extension; None if it is empty."""
    jvm = spark._jvm
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(hadoop).open(place)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(hadoop).getCodec(place)
        plain = stream if codec is None else codec.createInputStream(stream)
        # Buffers 8 kB at a time, and goes on reading only as long as the line does.
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine()
    finally:
        stream.close()


def file_headers(spark: SparkSession, paths: Sequence[str], glob: str, threads: int = 32) -> list[tuple[str, tuple[str, ...]]]:
    """Path and header of every capture that has a line, in the order of the paths.

    The files are listed, and the first bytes of each are read through Spark's own file systems; no body is
    scanned. Merged output of an earlier run (``combined*``) is left out.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(list(paths)).select("path")
    names = [r.path for r in listed.orderBy("path").collect()]
    captures = [n for n in names if not n.rsplit("/", 1)[-1].lower().startswith("combined")]
    with ThreadPoolExecutor(max_workers=threads) as pool:
        lines = list(pool.map(lambda path: _first_line(spark, path), captures))
    return [
        (path, tuple(next(csv.reader([line.lstrip("\ufeff")]), [])))
        for path, line in zip(captures, lines, strict=True)
        if line is not None
    ]


def read_captures(
    spark: SparkSession, paths: str | Sequence[str], glob: str = "*.csv"
) -> list[DataFrame]:
    """One frame of text columns plus ``source_file`` per distinct header.

    A path is a file, a folder or a pattern; files of one folder may differ in their headers, as every file's
    own is read. Files with exactly the same header line form one scan, in which columns go by
    position, so neither a repeated name nor another order can shift data.

    Everything is read as text: no inference pass, and damaged numbers reach
    ``ingest`` instead of turning a whole column to text.
    """
    by_header: dict[tuple[str, ...], list[str]] = {}
    for path, header in file_headers(spark, [paths] if isinstance(paths, str) else paths, glob):
        by_header.setdefault(header, []).append(path)

    scans = []
    for header, group in by_header.items():
        schema = T.StructType([T.StructField(n, T.StringType()) for n in unique_names(header)])
        reader = spark.read.options(header=True, enforceSchema=True).schema(schema)
        scans.append(reader.csv(group).select("*", F.col("_metadata.file_name").alias("source_file")))
    return scans


def read_raw_flows(
    spark: SparkSession, paths: str | Sequence[str], glob: str = "*.csv"
) -> DataFrame:
    """All captures as one frame, with nulls for what a capture lacks."""
    return union_captures(*read_captures(spark, paths, glob))


def union_captures(*captures: DataFrame) -> DataFrame:
    """UNION ALL by column name; a column missing on one side is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), captures)
