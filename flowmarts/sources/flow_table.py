"""The typed flow table: Parquet partitioned by date, or a processed CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmarts.schema import NAME_TO_HEADER, NAME_TO_TYPE
from flowmarts.sources.raw import unique_names

VIEW = "network_flows"

# Microseconds are written out, as the default layout drops them; any ISO form is read.
_CSV_OUT = {"header": True, "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}


def read_flows(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Scan the flow table without an inference pass.

    For CSV the header line decides the column order, listed columns get their
    type and other columns stay text.
    """
    if fmt != "csv":
        return spark.read.format(fmt).load(path)
    headers = spark.read.option("header", True).csv(path).columns
    names = unique_names(headers)
    schema = ", ".join(f"`{h}` {NAME_TO_TYPE.get(n, 'string')}" for h, n in zip(headers, names))
    reader = spark.read.schema(schema).options(header=True, enforceSchema=False)
    return reader.csv(path).toDF(*names)


def conform(df: DataFrame) -> DataFrame:
    """Listed columns first, in order and type (typed null where absent), extras after."""
    known = [
        (F.col(name) if name in df.columns else F.lit(None)).cast(dtype).alias(name)
        for name, dtype in NAME_TO_TYPE.items()
    ]
    extras = [c for c in df.columns if c not in NAME_TO_TYPE]
    return df.select(*known, *extras)


def write_flows(flows: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write the table partitioned by date, clustered by category inside files.

    ``rebalance`` asks for one date per task but lets AQE split a date that is too
    large and join small ones, so neither a hot date nor a thousand tiny files can
    result (``spark.sql.adaptive.advisoryPartitionSizeInBytes`` is the size aimed at).
    Sorting by category lets a category filter skip row groups.
    """
    save_laid_out(flows.hint("rebalance", "date").sortWithinPartitions("date", "attack_category"), path, fmt)


def save_laid_out(flows: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write rows that lie as they should, in folders by date."""
    options = _CSV_OUT if fmt == "csv" else {}
    flows.write.mode("overwrite").partitionBy("date").options(**options).format(fmt).save(path)


def register_flow_view(flows: DataFrame, name: str = VIEW, capture_headers: bool = False) -> None:
    """Temp view for SQL; ``capture_headers`` exposes columns under their header
    text, so statements such as ``SELECT `Flow Bytes/s` ...`` run unchanged."""
    if capture_headers:
        flows = flows.withColumnsRenamed(NAME_TO_HEADER)
    flows.createOrReplaceTempView(name)
