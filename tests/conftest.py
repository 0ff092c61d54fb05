import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def flows(spark, small):
    from checks import events

    return events.flows(spark, small)


FLOW_DDL = (
    "source_ip string, destination_ip string, destination_port int, protocol int, hour int,"
    " label string, attack_category string, flow_bytes_s double, flow_packets_s double,"
    " flow_duration bigint, syn_flag_count int"
)
DEFAULTS = {
    "source_ip": "a",
    "destination_ip": "d",
    "destination_port": 80,
    "protocol": 6,
    "hour": 0,
    "label": "BENIGN",
    "attack_category": "Benign",
    "flow_bytes_s": 1.0,
    "flow_packets_s": 1.0,
    "flow_duration": 1,
    "syn_flag_count": 0,
}


@pytest.fixture(scope="session")
def make_flows(spark):
    """Frame from partial rows; what a row does not give has a default."""

    def make(*rows):
        full = [tuple({**DEFAULTS, **row}[c] for c in DEFAULTS) for row in rows]
        return spark.createDataFrame(full, FLOW_DDL)

    return make


@pytest.fixture(scope="session")
def one_column(spark):
    """Apply a column function to literal values of one type."""

    def apply(function, values, dtype="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
        return [r[0] for r in df.select(function(df.v).alias("r"), "i").orderBy("i").collect()]

    return apply
