"""Flows derived from the ``events`` table of the test data.

The test data holds no flows, so every check runs on this deterministic mapping
(FIXTURES.md, section 4).  ``raw_flows`` is shaped like a capture file after its
headers were renamed; ``flows`` is the cleaned table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmarts.functions.lookups import first_match
from flowmarts.functions.network import infer_protocol
from flowmarts.operators import ingest

# File names given to the events by ``event_id % 7``.
FILES = (
    "Monday-WorkingHours.csv",
    "TUESDAY-WorkingHours.csv",
    "wednesday-workingHours.csv",
    "Thursday-Morning-WebAttacks.csv",
    "Friday-Afternoon-DDos.csv",
    "friday-after-monday.csv",
    "capture.csv",
)

# Upper bound of r -> label of a hostile event.
_LABELS = (
    (30, "DoS Hulk"),
    (36, "DoS GoldenEye"),
    (40, "DoS slowloris"),
    (43, "DoS Slowhttptest"),
    (63, "DDoS"),
    (78, "PortScan"),
    (84, "FTP-Patator"),
    (89, "SSH-Patator"),
    (92, "Bot"),
    (94, "Web Attack � Brute Force"),
    (95, "Web Attack - XSS"),
    (96, "Web Attack – Sql Injection"),
    (97, "Infiltration"),
    (98, "Heartbleed"),
)

# Port by ``k % 8``; 7 falls through to 1024 + k.
_PORTS = (80, 443, 53, 22, 21, 8080, 123)


def raw_flows(events: DataFrame, duplicates: bool = False) -> DataFrame:
    """Dirty capture rows; ``duplicates`` repeats every 50th event."""
    event, user = F.col("event_id"), F.col("user_id")
    k = F.get_json_object("props", "$.k").cast("bigint")
    r = (event * 31 + user) % 100

    risky = F.col("event_type").isin("error", "purchase")
    label = first_match(
        [
            (user % 3 == 0, "BENIGN"),
            ((user % 3 == 1) & (event % 40 != 0), " BENIGN "),
            ((user % 3 == 2) & ~risky, "BENIGN"),
            *((r < bound, text) for bound, text in _LABELS),
        ],
        "Unlisted",
    )
    port = first_match(((k % 8 == slot, F.lit(n)) for slot, n in enumerate(_PORTS)), 1024 + k)
    files = [F.lit(name) for name in FILES]
    file_name = F.element_at(F.array(*files), (event % len(files) + 1).cast("int"))

    rate = (
        F.when(event % 97 == 0, "Infinity")
        .when(event % 89 == 0, "NaN")
        .when(event % 83 == 0, "n/a")
        .otherwise((F.col("value") * 1000).cast("string"))
    )
    octets = [(1 + user % width).cast("string") for width in (50, 253)]

    source = events
    if duplicates:
        copies = F.when(event % 50 == 0, 2).otherwise(1)
        source = events.withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
    return source.select(
        file_name.alias("source_file"),
        event.cast("string").alias("flow_id"),
        F.concat(F.lit("192.168."), octets[0], F.lit("."), octets[1]).alias("source_ip"),
        F.concat(F.lit("10.0.0."), (1 + k % 19).cast("string")).alias("destination_ip"),
        (1024 + (event * 17) % 64511).cast("int").alias("source_port"),
        port.cast("int").alias("destination_port"),
        F.col("ts"),
        F.round(F.col("value") * 10000).cast("bigint").alias("flow_duration"),
        rate.alias("flow_bytes_s"),
        (F.col("value") * 10).alias("flow_packets_s"),
        (event % 9).cast("int").alias("syn_flag_count"),
        label.alias("label"),
    )


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned flow table of the events in ``sf_dir``."""
    return flows_of(spark.read.parquet(f"{sf_dir}/events.parquet"))


def repeated(events: DataFrame, copies: int) -> DataFrame:
    """The events ``copies`` times, ids and users shifted in each, so that rows and addresses differ."""
    last = events.agg(F.max("event_id").alias("event"), F.max("user_id").alias("user")).first()
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    shifted = events.withColumn("copy", copy)
    return shifted.withColumns(
        {
            "event_id": F.col("event_id") + F.col("copy") * (last.event + 1),
            "user_id": F.col("user_id") + F.col("copy") * (last.user + 1),
        }
    ).drop("copy")


def flows_of(events: DataFrame) -> DataFrame:
    """Cleaned flow table.

    The mapping sets addresses and ports, and makes no repeated rows, so the
    shuffle that removes duplicates is left out here.
    """
    raw = raw_flows(events)
    cleaned = ingest.drop_bad_rates(ingest.coerce_rates(ingest.clean_labels(raw)))
    return cleaned.withColumns(
        {
            "protocol": infer_protocol(F.col("destination_port")),
            "hour": F.hour("ts"),
            "date": F.to_date("ts"),
        }
    )
