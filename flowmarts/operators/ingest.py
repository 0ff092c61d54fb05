"""Cleaning of raw captures into the flow table.

Order matters: labels and rates are repaired first, repeated rows go next (per
file, on the repaired source columns), and only then are representative values
added, so that two copies of a row cannot differ by them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmarts.functions import draws
from flowmarts.functions.labels import category_of, normalise_label
from flowmarts.functions.network import date_of_file, infer_protocol, parse_timestamp
from flowmarts.functions.numbers import finite_double, lenient_long, same_value
from flowmarts.schema import NAME_TO_TYPE, RATE_COLUMNS

FILE = "source_file"
_DIGEST = "_row_digest"
RESERVED = ("severity", "flow_weight", "attack_weight", "high_syn_weight")


def clean_labels(raw: DataFrame) -> DataFrame:
    """Repaired ``label`` and the ``attack_category`` it stands for."""
    repaired = raw.withColumn("label", normalise_label(F.col("label")))
    return repaired.withColumn("attack_category", category_of(F.col("label")))


def coerce_rates(raw: DataFrame) -> DataFrame:
    """Rates as doubles; unparsable, NaN and infinite values become null."""
    return raw.withColumns({c: finite_double(F.col(c)) for c in RATE_COLUMNS})


def type_columns(raw: DataFrame, types: Mapping[str, str] | None = None) -> DataFrame:
    """Text columns with a listed whole-number or double type, cast leniently.

    ``types`` adds columns to the list; others stay text, so that nothing is lost.
    """
    listed = {**NAME_TO_TYPE, **(types or {})}
    casts = {}
    for name, dtype in raw.dtypes:
        wanted = listed.get(name)
        if dtype == "string" and wanted in ("int", "bigint"):
            casts[name] = lenient_long(F.col(name)).try_cast(wanted)
        elif dtype == "string" and wanted == "double" and name not in RATE_COLUMNS:
            casts[name] = F.col(name).try_cast("double")
    return raw.withColumns(casts) if casts else raw


def alike(raw: DataFrame, types: Mapping[str, str] | None = None) -> DataFrame:
    """Text columns of a listed number type in one spelling per value, and no value lost.

    Repeats are compared on this form: casting first would make rows equal that differ in a fraction or in
    what can't be read.
    """
    listed = {**NAME_TO_TYPE, **(types or {})}
    numbers = ("int", "bigint", "double")
    names = [n for n, dtype in raw.dtypes if dtype == "string" and listed.get(n) in numbers and n not in RATE_COLUMNS]
    return raw.withColumns({n: same_value(F.col(n)) for n in names}) if names else raw


def set_aside(raw: DataFrame) -> DataFrame:
    """Capture columns with a name that rollups and marts use are called ``capture_...``."""
    return raw.withColumnsRenamed({n: f"capture_{n}" for n in RESERVED if n in raw.columns})


def drop_bad_rates(coerced: DataFrame) -> DataFrame:
    """Rows whose rates are both present (run after ``coerce_rates``)."""
    return coerced.na.drop(subset=list(RATE_COLUMNS))


def drop_repeats(cleaned: DataFrame) -> DataFrame:
    """One row per distinct content within each source file.

    All columns are grouping keys, so copies collapse before the shuffle and the
    copies of a hot row never meet in one task.  Null equals null.
    """
    return cleaned.distinct()


def _digested(df: DataFrame, keys: Sequence[str] | None, seed: int) -> DataFrame:
    names = keys or [c for c in df.columns if c != _DIGEST]
    return df.withColumn(_DIGEST, draws.row_digest([F.col(c) for c in names], seed))


def assign_ips(
    flows: DataFrame, keys: Sequence[str] | None = None, seed: int = draws.DEFAULT_SEED
) -> DataFrame:
    """Representative addresses from the ranges of the row's category.

    ``keys`` are the columns an address depends on (all by default).
    """
    columns = {
        "source_ip": draws.source_address(F.col("attack_category"), F.col(_DIGEST)),
        "destination_ip": draws.destination_address(F.col(_DIGEST)),
    }
    return _digested(flows, keys, seed).withColumns(columns).drop(_DIGEST)


def assign_ports(
    flows: DataFrame, keys: Sequence[str] | None = None, seed: int = draws.DEFAULT_SEED
) -> DataFrame:
    """Source port 1024-65534 always; destination port 1-1023 where the column is absent."""
    return _digested(flows, keys, seed).withColumns(_port_columns(flows)).drop(_DIGEST)


def _port_columns(flows: DataFrame) -> dict[str, Column]:
    columns = {"source_port": draws.draw(F.col(_DIGEST), draws.SOURCE_PORT, 1024, 65535)}
    if "destination_port" not in flows.columns:
        columns["destination_port"] = draws.draw(F.col(_DIGEST), draws.DESTINATION_PORT, 1, 1024)
    return columns


def add_hour(
    flows: DataFrame, keys: Sequence[str] | None = None, seed: int = draws.DEFAULT_SEED
) -> DataFrame:
    """Hour of ``ts`` (null if unparsable), or a repeatable 0-23 if there is no ``ts``."""
    if "ts" not in flows.columns:
        return _digested(flows, keys, seed).withColumn("hour", _hour_draw()).drop(_DIGEST)
    if dict(flows.dtypes)["ts"] == "string":
        flows = flows.withColumn("ts", parse_timestamp(F.col("ts")))
    return flows.withColumn("hour", F.hour("ts"))


def _hour_draw() -> Column:
    return draws.draw(F.col(_DIGEST), draws.HOUR, 0, 24)


def add_date(flows: DataFrame) -> DataFrame:
    """Capture date from the file name."""
    return flows.withColumn("date", date_of_file(F.col(FILE)))


def add_protocol(flows: DataFrame) -> DataFrame:
    """Protocol inferred from the destination port where the column is absent."""
    if "protocol" in flows.columns:
        return flows
    return flows.withColumn("protocol", infer_protocol(F.col("destination_port")))


def repaired(raw: DataFrame) -> DataFrame:
    """Labels, categories and rates put right, reserved names set aside; every row is still there."""
    return coerce_rates(clean_labels(set_aside(raw)))


def clean_flows(
    raw: DataFrame,
    keys: Sequence[str] | None = None,
    seed: int = draws.DEFAULT_SEED,
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """The whole cleaning, with one shuffle (for the repeats) and one digest per row.

    Optional columns are probed at plan time, so captures with different headers are
    cleaned before they are united.  Addresses that a capture already carries are kept;
    ``keys`` narrows what the representative values depend on.
    """
    cleaned = drop_bad_rates(coerce_rates(alike(clean_labels(set_aside(raw)), types)))
    return finished(drop_repeats(cleaned), keys, seed, types)


def finished(
    unrepeated: DataFrame,
    keys: Sequence[str] | None = None,
    seed: int = draws.DEFAULT_SEED,
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """Types, representative values, hour, date and protocol; row by row, so equal rows have equal values."""
    have = unrepeated.columns
    flows = _digested(type_columns(unrepeated, types), keys, seed)
    added: dict[str, Column] = {}
    if "source_ip" not in have:
        added["source_ip"] = draws.source_address(F.col("attack_category"), F.col(_DIGEST))
    if "destination_ip" not in have:
        added["destination_ip"] = draws.destination_address(F.col(_DIGEST))
    if "ts" not in have:
        added["hour"] = _hour_draw()
    added.update(_port_columns(unrepeated))
    flows = flows.withColumns(added).drop(_DIGEST)
    if "ts" in have:
        flows = add_hour(flows)
    return add_protocol(add_date(flows))


def content_key(columns: Sequence[Column]) -> Column:
    """SHA-256 of the columns, each with its length, so that equal keys mean equal rows; null is null's own value."""
    texts = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


# Texts that stand for a missing value in a column of numbers.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
_ORDER = ("double", "bigint", "double", "string")  # nothing but missing values, whole numbers, numbers, text


def column_order(column: Column) -> Column:
    """Place of a text in the order of types: 0 missing, 1 a whole number, 2 a number, 3 other text."""
    text = F.trim(column)
    whole = text.rlike(r"^[-+]?[0-9]+$") & text.try_cast("bigint").isNotNull()
    missing = column.isNull() | text.isin(*MISSING)
    return F.when(missing, 0).when(whole, 1).when(text.try_cast("double").isNotNull(), 2).otherwise(3)


def unlisted(raw: DataFrame, types: Mapping[str, str] | None = None) -> list[str]:
    """Text columns that neither the flow table nor ``types`` has a type for."""
    known = {*NAME_TO_TYPE, *(types or {}), FILE}
    return [n for n, dtype in raw.dtypes if dtype == "string" and n not in known]


def inferred_types(captures: Sequence[DataFrame], types: Mapping[str, str] | None = None) -> dict[str, str]:
    """Types of the unlisted columns, each over all captures that have it: ``bigint``, ``double`` or ``string``.

    One aggregated pass over these columns alone. A column is as wide as its widest value; one with missing values
    only is a double.
    """
    found: dict[str, int] = {}
    orders = []
    for raw in captures:
        names = unlisted(raw, types)
        if names:
            widest = [F.struct(F.lit(n).alias("name"), F.coalesce(F.max(column_order(F.col(n))), F.lit(0)).alias("place")) for n in names]
            orders.append(raw.agg(F.array(*widest).alias("all")).select(F.inline("all")))
    for row in reduce(DataFrame.union, orders).collect() if orders else []:
        found[row.name] = max(found.get(row.name, 0), row.place)
    return {name: _ORDER[place] for name, place in found.items()}


def ingest_audit(raw: DataFrame) -> DataFrame:
    """Rows read, dropped for bad rates, removed as repeats and kept, per file.

    Equal rows are counted together first, so a file of any size, or one row
    repeated any number of times, shuffles as a set of distinct rows with counts.
    """
    coerced = coerce_rates(alike(clean_labels(raw)))
    bad = F.lit(False)
    for c in RATE_COLUMNS:
        bad = bad | F.col(c).isNull()
    copies = coerced.withColumn("_bad", bad).groupBy(*coerced.columns, "_bad").agg(
        F.count("*").alias("_copies")
    )
    return copies.groupBy(FILE).agg(
        F.sum("_copies").alias("raw_rows"),
        F.sum(F.when(F.col("_bad"), F.col("_copies")).otherwise(0)).alias("bad_rate_rows"),
        F.sum(F.when(~F.col("_bad"), F.col("_copies") - 1).otherwise(0)).alias("repeated_rows"),
        F.count_if(~F.col("_bad")).alias("saved_rows"),
    )
