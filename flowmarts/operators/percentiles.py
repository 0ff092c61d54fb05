"""Exact percentiles per attack category without gathering a category's values.

``percentile`` keeps a map of all values of a group in one task.  Here each percentile is
selected by radix instead.  A value becomes a 64-bit whole number of the same order, and three
passes narrow it down by 22, 21 and 21 of its bits:

1. count per (category, metric, first bits) and find the bits at the rank;
2. among rows with these bits, count per next bits and find those;
3. once more for the last bits, which complete the number and thereby the value.

The result is exact for any data, and no running count is over more than 2^22 rows, whatever
the values are.  Counts are combined before every shuffle, and a pass scans the table once for
all metrics.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowmarts.functions.lookups import first_match
from flowmarts.functions.numbers import double_of_order, order_of_double

GROUP = "attack_category"
_KEY = (GROUP, "metric")

_SLICES = ((42, 22), (21, 21), (0, 21))  # shift and width of the bits of each pass
_WHOLE = ("tinyint", "smallint", "int", "bigint")
_REAL = ("float", "double")


def _slice(turn: int) -> Column:
    shift, width = _SLICES[turn]
    bits = F.shiftright("key", shift)
    # The first bits keep the sign, the others are counted from 0.
    return bits if turn == 0 else bits.bitwiseAND(F.lit((1 << width) - 1))


def _at_rank(counts: DataFrame, bits: str) -> DataFrame:
    """The row of each percentile at whose ``bits`` the running count reaches ``rank``,
    with ``rank`` made relative to that row."""
    running = (
        Window.partitionBy(*_KEY, "p")
        .orderBy(bits)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    below = counts.withColumn("below", F.sum("n").over(running) - F.col("n"))
    rank, start = F.col("rank"), F.col("below")
    hit = below.filter((start < rank) & (rank <= start + F.col("n")))
    return hit.withColumn("rank", rank - start).drop("n", "below")


def _local(found: DataFrame) -> DataFrame:
    """``found`` computed now, so that a pass is run once; it has a row per category, metric and percentile."""
    return found.sparkSession.createDataFrame(found.collect(), found.schema)


def _inside(rows: DataFrame, found: DataFrame, slices: Sequence[str]) -> DataFrame:
    """Rows of ``rows`` with the category, metric and ``slices`` of a row of ``found``, with the columns of both.

    ``found`` has one row per category, metric and percentile; categories come from a
    closed list of ten, so the broadcast is a few dozen rows at any data size.
    """
    shared = [*_KEY, *slices]
    left = rows.withColumnsRenamed({c: f"_{c}" for c in shared})
    same = [F.col(f"_{c}").eqNullSafe(F.col(c)) for c in shared]
    return left.join(F.broadcast(found), same).drop(*[f"_{c}" for c in shared])


def exact_percentiles(
    flows: DataFrame, metrics: Mapping[str, Sequence[float]]
) -> DataFrame:
    """Rows (attack_category, metric, p, one column per metric).

    ``metrics`` maps a numeric column to its percentiles.  The result of a percentile
    is the smallest value whose cumulative share of the category's non-null values
    reaches ``p``; it stands, with its own type, in the column of its metric.  NaN is
    above every number, and -0.0 is 0.0.

    Made for the closed list of categories: a few rows per category pass the driver and are broadcast.
    The passes run when this is called.
    """
    types = dict(flows.dtypes)
    for column in metrics:
        if types[column] not in (*_WHOLE, *_REAL):
            raise TypeError(f"{column} is {types[column]}, not a whole number or a double")

    def key(column: str) -> Column:
        if types[column] in _WHOLE:
            return F.col(column).cast("bigint")
        return order_of_double(F.col(column).cast("double"))

    keyed = flows.select(GROUP, *[key(c).alias(f"_{i}") for i, c in enumerate(metrics)])
    stacked = [F.struct(F.lit(c).alias("metric"), F.col(f"_{i}").alias("key")) for i, c in enumerate(metrics)]
    rows = keyed.select(GROUP, F.inline(F.array(*stacked))).filter(F.col("key").isNotNull())

    def wanted(column: str) -> Column:
        rank_of = [
            F.struct(
                F.lit(p).alias("p"),
                F.ceil(F.lit(Decimal(str(p))) * F.col("total")).cast("bigint").alias("rank"),
            )
            for p in metrics[column]
        ]
        return F.array(*rank_of)

    ranks = first_match(
        [(F.col("metric") == c, wanted(c)) for c in metrics], F.lit(None)
    )
    first = (
        rows.groupBy(*_KEY, _slice(0).alias("s0"))
        .agg(F.count("*").alias("n"))
        .withColumn("total", F.sum("n").over(Window.partitionBy(*_KEY)))
        .select(*_KEY, "s0", "n", F.inline(ranks))
    )
    found = _local(_at_rank(first, "s0"))
    for turn in (1, 2):
        known = [f"s{i}" for i in range(turn)]
        sliced = rows.select(*_KEY, *[_slice(i).alias(f"s{i}") for i in range(turn + 1)])
        # Percentiles of one slice count its rows once; each then takes the counts.
        reached = found.select(*_KEY, *known).distinct()
        counts = _inside(sliced, reached, known).groupBy(*_KEY, *known, f"s{turn}").agg(F.count("*").alias("n"))
        found = _local(_at_rank(_inside(counts, found, known), f"s{turn}"))

    whole = F.shiftleft("s0", 42).bitwiseOR(F.shiftleft("s1", 21)).bitwiseOR(F.col("s2"))

    def value(column: str) -> Column:
        own = double_of_order(whole) if types[column] in _REAL else whole
        return F.when(F.col("metric") == column, own.cast(types[column])).alias(column)

    return found.select(*_KEY, "p", *[value(c) for c in metrics])


# Percentiles of the report.
BYTES_PERCENTILES = (0.5, 0.9, 0.99)
DURATION_PERCENTILES = (0.5, 0.9)


def flow_percentiles_exact(flows: DataFrame) -> DataFrame:
    """p50, p90 and p99 of the byte rate, p50 and p90 of the duration per category."""
    found = exact_percentiles(
        flows, {"flow_bytes_s": BYTES_PERCENTILES, "flow_duration": DURATION_PERCENTILES}
    )

    def column(metric: str, p: float, digits: int, suffix: str) -> Column:
        value = F.max(F.when((F.col("metric") == metric) & (F.col("p") == p), F.col(metric)))
        return F.round(value, digits).alias(f"p{int(p * 100)}_{suffix}")

    return (
        found.groupBy(GROUP)
        .agg(
            *[column("flow_bytes_s", p, 2, "bytes") for p in BYTES_PERCENTILES],
            *[column("flow_duration", p, 0, "duration_us") for p in DURATION_PERCENTILES],
        )
        .orderBy(F.col("p99_bytes").desc(), GROUP)
    )
