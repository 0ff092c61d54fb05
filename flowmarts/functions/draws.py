"""Repeatable pseudo-random values derived from row content.

A value depends on the key columns and the seed alone, so a retried task, another
partitioning or a later run gives the same result; ``rand(seed)`` does not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowmarts.functions.lookups import first_match
from flowmarts.schema import BENIGN, DESTINATION_RANGE, SOURCE_RANGES

DEFAULT_SEED = 42
_HEX_DIGITS = 5  # 20 bits per draw; a digest of 32 hex digits holds six

# Which part of the digest feeds which value.
SOURCE_THIRD, SOURCE_LAST, DESTINATION_LAST, SOURCE_PORT, HOUR, DESTINATION_PORT = range(6)


def row_digest(keys: Sequence[Column], seed: int = DEFAULT_SEED) -> Column:
    """Hex digest of the seed and the key columns (null counts as empty text)."""
    parts = [F.coalesce(k.cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def draw(digest: Column, slot: int, low: int, high: int) -> Column:
    """Integer in ``[low, high)`` from one slot of the digest."""
    bits = F.conv(F.substring(digest, 1 + slot * _HEX_DIGITS, _HEX_DIGITS), 16, 10)
    return (low + bits.cast("bigint") % (high - low)).cast("int")


def source_address(category: Column, digest: Column) -> Column:
    """Address inside the category's range; unlisted categories use the benign one."""

    def address(prefix, third, last):
        tail = draw(digest, SOURCE_LAST, *last).cast("string")
        if third is None:
            return F.concat(F.lit(prefix), tail)
        middle = draw(digest, SOURCE_THIRD, *third).cast("string")
        return F.concat(F.lit(prefix), middle, F.lit("."), tail)

    hostile = (
        (category == name, address(*bounds))
        for name, bounds in SOURCE_RANGES.items()
        if name != BENIGN
    )
    return first_match(hostile, address(*SOURCE_RANGES[BENIGN]))


def destination_address(digest: Column) -> Column:
    prefix, bounds = DESTINATION_RANGE
    return F.concat(F.lit(prefix), draw(digest, DESTINATION_LAST, *bounds).cast("string"))
