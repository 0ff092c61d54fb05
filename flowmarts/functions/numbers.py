"""Lenient numbers, guarded ratios and display formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite_double(value: Column) -> Column:
    """Double from text or number; junk, NaN and both infinities become null."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number)


def lenient_long(value: Column) -> Column:
    """Whole number from text such as ``80`` or ``80.0``; junk and fractions become null."""
    number = value.try_cast("double")
    whole = F.when(number == F.floor(number), number).try_cast("bigint")
    return F.when(value.rlike(r"^\s*[-+]?[0-9]+\s*$"), value.try_cast("bigint")).otherwise(whole)


def same_value(value: Column) -> Column:
    """One text for all spellings of a number (``1``, ``1.0``, ``1e0``), other texts as they are."""
    number = value.try_cast("double")
    whole = (number == F.floor(number)) & (F.abs(number) <= float(1 << 53))
    integer = F.when(value.rlike(r"^\s*[-+]?[0-9]+\s*$"), value.try_cast("bigint").cast("string"))
    return F.coalesce(integer, F.when(whole, number.cast("bigint").cast("string")), number.cast("string"), value)


def percent(part: Column, whole: Column, digits: int) -> Column:
    """``part`` in percent of ``whole``, rounded half away from zero; null when
    ``whole`` is 0."""
    return F.round(F.try_divide(part, whole) * 100, digits)


def thousands(value: Column) -> Column:
    """``1234567`` as ``1,234,567``."""
    return F.format_number(value, 0)


def title_words(key: Column) -> Column:
    """``failed_logins`` as ``Failed Logins``."""
    return F.initcap(F.replace(key, F.lit("_"), F.lit(" ")))


_ALL_BUT_SIGN = (1 << 63) - 1


def _of_java_double(method: str, value: Column) -> Column:
    return F.java_method(F.lit("java.lang.Double"), F.lit(method), value)


def order_of_double(value: Column) -> Column:
    """A bigint of the order of the doubles, different for different ones; NaN is the greatest, -0.0 is 0.0.

    The bits of the IEEE form are in order for numbers from 0 on; below 0 all but the sign are turned over.
    """
    bits = _of_java_double("doubleToLongBits", F.coalesce(value, F.lit(0.0)) + 0.0).cast("bigint")
    return F.when(value.isNotNull(), F.when(value < 0, bits.bitwiseXOR(F.lit(_ALL_BUT_SIGN))).otherwise(bits))


def double_of_order(order: Column) -> Column:
    """The double that ``order_of_double`` has made into this number."""
    bits = F.when(order < 0, order.bitwiseXOR(F.lit(_ALL_BUT_SIGN))).otherwise(order)
    return F.when(order.isNotNull(), _of_java_double("longBitsToDouble", F.coalesce(bits, F.lit(0))).cast("double"))
