"""Lookups in fixed tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(branches: Iterable[tuple[Column, object]], default: object) -> Column:
    """Value of the first true condition, as one flat CASE."""
    chain = F
    for condition, value in branches:
        chain = chain.when(condition, value)
    return chain.otherwise(default)


def mapped(key: Column, table: Mapping[str, str], default: str) -> Column:
    """``table[key]`` with a default.

    A map literal mentions ``key`` once; a CASE would repeat its expression in every
    branch, and again in each filter that is pushed below.
    """
    literals = [F.lit(text) for pair in table.items() for text in pair]
    return F.coalesce(F.element_at(F.create_map(*literals), key), F.lit(default))
