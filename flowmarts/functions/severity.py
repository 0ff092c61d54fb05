"""Severity of a flow, as a native expression and as a user-function surface."""

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Limits above which a flow moves up one level.
BYTES_LIMIT = 20000
SYN_LIMIT = 1


def severity_of(category: Column, bytes_per_s: Column, syn_count: Column) -> Column:
    """Critical / High / Medium / Low.

    A null or NaN rate counts as not exceeding the limit (SQL would order NaN
    above every number, hence the guard).
    """
    heavy = ~F.isnan(bytes_per_s) & (bytes_per_s > BYTES_LIMIT)
    return (
        F.when(category.isin("DDoS", "DoS"), F.when(heavy, "Critical").otherwise("High"))
        .when(category == "Brute Force", F.when(syn_count > SYN_LIMIT, "High").otherwise("Medium"))
        .when(category.isin("Port Scan", "Bot"), "Medium")
        .otherwise("Low")
    )


def vectorised(classify: Callable, return_type: str = "string") -> Callable[..., Column]:
    """Turn ``classify(*series) -> series`` into a column function over Arrow batches.

    For rules that built-in functions cannot express; where they can, an expression
    like ``severity_of`` stays inside generated code and is faster.
    """

    # Nested, so that it travels by value and workers need not import this package.
    def apply(*columns: pd.Series) -> pd.Series:
        return classify(*columns)

    return F.pandas_udf(apply, return_type)


def severity_classifier() -> Callable[..., Column]:
    """``severity_of`` as a vectorised user function, for comparison."""
    bytes_limit, syn_limit = BYTES_LIMIT, SYN_LIMIT

    def classify(category, bytes_per_s, syn_count):
        flooding = category.isin(["DDoS", "DoS"])
        guessing = category == "Brute Force"
        level = np.select(
            [
                flooding & (bytes_per_s > bytes_limit),
                flooding,
                guessing & (syn_count > syn_limit),
                guessing | category.isin(["Port Scan", "Bot"]),
            ],
            ["Critical", "High", "High", "Medium"],
            default="Low",
        )
        return pd.Series(level)

    return vectorised(classify)
