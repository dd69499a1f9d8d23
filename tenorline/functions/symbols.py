"""Fields packed into a sample symbol such as ``SPY_042522P420.5``.

All patterns are anchored on the expiry digits after the underscore, so roots
that contain C or P are read correctly.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def underlying(symbol: Column) -> Column:
    return F.split_part(symbol, F.lit("_"), F.lit(1))


def strike(symbol: Column) -> Column:
    text = F.regexp_extract(symbol, r"_\d+[CP](.*)", 1)
    return text.try_cast("double")


def call_put(symbol: Column) -> Column:
    flag = F.regexp_extract(symbol, r"_\d+([CP])", 1)
    return F.when(flag != "", F.lower(flag))
