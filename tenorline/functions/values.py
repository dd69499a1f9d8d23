"""Cleaning, unit and storage rules for numeric values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def finite(c: Column) -> Column:
    """NaN and infinities to null: Spark treats NaN as equal to itself, the source data does not."""
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def iv_as_fraction(iv: Column, is_percent: Column) -> Column:
    """Implied volatility as a fraction; the unit comes from an explicit flag."""
    return F.when(is_percent, iv / F.lit(100.0)).otherwise(iv)


def iv_as_percent(iv: Column) -> Column:
    return iv * F.lit(100.0)


def stored_price(c: Column) -> Column:
    return c.try_cast("decimal(8,2)")


def stored_iv(c: Column) -> Column:
    return c.try_cast("decimal(12,4)")


def unfetched(fetched: Column) -> Column:
    """Null and false both mean "still to fetch"."""
    return ~F.coalesce(fetched, F.lit(False))


def needs_price(close: Column) -> Column:
    return close.isNull() | (close == 0)
