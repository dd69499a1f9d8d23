"""Row predicates of the analyses, composable with ``DataFrame.transform``."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from tenorline.sources.tables import DAY


def universe(df: DataFrame, underlyings: Sequence[str] | None = None,
             last_trading_day_min: date | None = None,
             last_trading_day_max: date | None = None,
             underlying: str = "underlying", last_trading_day: str = "lastTradingDay") -> DataFrame:
    """Optional underlying list and inclusive bounds on the last trading day."""
    if underlyings is not None:
        df = df.filter(F.col(underlying).isin(list(underlyings)))
    if last_trading_day_min is not None:
        df = df.filter(F.col(last_trading_day) >= F.lit(last_trading_day_min))
    if last_trading_day_max is not None:
        df = df.filter(F.col(last_trading_day) <= F.lit(last_trading_day_max))
    return df


def between_days(quotes: DataFrame, first: date, last: date) -> DataFrame:
    """Quotes from ``first`` to ``last``, both whole days included.

    A stored table is pruned by its partition column; otherwise the bounds are a
    half-open range on the bare column, which Parquet can push down.
    """
    if DAY in quotes.columns:
        return quotes.filter(F.col(DAY).between(F.lit(first), F.lit(last)))
    start, end = (F.lit(d).cast("timestamp") for d in (first, last))
    return quotes.filter((F.col("dt") >= start) & (F.col("dt") < end + F.expr("interval 1 day")))


def on_day(quotes: DataFrame, underlying_ticker: str, day: date) -> DataFrame:
    """Quotes of one underlying on one UTC date."""
    return between_days(quotes, day, day).filter(F.col("underlying_ticker") == underlying_ticker)


def monday_or_friday(exp_date: Column) -> Column:
    return F.weekday(exp_date).isin(0, 4)


def delta_band(delta: Column, low: float = -0.8, high: float = -0.1) -> Column:
    """Both ends excluded."""
    return (delta > low) & (delta < high)
