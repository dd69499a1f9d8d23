"""Derived columns of priced option quotes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tenorline.functions.black_scholes import RATE, Terms, implied_vol, with_greeks, year_fraction
from tenorline.functions.dates import dte_calendar, dte_elapsed, exp_weekday
from tenorline.functions.trading_days import session_close
from tenorline.operators.spot import attach_spot

DERIVED = ("dte", "exp_date_weekday", "iv", "delta", "gamma", "vega", "theta")


def add_expiry(quotes: DataFrame, elapsed: bool = False) -> DataFrame:
    """dte by calendar date, or by elapsed time to the expiry session's close."""
    dte = (
        dte_elapsed(session_close(F.col("exp_date")), F.col("dt")) if elapsed
        else dte_calendar(F.col("exp_date"), F.col("dt"))
    )
    return quotes.withColumns({"dte": dte, "exp_date_weekday": exp_weekday(F.col("exp_date"))})


def add_implied_vol(quotes: DataFrame, rate: float = RATE, call_only: bool = False) -> DataFrame:
    years = year_fraction(F.col("dte"))
    return quotes.withColumn("iv", implied_vol(
        F.col("close"), F.col("spot"), F.col("strike"), years, F.col("option_type"),
        rate, call_only))


def add_greeks(quotes: DataFrame, rate: float = RATE) -> DataFrame:
    with_years = quotes.withColumn("_years", year_fraction(F.col("dte")))
    return with_greeks(with_years, Terms(years="_years"), rate).drop("_years")


def derive(priced: DataFrame, *, elapsed: bool = False, call_only: bool = False) -> DataFrame:
    """Quotes with ``spot`` -> dte, weekday -> implied volatility -> Greeks, row by row, so streams too.

    Rows without a trade (null close) get no derived values. Undefined results are null,
    never NaN or infinite. Whether a quote counts as fetched is left to the caller.
    """
    dated = add_expiry(priced, elapsed)
    greeks = add_greeks(add_implied_vol(dated, call_only=call_only))
    traded = F.col("close").isNotNull()
    return greeks.withColumns({c: F.when(traded, F.col(c)) for c in ("dte", "exp_date_weekday")})


def enrich(quotes: DataFrame, stock_quotes: DataFrame, *, elapsed: bool = False,
           call_only: bool = False, unique_spot: bool = False) -> DataFrame:
    """quote -> spot -> ``derive``."""
    priced = attach_spot(quotes.drop(*DERIVED), stock_quotes, unique=unique_spot)
    return derive(priced, elapsed=elapsed, call_only=call_only)
