"""Black-Scholes values without dividends.

Prices and Greeks are native column expressions; only the inversion to implied
volatility, which iterates, runs as an Arrow UDF. Both sides use the same normal
CDF polynomial, so a price inverted and priced again comes back.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tenorline.functions.values import finite
from tenorline.functions.volatility_solver import CDF_B, CDF_P, solve_volatility

RATE = 0.0025
DAYS_PER_YEAR = 252


def normal_pdf(x: Column) -> Column:
    return F.exp(-x * x / 2) / F.lit(math.sqrt(2 * math.pi))


def normal_cdf(x: Column) -> Column:
    t = 1 / (1 + F.lit(CDF_P) * F.abs(x))
    series = F.lit(CDF_B[-1])
    for b in reversed(CDF_B[:-1]):
        series = F.lit(b) + t * series
    tail = normal_pdf(x) * t * series
    return F.when(x >= 0, 1 - tail).otherwise(tail)


def year_fraction(dte: Column, days: int = DAYS_PER_YEAR) -> Column:
    return dte / F.lit(float(days))


@dataclass(frozen=True)
class Terms:
    """Column names of one priced option; ``side`` holds 'call' or 'put'."""

    spot: str = "spot"
    strike: str = "strike"
    years: str = "years"
    sigma: str = "iv"
    side: str = "option_type"


def _with_moments(df: DataFrame, terms: Terms, rate: float) -> DataFrame:
    """Adds _s, _k, _t, _v, _d1, _d2 and _df; null wherever the model is undefined."""
    s, k = F.col(terms.spot).cast("double"), F.col(terms.strike).cast("double")
    t, v = F.col(terms.years).cast("double"), F.col(terms.sigma).cast("double")
    defined = (s > 0) & (k > 0) & (t > 0) & (v > 0)
    inputs = df.withColumns({
        "_s": F.when(defined, s), "_k": F.when(defined, k),
        "_t": F.when(defined, t), "_v": F.when(defined, v),
    })
    s, k, t, v = (F.col(c) for c in ("_s", "_k", "_t", "_v"))
    with_d1 = inputs.withColumns({
        "_d1": (F.ln(s / k) + (F.lit(rate) + v * v / 2) * t) / (v * F.sqrt(t)),
        "_df": F.exp(F.lit(-rate) * t),
    })
    return with_d1.withColumn("_d2", F.col("_d1") - v * F.sqrt(t))


_MOMENTS = ("_s", "_k", "_t", "_v", "_d1", "_d2", "_df", "_n1", "_n2", "_pdf1")


def _with_distribution(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "_n1": normal_cdf(F.col("_d1")),
        "_n2": normal_cdf(F.col("_d2")),
        "_pdf1": normal_pdf(F.col("_d1")),
    })


def with_price(df: DataFrame, terms: Terms = Terms(), rate: float = RATE,
               name: str = "model_price") -> DataFrame:
    """Model price of each row from its volatility."""
    m = _with_distribution(_with_moments(df, terms, rate))
    s, k_df = F.col("_s"), F.col("_k") * F.col("_df")
    call = s * F.col("_n1") - k_df * F.col("_n2")
    price = F.when(F.col(terms.side) == "put", call - s + k_df).otherwise(call)
    return m.withColumn(name, finite(price)).drop(*_MOMENTS)


def with_greeks(df: DataFrame, terms: Terms = Terms(), rate: float = RATE) -> DataFrame:
    """delta, gamma, vega (per 1.00 of volatility) and theta (per year)."""
    m = _with_distribution(_with_moments(df, terms, rate))
    s, t, v = F.col("_s"), F.col("_t"), F.col("_v")
    put = F.col(terms.side) == "put"
    carry = F.lit(rate) * F.col("_k") * F.col("_df")
    decay = -s * F.col("_pdf1") * v / (2 * F.sqrt(t))
    greeks = {
        "delta": F.when(put, F.col("_n1") - 1).otherwise(F.col("_n1")),
        "gamma": F.col("_pdf1") / (s * v * F.sqrt(t)),
        "vega": s * F.col("_pdf1") * F.sqrt(t),
        "theta": F.when(put, decay + carry * (1 - F.col("_n2")))
        .otherwise(decay - carry * F.col("_n2")),
    }
    return m.withColumns({n: finite(c) for n, c in greeks.items()}).drop(*_MOMENTS)


def implied_vol(price: Column, spot: Column, strike: Column, years: Column,
                option_type: Column, rate: float = RATE, call_only: bool = False) -> Column:
    """Implied volatility as a fraction; null where no volatility gives the price.

    ``call_only`` inverts puts with the call formula.
    """

    @F.pandas_udf("double")
    def solve(p: pd.Series, s: pd.Series, k: pd.Series, t: pd.Series, put: pd.Series) -> pd.Series:
        return pd.Series(solve_volatility(p, s, k, t, put.fillna(False).astype(bool), rate))

    is_put = F.lit(False) if call_only else option_type == "put"
    return finite(solve(
        price.cast("double"), spot.cast("double"), strike.cast("double"),
        years.cast("double"), is_put,
    ))
