"""The column functions for use in SQL text.

``register`` makes them temporary functions of a session. All but the volatility are SQL
expressions that Spark puts in place of the call, so they cost what the expression costs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession, functions as F

from tenorline.functions.black_scholes import RATE
from tenorline.functions.dates import WEEKDAY_CODES
from tenorline.functions.volatility_solver import solve_volatility

_CODES = ", ".join(f"'{c}'" for c in WEEKDAY_CODES)

#: name -> (parameters, type, expression)
FUNCTIONS = {
    "week_of_month": (
        "d date", "string",
        "cast(cast(ceil((dayofmonth(d) + dayofweek(trunc(d, 'MM')) - 1) / 7) as int) as string)"),
    "expiry_code": (
        "d date", "string", f"concat(try_element_at(array({_CODES}), weekday(d) + 1), week_of_month(d))"),
    "year_week": (
        "d date", "string",
        "concat(year(d), '-', lpad(cast(floor((dayofyear(d) + 6 - weekday(d)) / 7) as string), 2, '0'))"),
    "from_epoch_ms": ("ms bigint", "timestamp", "timestamp_millis(ms)"),
    "symbol_underlying": ("symbol string", "string", "split_part(symbol, '_', 1)"),
    "symbol_strike": (
        "symbol string", "double", r"try_cast(regexp_extract(symbol, r'_\d+[CP](.*)', 1) as double)"),
    "symbol_call_put": (
        "symbol string", "string", r"nullif(lower(regexp_extract(symbol, r'_\d+([CP])', 1)), '')"),
}


def _implied_vol(price: pd.Series, spot: pd.Series, strike: pd.Series, years: pd.Series, option_type: pd.Series) -> pd.Series:
    solved = pd.Series(solve_volatility(price, spot, strike, years, option_type == "put", RATE))
    return solved.where(np.isfinite(solved))


def register(spark: SparkSession) -> None:
    """Creates or replaces the functions in the session; ``year_week(o_orderdate)`` then works in
    ``spark.sql`` and ``expr``, as does ``implied_vol(price, spot, strike, years, option_type)``, whose
    numbers are doubles. A function may use those before it."""
    spark.udf.register("implied_vol", F.pandas_udf(_implied_vol, "double"))
    for name, (parameters, kind, body) in FUNCTIONS.items():
        spark.sql(f"create or replace temporary function {name}({parameters}) returns {kind} return {body}")
