"""Numeric inversion of the Black-Scholes price, over arrays of options.

Shipped to the workers by value, so that executors need not have this package.
"""

from __future__ import annotations

import math
import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Abramowitz and Stegun 26.2.17, absolute error below 7.5e-8.
CDF_P = 0.2316419
CDF_B = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)

# A volatility is given only if the CDF's error moves it by no more than this.
CDF_ERROR = 7.5e-8
SIGMA_ERROR = 1e-3

MAX_STEPS = 100
PRICE_TOLERANCE = 1e-10


def _cdf(x: np.ndarray) -> np.ndarray:
    t = 1.0 / (1.0 + CDF_P * np.abs(x))
    tail = np.exp(-x * x / 2) / math.sqrt(2 * math.pi) * t * np.polyval(CDF_B[::-1], t)
    return np.where(x >= 0, 1.0 - tail, tail)


def _call_and_vega(s, k_df, root_t, sigma):
    """Call price and vega from spot, discounted strike and volatility."""
    with np.errstate(over="ignore", under="ignore"):
        spread = sigma * root_t
        d1 = np.log(s / k_df) / spread + spread / 2
        call = s * _cdf(d1) - k_df * _cdf(d1 - spread)
        vega = s * root_t * np.exp(-d1 * d1 / 2) / math.sqrt(2 * math.pi)
    return call, vega


def solve_volatility(price, spot, strike, years, is_put, rate: float) -> np.ndarray:
    """Implied volatilities of a batch; NaN outside the no-arbitrage bounds or at T <= 0,
    where the price hardly depends on the volatility (deep in or out of the money, an error
    of the CDF would move it by more than ``SIGMA_ERROR``), and where no step converges.

    Newton from the point of steepest slope, falling back to halving a bracket
    whenever a step leaves it; solved rows drop out of the working set.
    """
    price, spot, strike, years = (
        np.asarray(a, dtype=float) for a in (price, spot, strike, years)
    )
    out = np.full(price.shape, np.nan)
    with np.errstate(invalid="ignore"):
        k_df = strike * np.exp(-rate * years)
        call = np.where(is_put, price + spot - k_df, price)
        ok = (
            (years > 0) & (spot > 0) & (strike > 0) & (price > 0)
            & (call > np.maximum(spot - k_df, 0.0)) & (call < spot)
        )
    rows = np.flatnonzero(ok)
    if rows.size == 0:
        return out
    s, k, root_t, target = spot[rows], k_df[rows], np.sqrt(years[rows]), call[rows]

    low = np.full(rows.shape, 1e-6)
    high = np.full(rows.shape, 4.0)
    for _ in range(20):
        short = _call_and_vega(s, k, root_t, high)[0] < target
        if not short.any():
            break
        high = np.where(short, high * 2, high)
    sigma = np.clip(np.sqrt(2 * np.abs(np.log(s / k))) / root_t, 0.05, high / 2)

    for _ in range(MAX_STEPS):
        value, vega = _call_and_vega(s, k, root_t, sigma)
        gap = value - target
        high = np.where(gap > 0, sigma, high)
        low = np.where(gap > 0, low, sigma)
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            step = sigma - gap / vega
        inside = np.isfinite(step) & (step > low) & (step < high)
        following = np.where(inside, step, (low + high) / 2)
        done = (np.abs(gap) < PRICE_TOLERANCE) | (high - low < 1e-14)
        with np.errstate(divide="ignore", invalid="ignore"):
            told = done & (CDF_ERROR * (s + k) / vega <= SIGMA_ERROR)
        out[rows[told]] = sigma[told]
        keep = ~done
        if not keep.any():
            return out
        rows, s, k, root_t, target, low, high, sigma = (
            a[keep] for a in (rows, s, k, root_t, target, low, high, following)
        )
    return out
