import math
import random
from datetime import date, datetime
from statistics import NormalDist

import numpy as np
from pyspark.sql import functions as F

from tenorline.functions.black_scholes import Terms, implied_vol, with_greeks, with_price
from tenorline.functions.volatility_solver import solve_volatility
from tenorline.operators.enrich import enrich
from tenorline.operators.spot import attach_spot

N = NormalDist()


def exact(s, k, t, v, put, r=0.0025):
    d1 = (math.log(s / k) + (r + v * v / 2) * t) / (v * math.sqrt(t))
    d2 = d1 - v * math.sqrt(t)
    df = math.exp(-r * t)
    call = s * N.cdf(d1) - k * df * N.cdf(d2)
    side = -1 if put else 1
    return {
        "price": call - (s - k * df if put else 0),
        "delta": N.cdf(d1) - (1 if put else 0),
        "gamma": N.pdf(d1) / (s * v * math.sqrt(t)),
        "vega": s * N.pdf(d1) * math.sqrt(t),
        "theta": -s * N.pdf(d1) * v / (2 * math.sqrt(t)) - side * r * k * df * N.cdf(side * d2),
    }


def book(n=300):
    rng = random.Random(3)
    return [(i, rng.uniform(380, 480), rng.choice([400.0, 430.0, 460.0]), rng.randint(1, 200) / 252,
             rng.uniform(0.05, 1.2), rng.choice(["call", "put"])) for i in range(n)]


SCHEMA = "id int, spot double, strike double, years double, iv double, option_type string"


def test_prices_and_greeks_are_textbook(spark):
    df = with_greeks(with_price(spark.createDataFrame(book(), SCHEMA)), Terms())
    for r in df.collect():
        want = exact(r["spot"], r["strike"], r["years"], r["iv"], r["option_type"] == "put")
        assert abs(r["model_price"] - want["price"]) < 1e-4
        for name, limit in (("delta", 1e-6), ("gamma", 1e-9), ("vega", 1e-6), ("theta", 1e-5)):
            assert abs(r[name] - want[name]) < limit, (name, r)


def test_put_call_parity(spark):
    calls = with_price(spark.createDataFrame([b[:5] + ("call",) for b in book()], SCHEMA))
    puts = with_price(spark.createDataFrame([b[:5] + ("put",) for b in book()], SCHEMA))
    both = calls.join(puts.select("id", F.col("model_price").alias("put")), "id")
    forward = F.col("spot") - F.col("strike") * F.exp(-0.0025 * F.col("years"))
    assert both.filter(F.abs(F.col("model_price") - F.col("put") - forward) > 1e-9).isEmpty()


def test_volatility_round_trip(spark):
    priced = with_price(spark.createDataFrame(book(), SCHEMA))
    solved = priced.withColumn("solved", implied_vol(
        F.col("model_price"), F.col("spot"), F.col("strike"), F.col("years"),
        F.col("option_type")))
    checked = 0
    for r in solved.collect():
        vega = exact(r["spot"], r["strike"], r["years"], r["iv"], False)["vega"]
        if vega > 0.5:
            assert abs(r["solved"] - r["iv"]) < 1e-6
            checked += 1
    assert checked > 200


def test_unsolvable_prices_are_null(spark):
    rows = [
        (1, 100.0, 90.0, 0.1, "call", 9.0),    # below intrinsic
        (2, 100.0, 90.0, 0.0, "call", 12.0),   # expired
        (3, 100.0, 90.0, 0.1, "call", 100.0),  # not below the spot
        (4, 100.0, 110.0, 0.1, "put", 5.0),    # below intrinsic
        (5, 100.0, 110.0, 0.1, "put", 110.0),  # not below the discounted strike
        (6, 100.0, 90.0, 0.1, "call", None),
        (7, None, 90.0, 0.1, "call", 12.0),
        (8, 100.0, 90.0, 0.1, "call", 12.0),
    ]
    df = spark.createDataFrame(
        rows, "id int, spot double, strike double, years double, option_type string, p double")
    solved = df.select("id", implied_vol(F.col("p"), F.col("spot"), F.col("strike"),
                                         F.col("years"), F.col("option_type")).alias("iv"))
    assert {r["id"] for r in solved.collect() if r["iv"] is not None} == {8}


def test_call_only_uses_the_call_formula(spark):
    df = spark.createDataFrame([(101.0, 100.0, 0.25, "put", 5.0)],
                               "s double, k double, t double, side string, p double")
    args = [F.col(c) for c in ("p", "s", "k", "t", "side")]
    as_call = df.select(implied_vol(*args, call_only=True).alias("iv")).first()["iv"]
    want = solve_volatility([5.0], [101.0], [100.0], [0.25], np.array([False]), 0.0025)[0]
    assert abs(as_call - want) < 1e-12


def test_undefined_greeks_are_null(spark):
    df = spark.createDataFrame([(1, 100.0, 90.0, 0.0, 0.2, "call"), (2, 100.0, 90.0, 0.1, 0.0, "put")],
                               SCHEMA)
    for r in with_greeks(df).collect():
        assert all(r[c] is None for c in ("delta", "gamma", "vega", "theta"))


def test_enrichment(spark):
    dt = datetime(2022, 1, 21, 21)
    quotes = spark.createDataFrame(
        [(1, dt, "A", "SPY", "call", 460.0, date(2022, 1, 28), 0.40, None),
         (2, dt, "B", "SPY", "call", 460.0, date(2022, 1, 31), None, None),
         (3, dt, "C", "QQQ", "put", 300.0, date(2022, 1, 28), 5.0, None)],
        "id int, dt timestamp, ticker string, underlying_ticker string, option_type string, "
        "strike double, exp_date date, close double, fetched boolean")
    stock = spark.createDataFrame([(dt, "SPY", 437.98)], "dt timestamp, ticker string, close double")
    a, b, c = enrich(quotes, stock).orderBy("id").collect()
    assert (a["dte"], a["exp_date_weekday"], round(a["iv"], 4)) == (7, 4, 0.1928)
    assert a["delta"] is not None and a["vega"] > 0 and a["theta"] < 0
    assert b["dte"] is None and b["iv"] is None
    assert c["spot"] is None and c["iv"] is None and c["dte"] == 7
    try:
        attach_spot(quotes, stock, strict=True).collect()
        raise AssertionError("a missing spot must fail")
    except Exception as e:
        assert "no spot for QQQ" in str(e)


def test_elapsed_days_across_the_clock_change(spark):
    dt = datetime(2022, 3, 11, 21)
    quotes = spark.createDataFrame(
        [(1, dt, "A", "SPY", "call", 420.0, date(2022, 3, 14), 5.0, None)],
        "id int, dt timestamp, ticker string, underlying_ticker string, option_type string, "
        "strike double, exp_date date, close double, fetched boolean")
    stock = spark.createDataFrame([(dt, "SPY", 420.0)], "dt timestamp, ticker string, close double")
    assert enrich(quotes, stock).first()["dte"] == 3
    assert enrich(quotes, stock, elapsed=True).first()["dte"] == 2


def test_volatilities_come_back_or_are_null():
    """Known volatilities over a grid of terms: never a wrong one, and null only where the
    price hardly moves with it."""
    import itertools
    import numpy as np
    from tenorline.functions.volatility_solver import _call_and_vega, solve_volatility
    grid = np.array(list(itertools.product((300, 360, 400, 440, 500), (1, 3, 21, 252), (0.1, 0.2, 0.5, 1.0))), float)
    k, t, sigma = grid[:, 0], grid[:, 1] / 252, grid[:, 2]
    s, k_df = np.full(len(grid), 402.0), k * np.exp(-0.0025 * t)
    call, vega = _call_and_vega(s, k_df, np.sqrt(t), sigma)
    for is_put, price in ((False, call), (True, call - s + k_df)):
        got = solve_volatility(price, s, k, t, np.full(len(grid), is_put), 0.0025)
        known = np.isfinite(got)
        assert np.abs(got[known] - sigma[known]).max() < 1e-3
        assert (vega[~known] < 0.1).all() and known.mean() > 0.6
