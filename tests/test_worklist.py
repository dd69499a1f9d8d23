from datetime import date, datetime

import pytest

from tenorline.operators.contracts import contract_sessions, option_worklist
from tenorline.operators.worklist import missing_prices, missing_quotes, rows_to_seed


def dt(n):
    return datetime(2022, 1, n, 21)


@pytest.fixture(scope="module")
def expected(spark):
    return spark.createDataFrame([("SPY", dt(n)) for n in (3, 4, 5, 6)],
                                 "ticker string, dt timestamp")


@pytest.fixture(scope="module")
def stored(spark):
    return spark.createDataFrame(
        [(1, "SPY", dt(3), True), (2, "SPY", dt(4), False), (3, "SPY", dt(5), None),
         (4, "SPY", dt(10), True)],
        "id long, ticker string, dt timestamp, fetched boolean")


def test_missing_and_fetched_make_up_the_calendar(expected, stored):
    missing = missing_prices(expected, stored)
    assert sorted(r["dt"].day for r in missing.collect()) == [4, 5, 6]
    fetched = stored.filter("fetched").select("ticker", "dt")
    assert missing.select("ticker", "dt").intersect(fetched).isEmpty()
    assert missing.select("ticker", "dt").union(
        fetched.join(expected, ["ticker", "dt"], "left_semi")).count() == expected.count()


def test_missing_quotes_with_and_without_refetch(expected, stored):
    rows = {r["dt"].day: r["id"] for r in missing_quotes(expected, stored).collect()}
    assert rows == {4: 2, 5: 3, 6: None}
    again = {r["dt"].day: r["id"] for r in missing_quotes(expected, stored, refetch=True).collect()}
    assert again == {3: None, 4: 2, 5: 3, 6: None}


def test_seeds_are_absent_rows(expected, stored):
    rows = rows_to_seed(expected, stored).collect()
    assert [(r["dt"].day, r["fetched"]) for r in rows] == [(6, False)]


CONTRACTS = "ticker string, underlying_ticker string, option_type string, strike double, " \
            "exp_date date, listed date"


def test_sessions_stop_before_the_last(spark):
    contracts = spark.createDataFrame(
        [("A", "SPY", "call", 440.0, date(2022, 4, 15), date(2022, 4, 11)),
         ("B", "SPY", "call", 440.0, date(2022, 4, 14), date(2022, 4, 14))], CONTRACTS)
    rows = contract_sessions(contracts).orderBy("session").collect()
    # Good Friday is closed, so Thursday is the last session of A and left out.
    assert [(r["ticker"], r["session"].day) for r in rows] == [("A", 11), ("A", 12), ("A", 13)]


def test_option_worklist_equals_brute_force(spark):
    contracts = [
        (f"C{i}-{s}", "SPY", "call", float(s), date(2022, 1, 5 + i % 20), date(2022, 1, 1 + i % 9))
        for i in range(20) for s in (300, 337, 338, 437, 536, 537, 437.5)
    ] + [("far", "SPY", "put", 440.0, date(2022, 6, 1), date(2022, 1, 1))]
    days = [("SPY", dt(3), 437.98), ("SPY", dt(10), 400.2), ("SPY", datetime(2022, 3, 30, 20), 437.0)]
    want = set()
    for ticker, u, side, strike, exp, listed in contracts:
        for t, when, close in days:
            d = when.date()
            if (listed <= d <= exp and (exp - d).days <= 70 and strike == int(strike)
                    and int(close) - 100 <= strike <= int(close) + 99):
                want.add((ticker, when))
    got = option_worklist(
        spark.createDataFrame(days, "ticker string, dt timestamp, close double"),
        spark.createDataFrame(contracts, CONTRACTS))
    rows = [(r["ticker"], r["dt"]) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want and want
