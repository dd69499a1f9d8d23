import json
from datetime import date, datetime

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tenorline.functions import dates, strikes, symbols
from tenorline.schema import RAW_SAMPLES, normalize_layout
from tenorline.sources.raw_samples import scan_raw, typed_samples
from tenorline.sources.vendor_json import (
    parse_aggregate_bars, parse_contracts, parse_daily_bars,
)


def test_raw_scan_reads_day_folders_and_epochs(spark, tmp_path):
    for folder, epoch, symbol in (("2022/4/25", 1650878173, "SPY_042922C420"),
                                  ("2022/4/26", 1650964573, "SPCE_042922P10.5")):
        target = tmp_path / folder
        target.mkdir(parents=True)
        row = {"symbol": [symbol], "ask": [2.0], "bid": [1.0], "delta": [0.5], "theta": [-0.1],
               "volatility": [20.0], "daysToExpiration": pa.array([4], pa.int32())}
        for i, c in enumerate(("expirationDate", "lastTradingDay", "quoteTimeInLong",
                               "tradeTimeInLong", "sampleTimeInLong")):
            row[c] = [epoch * 1000 + i]
        pq.write_table(pa.table(row), target / f"{epoch}.parquet.gzip", compression="gzip")
        (target / "notes.txt").write_text("not a sample file")
    raw = scan_raw(spark, str(tmp_path), RAW_SAMPLES)
    assert sorted(r["sample_epoch"] for r in raw.collect()) == [1650878173, 1650964573]
    one_day = scan_raw(spark, str(tmp_path / "2022/4/25"), RAW_SAMPLES)
    assert one_day.count() == 1
    row = typed_samples(one_day).first()
    assert (row["underlying"], row["strike"], row["call_put"]) == ("SPY", 420.0, "c")
    assert row["sampleTimeInLong"] == datetime(2022, 4, 25, 9, 16, 13, 4000)
    assert row["lastTradingDayDes"] == "A5" and row["lastTradingDayWeekNumber"] == "2022-17"


def test_symbols(spark):
    df = spark.createDataFrame([("SPY_042522P420.5",), ("SPCE_042522P10",), ("plain",)], "s string")
    rows = df.select(symbols.underlying(F.col("s")), symbols.strike(F.col("s")),
                     symbols.call_put(F.col("s"))).collect()
    assert [tuple(r) for r in rows] == [
        ("SPY", 420.5, "p"), ("SPCE", 10.0, "p"), ("plain", None, None)]


def test_daily_bars(spark):
    bar = {"status": "OK", "from": "2022-01-21", "symbol": "SPY", "open": 1.0, "high": 2.0,
           "low": 0.5, "close": 1.5, "volume": 10, "afterHours": 1.6, "preMarket": 0.9}
    dt = datetime(2022, 1, 21, 21)
    landed = spark.createDataFrame(
        [("SPY", dt, json.dumps(bar)), ("QQQ", dt, json.dumps({"status": "NOT_FOUND"}))],
        "ticker string, dt timestamp, body string")
    got = {r["ticker"]: r for r in parse_daily_bars(landed).collect()}
    spy, qqq = got["SPY"], got["QQQ"]
    assert (spy["dt"], spy["close"], spy["volume"], spy["pre_market"], spy["after_market"]) == (
        dt, 1.5, 10, 0.9, 1.6)
    assert qqq["status"] == "NOT_FOUND" and qqq["close"] is None and qqq["volume"] is None


def test_contract_lists(spark):
    def contract(ticker, strike):
        return {"ticker": ticker, "underlying_ticker": "SPY", "contract_type": "call",
                "strike_price": strike, "expiration_date": "2022-01-28", "cfi": "OCASPS",
                "exercise_style": "american", "primary_exchange": "BATO",
                "shares_per_contract": 100}
    bodies = [{"results": [contract("A", 400), contract("B", 400.5)]}, {"results": []}]
    landed = spark.createDataFrame([(json.dumps(b),) for b in bodies], "body string")
    rows = parse_contracts(landed).orderBy("ticker").collect()
    assert [(r["ticker"], r["strike"], r["exp_date"]) for r in rows] == [
        ("A", 400.0, date(2022, 1, 28)), ("B", 400.5, date(2022, 1, 28))]
    assert "cfi" not in rows[0].asDict()


def test_aggregate_bars(spark):
    body = {"results": [{"v": 10, "vw": 1.25, "o": 1, "c": 1.5, "h": 2, "l": 1,
                         "t": 1642798800000, "n": 3}]}
    landed = spark.createDataFrame([("SPY", json.dumps(body))], "ticker string, body string")
    r = parse_aggregate_bars(landed).first()
    assert r.asDict() == {"ticker": "SPY", "volume": 10, "volume_weighted_price": 1.25,
                          "close": 1.5, "dt": datetime(2022, 1, 21, 21), "transaction_number": 3}


def test_old_layout(spark):
    old = spark.createDataFrame([("O:SPY1", "SPY", 4, 0.19284)],
                                "symbol string, ticker string, weekday int, iv double")
    new = normalize_layout(old)
    assert new.columns == ["ticker", "underlying_ticker", "exp_date_weekday", "iv"]
    assert str(new.first()["iv"]) == "0.1928"


def test_week_labels_follow_the_calendar(spark):
    from math import ceil
    days = spark.sql("select explode(sequence(date '1999-12-01', date '2006-12-31')) as d")
    rows = days.select("d", dates.week_of_month(F.col("d")).alias("w"),
                       dates.year_week(F.col("d")).alias("y"),
                       dates.expiry_code(F.col("d")).alias("c")).collect()
    letters = ["A", "B", "C", "D", "EW"]
    for r in rows:
        d = r["d"]
        week = str(ceil((d.day + (1 + d.replace(day=1).weekday()) % 7) / 7))
        assert r["w"] == week and r["y"] == d.strftime("%Y-%W")
        assert r["c"] == (letters[d.weekday()] + week if d.weekday() < 5 else None)


def test_strikes(spark):
    df = spark.createDataFrame([(437.98,), (402.5,), (407.5,), (0.5,)], "c double")
    rows = df.select(strikes.round_to_base(F.col("c")).alias("five"),
                     strikes.atm_round(F.col("c")).alias("atm"),
                     strikes.near_strikes(F.col("c")).alias("near"),
                     F.size(strikes.strike_ladder(F.col("c"))).alias("n"),
                     F.array_min(strikes.strike_ladder(F.col("c"))).alias("low")).collect()
    assert [r["five"] for r in rows] == [440, 400, 410, 0]
    assert [r["atm"] for r in rows] == [438.0, 402.0, 408.0, 0.0]
    assert [list(r["near"]) for r in rows] == [[435], [395], [405], [-5]]
    assert rows[0]["n"] == 200 and rows[0]["low"] == 337
