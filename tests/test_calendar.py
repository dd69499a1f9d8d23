from datetime import date, datetime

from pyspark.sql import functions as F

from tenorline.functions.trading_days import (
    ExchangeCalendar, closed_by, date_chunks, easter, is_session, last_session_on_or_before, market_schedule,
    session_close, sessions_in,
)


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


def day(text):
    return F.lit(text).cast("date")


def test_easter(spark):
    known = {1995: "04-16", 1999: "04-04", 2000: "04-23", 2008: "03-23", 2011: "04-24",
             2016: "03-27", 2022: "04-17", 2024: "03-31", 2025: "04-20", 2038: "04-25"}
    rows = spark.createDataFrame([(y,) for y in known], "y int").select(
        "y", easter(F.col("y")).alias("d")).collect()
    assert {r["y"]: r["d"].strftime("%m-%d") for r in rows} == known


def test_holidays(spark):
    closed = ["1997-07-04", "1998-01-19", "1998-07-03", "2001-09-12", "2004-06-11", "2012-10-30",
              "2021-12-24", "2022-01-17", "2022-04-15", "2022-06-20", "2022-12-26", "2023-01-02",
              "2025-01-09", "2026-04-03", "2022-01-22"]
    opened = ["1997-01-20", "2010-12-31", "2021-12-31", "2021-06-18", "2022-01-18", "1999-12-31"]
    rows = spark.createDataFrame([(d,) for d in closed + opened], "t string").select(
        "t", is_session(F.col("t").cast("date")).alias("s")).collect()
    assert {r["t"] for r in rows if r["s"]} == set(opened)


def test_sessions_per_year(spark):
    years = spark.createDataFrame(
        [(y, date(y, 1, 1), date(y, 12, 31)) for y in (1996, 2001, 2012, 2021, 2022, 2024)],
        "y int, sd date, ed date")
    counts = {r["y"]: r["count"] for r in sessions_in(years, "sd", "ed").groupBy("y").count()
              .collect()}
    assert counts == {1996: 254, 2001: 248, 2012: 250, 2021: 252, 2022: 251, 2024: 252}


def test_closing_instants(spark):
    assert one(spark, session_close(day("2022-03-11"))) == datetime(2022, 3, 11, 21)
    assert one(spark, session_close(day("2022-03-14"))) == datetime(2022, 3, 14, 20)
    assert one(spark, session_close(day("2021-11-26"))) == datetime(2021, 11, 26, 18)
    assert one(spark, session_close(day("2002-07-05"))) == datetime(2002, 7, 5, 17)
    assert one(spark, session_close(day("2013-07-03"))) == datetime(2013, 7, 3, 17)
    assert one(spark, session_close(day("2014-12-24"))) == datetime(2014, 12, 24, 18)


def test_last_session(spark):
    assert one(spark, last_session_on_or_before(day("2001-09-16"))) == date(2001, 9, 10)
    assert one(spark, last_session_on_or_before(day("2022-04-15"))) == date(2022, 4, 14)
    assert one(spark, last_session_on_or_before(day("2022-04-14"))) == date(2022, 4, 14)


def test_schedule_includes_both_ends_and_skips_empty_ranges(spark):
    ranges = spark.createDataFrame(
        [("A", date(2022, 4, 14), date(2022, 4, 18)), ("B", date(2022, 4, 18), date(2022, 4, 14))],
        "ticker string, sd date, ed date")
    rows = market_schedule(ranges, "sd", "ed")
    assert [r["session"] for r in rows.orderBy("session").collect()] == [
        date(2022, 4, 14), date(2022, 4, 18)]
    assert rows.first()["market_open"] == datetime(2022, 4, 14, 13, 30)
    now = F.lit("2022-04-18 19:59:59").cast("timestamp")
    assert closed_by(rows, now).count() == 1


def test_chunks_cover_a_range_once(spark):
    ranges = spark.createDataFrame([("A", date(2022, 6, 3), date(2022, 8, 1))],
                                   "ticker string, sd date, ed date")
    rows = date_chunks(ranges, 20).orderBy("sd").collect()
    assert [(r["sd"], r["ed"]) for r in rows] == [
        (date(2022, 6, 3), date(2022, 6, 22)), (date(2022, 6, 23), date(2022, 7, 12)),
        (date(2022, 7, 13), date(2022, 8, 1))]


def test_calendar_as_data(spark):
    days = lambda *d: spark.createDataFrame([(x,) for x in d], "day string")
    calendar = ExchangeCalendar("Asia/Tokyo", 9 * 60, 15 * 60, days("2022-05-03", "2022-05-03", "2022-05-04"),
                                days("2022-05-02").withColumn("minute", F.lit(11 * 60 + 30)))
    week = spark.createDataFrame([("X", date(2022, 4, 29), date(2022, 5, 6)), ("Y", date(2022, 5, 7), date(2022, 5, 1))],
                                 "ticker string, sd date, ed date")
    rows = market_schedule(week, "sd", "ed", calendar).orderBy("session").collect()
    assert [(r["ticker"], r["session"].day, r["market_open"].hour, r["market_close"]) for r in rows] == [
        ("X", 29, 0, datetime(2022, 4, 29, 6)), ("X", 2, 0, datetime(2022, 5, 2, 2, 30)),
        ("X", 5, 0, datetime(2022, 5, 5, 6)), ("X", 6, 0, datetime(2022, 5, 6, 6))]
    assert rows[0].asDict().keys() == market_schedule(week, "sd", "ed").first().asDict().keys()
    gulf = ExchangeCalendar("Asia/Riyadh", 600, 900, days(), days().withColumn("minute", F.lit(0)), weekend=(4, 5))
    assert [r["session"].day for r in sessions_in(week, "sd", "ed", calendar=gulf).orderBy("session").collect()] == [1, 2, 3, 4, 5]


def test_the_rule_needs_no_join_and_prunes(spark):
    ranges = spark.createDataFrame([(date(2022, 1, 1), date(2022, 1, 31))], "sd date, ed date")
    plan = market_schedule(ranges, "sd", "ed")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_bars_follow_the_exchange_clock(spark):
    from tenorline.operators.bars import aggregate_bars
    at = ["2022-03-12 04:59:00", "2022-03-12 05:00:00", "2022-03-14 03:59:00", "2022-03-14 04:00:00",
          "2022-04-01 03:59:59", "2022-04-01 04:00:00", "2023-01-01 04:59:00"]
    ticks = spark.createDataFrame([("X", a, float(k), 1, k) for k, a in enumerate(at)],
                                  "ticker string, at string, price double, size int, tick_id int").withColumn("ts", F.col("at").cast("timestamp"))

    def starts(span, n=1):
        return [(r["dt"].strftime("%Y-%m-%d %H"), r["transaction_number"]) for r in aggregate_bars(ticks, span, n).orderBy("dt").collect()]

    # 13 March 2022 has 23 hours in New York.
    assert starts("day")[:4] == [("2022-03-11 05", 1), ("2022-03-12 05", 1), ("2022-03-13 05", 1), ("2022-03-14 04", 1)]
    assert starts("week")[:2] == [("2022-03-07 05", 3), ("2022-03-14 04", 1)]
    assert starts("month") == [("2022-03-01 05", 5), ("2022-04-01 04", 1), ("2022-12-01 05", 1)]
    assert starts("quarter") == [("2022-01-01 05", 5), ("2022-04-01 04", 1), ("2022-10-01 04", 1)]
    assert starts("year") == [("2022-01-01 05", 7)]
    assert starts("month", 2) == [("2022-03-01 05", 6), ("2022-11-01 04", 1)]
    with __import__("pytest").raises(ValueError):
        aggregate_bars(ticks, "fortnight")
