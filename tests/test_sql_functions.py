from datetime import date

from pyspark.sql import functions as F

from tenorline.functions import dates, sql, symbols
from tenorline.functions.black_scholes import implied_vol


def test_sql_and_columns_agree(spark):
    sql.register(spark)
    sql.register(spark)  # again, as in a second job of the session
    days = spark.sql("select explode(sequence(date'2020-12-25', date'2022-01-10')) as d").unionByName(
        spark.createDataFrame([(None,)], "d date"))
    got = days.select("d", F.expr("week_of_month(d)"), F.expr("expiry_code(d)"), F.expr("year_week(d)"))
    want = days.select("d", dates.week_of_month(F.col("d")), dates.expiry_code(F.col("d")), dates.year_week(F.col("d")))
    assert [tuple(r) for r in got.orderBy("d").collect()] == [tuple(r) for r in want.orderBy("d").collect()]
    names = spark.createDataFrame([("SPY_042522P420.5",), ("CPC_010122C1",), ("SPY",), ("",), (None,)], "s string")
    got = names.select(F.expr("symbol_underlying(s)"), F.expr("symbol_strike(s)"), F.expr("symbol_call_put(s)")).collect()
    want = names.select(symbols.underlying(F.col("s")), symbols.strike(F.col("s")), symbols.call_put(F.col("s"))).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]
    assert spark.sql("select from_epoch_ms(1650916800000) as t").first()["t"].date() == date(2022, 4, 25)


def test_volatility_from_sql(spark):
    sql.register(spark)
    rows = spark.createDataFrame(
        [(8.0, 438.0, 440.0, 0.05, "call"), (8.0, 438.0, 440.0, 0.05, "put"), (0.0, 438.0, 440.0, 0.05, "call"),
         (None, 438.0, 440.0, 0.05, "call"), (8.0, 438.0, 440.0, 0.05, None)],
        "p double, s double, k double, t double, side string")
    got = [r["v"] for r in rows.selectExpr("implied_vol(p, s, k, t, side) as v").collect()]
    want = [r["v"] for r in rows.select(implied_vol(F.col("p"), F.col("s"), F.col("k"), F.col("t"), F.col("side")).alias("v")).collect()]
    assert got == want and got[0] > 0.1 and got[2] is None and got[3] is None


def test_calls_are_replaced_by_their_expressions(spark):
    sql.register(spark)
    plan = spark.sql("select year_week(date_add(date'2022-01-01', cast(id as int))) from range(5)")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "weekday" in plan
