import random
from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quotes import frame, quote
from tenorline.operators.structures import (
    chain_pairs, chain_spreads, match_legs, time_spreads, wide_pairs,
)


@pytest.fixture(scope="module")
def market():
    """A random book; some rows have a null in the grain."""
    rng = random.Random(5)
    rows, seen, next_id = [], set(), 1
    for _ in range(400):
        key = (rng.choice([date(2022, 1, 21), date(2022, 1, 24)]), rng.choice(["SPY", "QQQ"]),
               rng.choice(["call", "put"]), rng.choice([455.0, 460.0, 465.0]), rng.randint(1, 20))
        if key in seen:
            continue
        seen.add(key)
        day, u, side, strike, dte = key
        rows.append(quote(next_id, dte, strike, side, u, day))
        next_id += 1
    for broken in ({"strike": None}, {"side": None}, {"dte": None}):
        rows.append(quote(next_id, **{"dte": 7, **broken}))
        next_id += 1
    return rows


def brute_force(rows, dte_diff=0, strike_diff=0.0, invert=False):
    """All (row, match) ids by comparing every row with every other."""
    pairs = set()
    for r in rows:
        for m in rows:
            if None in (r["strike"], r["option_type"], r["dte"],
                        m["strike"], m["option_type"], m["dte"]):
                continue
            if (r["dt"], r["underlying_ticker"]) != (m["dt"], m["underlying_ticker"]):
                continue
            side = r["option_type"]
            if invert:
                side = "call" if side == "put" else "put"
            if (m["option_type"] == side and m["strike"] == r["strike"] + strike_diff
                    and r["dte"] - m["dte"] == dte_diff):
                pairs.add((r["id"], m["id"]))
    return pairs


def ids(df, a="id_row", b="id_match"):
    rows = [(r[a], r[b]) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("shift", [
    {"dte_diff": 3}, {"dte_diff": -7}, {"strike_diff": 5.0}, {"strike_diff": -5.0, "dte_diff": 4},
    {"invert": True}, {"invert": True, "strike_diff": 5.0}])
@pytest.mark.parametrize("unique", [False, True])
def test_match_equals_brute_force(spark, market, shift, unique):
    got = match_legs(frame(spark, market), unique_grain=unique, **shift)
    assert ids(got) == brute_force(market, **shift)


@pytest.mark.parametrize("gap", [3, 4, 7])
def test_spread_paths_agree(spark, market, gap):
    want = {(front, back) for back, front in brute_force(market, dte_diff=gap)}
    assert want
    quotes = frame(spark, market)
    for unique in (False, True):
        assert ids(time_spreads(quotes, gap, unique_grain=unique), "id_f", "id_b") == want
    wide = wide_pairs(quotes, gap, "label", ("id",), unique_grain=True)
    assert ids(wide, "id_f", "id_b") == want


def test_several_gaps_at_once(spark, market):
    quotes = frame(spark, market)
    together = chain_spreads(quotes, (3, 7, 4)).select("id_f", "id_b", "desc")
    apart = None
    for gap in (3, 7, 4):
        one = time_spreads(quotes, gap).select("id_f", "id_b", "desc")
        apart = one if apart is None else apart.unionByName(one)
    assert sorted(map(tuple, together.collect())) == sorted(map(tuple, apart.collect()))


def test_expiry_weekdays_when_asked(spark, market):
    quotes = frame(spark, market)
    strict = time_spreads(quotes, 3, front_weekday=4, back_weekday=0)
    by_id = {r["id"]: r for r in market}
    want = {(f, b) for b, f in brute_force(market, dte_diff=3)
            if by_id[f]["exp_date"].weekday() == 4 and by_id[b]["exp_date"].weekday() == 0}
    assert ids(strict, "id_f", "id_b") == want
    fast = time_spreads(quotes, 3, unique_grain=True, front_weekday=4, back_weekday=0)
    assert ids(fast, "id_f", "id_b") == want


DUPLICATED = [quote(1, 7), quote(2, 7), quote(3, 10)]


@pytest.mark.parametrize("unique", [False, True])
def test_two_fronts_raise(spark, unique):
    quotes = frame(spark, DUPLICATED)
    with pytest.raises(PySparkException, match="more than one quote matches"):
        time_spreads(quotes, 3, unique_grain=unique).collect()


def test_two_fronts_flagged(spark):
    got = match_legs(frame(spark, DUPLICATED), dte_diff=3, strict=False).collect()
    assert [(r["id_row"], r["id_match"], r["matches"]) for r in got] == [(3, 1, 2)]


@pytest.mark.parametrize("unique", [False, True])
def test_two_backs_share_a_front(spark, unique):
    quotes = frame(spark, [quote(1, 7), quote(2, 10), quote(3, 10)])
    assert ids(time_spreads(quotes, 3, unique_grain=unique), "id_f", "id_b") == {(1, 2), (1, 3)}


def test_hot_probe_key_gives_linear_output(spark):
    """One grain holds a third of the rows; duplicates on the probing side stay whole."""
    hot = spark.range(3000).select(
        (F.col("id") + 10).alias("id"), F.lit(quote(0, 10)["dt"]).alias("dt"),
        F.concat(F.lit("H"), F.col("id").cast("string")).alias("ticker"),
        F.lit("SPY").alias("underlying_ticker"), F.lit("call").alias("option_type"),
        F.lit(460.0).alias("strike"), F.lit(10).alias("dte"))
    front = frame(spark, [quote(1, 7)]).select(*hot.columns)
    assert time_spreads(hot.unionByName(front), 3).count() == 3000


def test_chain_pairing_takes_one_shuffle(spark, market):
    plan = chain_pairs(frame(spark, market), -3, ("id",), ("_b", "_f"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text


def test_hot_probe_partition_is_split(spark):
    """Both sides of the join come straight from a shuffle, so AQE splits a hot grain."""
    names = ("autoBroadcastJoinThreshold", "adaptive.skewJoin.skewedPartitionThresholdInBytes",
             "adaptive.advisoryPartitionSizeInBytes", "adaptive.skewJoin.skewedPartitionFactor")
    before = {n: spark.conf.get(f"spark.sql.{n}") for n in names}
    for n, value in zip(names, ("-1", "64KB", "64KB", "2")):
        spark.conf.set(f"spark.sql.{n}", value)
    try:
        day = quote(0, 10)["dt"]
        rows = spark.range(60000).repartition(8).select(
            "id", F.lit(day).alias("dt"), F.sha2(F.col("id").cast("string"), 512).alias("ticker"),
            F.lit("SPY").alias("underlying_ticker"), F.lit("call").alias("option_type"),
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("double").alias("strike"),
            F.lit(10).alias("dte"))
        fronts = rows.filter("id % 3 != 0 or id = 0").withColumn("dte", F.lit(7)).withColumn(
            "id", F.col("id") + 100000)
        spreads = time_spreads(rows.unionByName(fronts), 3)
        assert len(spreads.collect()) == 60000
        assert "skew=true" in spreads._jdf.queryExecution().executedPlan().toString()
    finally:
        for n, value in before.items():
            spark.conf.set(f"spark.sql.{n}", value)
