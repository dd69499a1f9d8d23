"""Landed vendor responses to typed rows.

A landed row is the response ``body`` with the request's own columns beside it;
network access is not part of the engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tenorline.functions.dates import from_epoch_ms

DAILY_BAR = T.StructType([
    T.StructField("status", T.StringType()),
    T.StructField("from", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("afterHours", T.DoubleType()),
    T.StructField("preMarket", T.DoubleType()),
])

CONTRACT = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("underlying_ticker", T.StringType()),
    T.StructField("contract_type", T.StringType()),
    T.StructField("strike_price", T.DoubleType()),
    T.StructField("expiration_date", T.StringType()),
    T.StructField("cfi", T.StringType()),
    T.StructField("exercise_style", T.StringType()),
    T.StructField("primary_exchange", T.StringType()),
    T.StructField("shares_per_contract", T.DoubleType()),
])

AGGREGATE_BAR = T.StructType([
    T.StructField("v", T.DoubleType()),
    T.StructField("vw", T.DoubleType()),
    T.StructField("o", T.DoubleType()),
    T.StructField("c", T.DoubleType()),
    T.StructField("h", T.DoubleType()),
    T.StructField("l", T.DoubleType()),
    T.StructField("t", T.LongType()),
    T.StructField("n", T.LongType()),
])

NO_DATA = "NOT_FOUND"

LANDED_BAR = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("dt", T.TimestampType()),
    T.StructField("body", T.StringType()),
])


def _results(element: T.StructType) -> T.StructType:
    return T.StructType([T.StructField("results", T.ArrayType(element))])


def read_landed(spark: SparkSession, path: str, schema: T.StructType = LANDED_BAR) -> DataFrame:
    """Landed response files, one JSON object per line."""
    return spark.read.schema(schema).json(path)


def parse_daily_bars(landed: DataFrame, body: str = "body") -> DataFrame:
    """Open-close responses. The request's ``ticker`` and ``dt`` stand in where the
    response has none; a day without data stays as a row with null prices.
    """
    bar = F.from_json(body, DAILY_BAR)
    others = [c for c in landed.columns if c not in (body, "ticker", "dt")]
    parsed = landed.withColumn("_bar", bar)
    found = F.col("_bar.status") != NO_DATA

    def price(field: str):
        return F.when(found, F.col(f"_bar.{field}"))

    return parsed.select(
        *others,
        F.coalesce(F.col("_bar.symbol"), F.col("ticker")).alias("ticker"),
        F.coalesce(F.col("dt"), F.to_timestamp("_bar.from")).alias("dt"),
        F.col("_bar.status").alias("status"),
        price("open").alias("open"), price("high").alias("high"),
        price("low").alias("low"), price("close").alias("close"),
        price("volume").cast("long").alias("volume"),
        price("preMarket").alias("pre_market"), price("afterHours").alias("after_market"),
    )


def parse_contracts(landed: DataFrame, body: str = "body") -> DataFrame:
    """Contract-list responses, one row per contract; an empty list gives no row."""
    others = [c for c in landed.columns if c != body]
    return (
        landed.select(*others, F.explode(F.from_json(body, _results(CONTRACT))["results"])
                      .alias("_c"))
        .select(
            *others,
            F.col("_c.ticker").alias("ticker"),
            F.col("_c.underlying_ticker").alias("underlying_ticker"),
            F.col("_c.contract_type").alias("option_type"),
            F.col("_c.strike_price").alias("strike"),
            F.to_date("_c.expiration_date").alias("exp_date"),
        )
    )


def parse_aggregate_bars(landed: DataFrame, body: str = "body") -> DataFrame:
    """Aggregate-bar responses; open, high and low are not kept."""
    others = [c for c in landed.columns if c != body]
    return (
        landed.select(*others, F.explode(F.from_json(body, _results(AGGREGATE_BAR))["results"])
                      .alias("_b"))
        .select(
            *others,
            F.col("_b.v").cast("long").alias("volume"),
            F.col("_b.vw").alias("volume_weighted_price"),
            F.col("_b.c").alias("close"),
            from_epoch_ms(F.col("_b.t")).alias("dt"),
            F.col("_b.n").alias("transaction_number"),
        )
    )
