"""Underlying price at the instant of an option quote."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def spot_prices(stock_quotes: DataFrame) -> DataFrame:
    """One close per (dt, underlying)."""
    return stock_quotes.groupBy(
        "dt", F.col("ticker").alias("underlying_ticker")
    ).agg(F.min("close").alias("spot"))


def attach_spot(quotes: DataFrame, stock_quotes: DataFrame, *, strict: bool = False,
                unique: bool = False) -> DataFrame:
    """Adds ``spot``; without a stock quote it is null, or an error when ``strict``.

    ``unique`` says that stock_quotes already has one row per (dt, ticker). A plain
    equi-join: Spark broadcasts the prices while they are small, and beyond that AQE
    splits the quotes of a hot underlying by measured size.
    """
    spot = (
        stock_quotes.select("dt", F.col("ticker").alias("underlying_ticker"),
                            F.col("close").alias("spot"))
        if unique else spot_prices(stock_quotes)
    )
    joined = quotes.join(spot, ["dt", "underlying_ticker"], "left")
    if not strict:
        return joined
    missing = F.raise_error(F.concat(F.lit("no spot for "), F.col("underlying_ticker"),
                                     F.lit(" at "), F.col("dt").cast("string")))
    return joined.withColumn("spot", F.coalesce(F.col("spot"), missing))
