"""Table layouts and the one place where stored columns get their types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

PRICE = T.DecimalType(8, 2)
IV = T.DecimalType(12, 4)

STOCK_QUOTES = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("dt", T.TimestampType(), False),
    T.StructField("ticker", T.StringType(), False),
    T.StructField("open", PRICE),
    T.StructField("high", PRICE),
    T.StructField("low", PRICE),
    T.StructField("close", PRICE),
    T.StructField("fetched", T.BooleanType()),
])

OPTION_QUOTES = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("dt", T.TimestampType(), False),
    T.StructField("ticker", T.StringType(), False),
    T.StructField("open", PRICE),
    T.StructField("high", PRICE),
    T.StructField("low", PRICE),
    T.StructField("close", PRICE),
    T.StructField("volume", T.LongType()),
    T.StructField("pre_market", PRICE),
    T.StructField("after_market", PRICE),
    T.StructField("fetched", T.BooleanType()),
    T.StructField("exp_date", T.DateType()),
    T.StructField("dte", T.IntegerType()),
    T.StructField("strike", PRICE),
    T.StructField("underlying_ticker", T.StringType(), False),
    T.StructField("delta", PRICE),
    T.StructField("theta", PRICE),
    T.StructField("vega", PRICE),
    T.StructField("gamma", PRICE),
    T.StructField("iv", IV),
    T.StructField("option_type", T.StringType()),
    T.StructField("exp_date_weekday", T.IntegerType()),
])

STRATEGY_TIMESPREADS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("dt", T.TimestampType()),
    T.StructField("desc", T.StringType()),
    T.StructField("id_f", T.LongType()),
    T.StructField("id_b", T.LongType()),
    T.StructField("ticker_f", T.StringType()),
    T.StructField("ticker_b", T.StringType()),
])

RAW_SAMPLES = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("ask", T.DoubleType()),
    T.StructField("bid", T.DoubleType()),
    T.StructField("delta", T.DoubleType()),
    T.StructField("theta", T.DoubleType()),
    T.StructField("volatility", T.DoubleType()),
    T.StructField("daysToExpiration", T.IntegerType()),
    T.StructField("expirationDate", T.LongType()),
    T.StructField("lastTradingDay", T.LongType()),
    T.StructField("quoteTimeInLong", T.LongType()),
    T.StructField("tradeTimeInLong", T.LongType()),
    T.StructField("sampleTimeInLong", T.LongType()),
])

# Unique keys of the stored tables.
STOCK_KEY = ("dt", "ticker")
OPTION_KEY = ("dt", "ticker")
SPREAD_KEY = ("dt", "desc", "ticker_f", "ticker_b")


def as_utc_instants(df: DataFrame) -> DataFrame:
    """Zone-less timestamps become instants (call under a UTC session)."""
    ntz = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in ntz}) if ntz else df


def with_natural_id(df: DataFrame, key=OPTION_KEY) -> DataFrame:
    """Surrogate id from the natural key: stable under task retries and re-runs."""
    return df.withColumn("id", F.xxhash64(*key))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project onto a table layout: absent columns are null, values get the stored scale.

    A value that does not fit its stored type raises, as storing it as null would lose it;
    ``misfits`` finds such rows beforehand.
    """
    have = set(df.columns)
    return df.select(*[
        (_stored(f) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])


def _does_not_fit(field: T.StructField) -> Column:
    return F.col(field.name).isNotNull() & F.col(field.name).try_cast(field.dataType).isNull()


def _stored(field: T.StructField) -> Column:
    problem = F.concat(F.lit(f"{field.name} does not fit {field.dataType.simpleString()}: "),
                       F.col(field.name).cast("string"))
    return F.when(_does_not_fit(field), F.raise_error(problem)).otherwise(
        F.col(field.name).try_cast(field.dataType))


def misfits(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows with a value that its stored type cannot hold, and the names of such columns."""
    bad = F.array(*[F.when(_does_not_fit(f), f.name) for f in schema.fields if f.name in df.columns])
    return df.withColumn("columns", F.array_compact(bad)).filter(F.size("columns") > 0)


def normalize_layout(old: DataFrame) -> DataFrame:
    """Earliest option_quotes layout -> current one, in a single projection.

    ``ticker`` meant the underlying and ``symbol`` the contract; ``weekday`` was
    the expiry weekday; ``iv`` had two decimals.
    """
    renamed = {
        "ticker": F.col("ticker").alias("underlying_ticker"),
        "symbol": F.col("symbol").alias("ticker"),
        "weekday": F.col("weekday").alias("exp_date_weekday"),
        "iv": F.col("iv").cast(IV).alias("iv"),
    }
    return old.select(*[renamed.get(c, F.col(c)) for c in old.columns])
