"""Sampled quote files and the columns derived from their symbols and epochs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tenorline.functions import symbols
from tenorline.functions.dates import expiry_code, from_epoch_ms, year_week
from tenorline.schema import as_utc_instants

EPOCH_COLUMNS = ("expirationDate", "lastTradingDay", "quoteTimeInLong", "tradeTimeInLong",
                 "sampleTimeInLong")


def scan_raw(spark: SparkSession, path: str, schema: T.StructType,
             pattern: str = "*.parquet.gzip") -> DataFrame:
    """All sample files below ``path``; ``sample_epoch`` is the number leading the file name.

    Day folders are plain (``2022/4/25``), so any level of the tree may be given.
    """
    files = (
        spark.read.schema(schema).option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True).parquet(path)
    )
    epoch = F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)", 1).try_cast("long")
    return as_utc_instants(files.withColumn("sample_epoch", epoch))


def epochs_to_timestamps(df: DataFrame, columns=EPOCH_COLUMNS) -> DataFrame:
    """Each epoch-millisecond column converted from its own values."""
    return df.withColumns({c: from_epoch_ms(F.col(c)) for c in columns if c in df.columns})


def with_symbol_fields(df: DataFrame) -> DataFrame:
    symbol = F.col("symbol")
    return df.withColumns({
        "underlying": symbols.underlying(symbol),
        "strike": symbols.strike(symbol),
        "call_put": symbols.call_put(symbol),
    })


def with_expiry_labels(df: DataFrame) -> DataFrame:
    day = F.to_date("lastTradingDay")
    return df.withColumns({
        "lastTradingDayDes": expiry_code(day),
        "lastTradingDayWeekNumber": year_week(day),
    })


def typed_samples(raw: DataFrame) -> DataFrame:
    """Raw rows with real timestamps and all derived columns."""
    return with_expiry_labels(with_symbol_fields(epochs_to_timestamps(raw)))
