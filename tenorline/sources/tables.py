"""Stored tables and quote CSV files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tenorline.schema import as_utc_instants

# Partition column of stored quote tables: the UTC date of ``dt``.
DAY = "d"


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return as_utc_instants(reader.parquet(path))


def with_day(df: DataFrame) -> DataFrame:
    return df.withColumn(DAY, F.to_date("dt"))


def day_of(df: DataFrame) -> Column:
    """The quote's UTC date: the partition column where the table has one, so that
    conditions on it prune partitions.
    """
    return F.col(DAY) if DAY in df.columns else F.to_date("dt")


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             index_column: bool = False) -> DataFrame:
    """CSV with a header; ``index_column`` says that an unnamed row number comes first."""
    if index_column:
        schema = T.StructType([T.StructField("_index", T.LongType()), *schema.fields])
    df = (
        spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(path)
    )
    return df.drop("_index")
