"""CSV export by underlying and date."""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, functions as F


def export_csv(df: DataFrame, path: str, underlying: str = "underlying_ticker",
               dt: str = "dt") -> None:
    """One folder per underlying and date. Rebalancing by both gives one file per
    folder, except where AQE splits a folder too large for one task.
    """
    dated = df.withColumns({"u": F.col(underlying), "d": F.to_date(dt)})
    (
        dated.hint("rebalance", "u", "d")
        .write.mode("overwrite").option("header", True).partitionBy("u", "d").csv(path)
    )


def export_per_underlying(df: DataFrame, path: str, underlying: str = "underlying_ticker",
                          dt: str = "dt") -> None:
    """One file ``{underlying}-{last date}.csv`` per underlying, all directly below ``path``.

    Spark writes a folder per file name beside ``path``; the one file in each is then moved
    into place, so the driver handles as many names as there are underlyings.
    """
    spark = df.sparkSession
    last = df.groupBy(F.col(underlying).alias("_u")).agg(F.date_format(F.max(dt), "yyyy-MM-dd").alias("_last"))
    named = (df.join(last, df[underlying] == F.col("_u"))
             .withColumn("_name", F.concat_ws("-", "_u", "_last")).drop("_u", "_last"))
    parent, _, name = path.rstrip("/").rpartition("/")
    staging = f"{parent}/_staging/{name}-{uuid.uuid4().hex}"
    named.repartition("_name").write.option("header", True).partitionBy("_name").csv(staging)
    paths = spark._jvm.org.apache.hadoop.fs.Path
    fs = paths(path).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(paths(path))
    for found in fs.globStatus(paths(f"{staging}/_name=*/part-*")):
        target = paths(path, unquote(found.getPath().getParent().getName().removeprefix("_name=")) + ".csv")
        fs.delete(target, False)
        fs.rename(found.getPath(), target)
    fs.delete(paths(staging), True)
