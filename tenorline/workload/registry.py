"""Registration of checked queries."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tenorline.workload.views import Tables, ansi_with

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def comparable(df: DataFrame, nullable: Mapping[str, str]) -> DataFrame:
    """Result types on which both engines agree: dates as ISO text, decimals as doubles,
    instants without a zone, and integers and flags that may be null as named.
    """
    casts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in nullable:
            c = c.cast(nullable[f.name]).alias(f.name)
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string").alias(f.name)
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double").alias(f.name)
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz").alias(f.name)
        casts.append(c)
    return df.select(*casts)


def query(name: str, oracle: str | None = None, nullable: Mapping[str, str] | None = None):
    """Registers a function of ``Tables`` under ``name`` with its checking SQL.

    ``nullable`` names integer and flag columns that hold nulls and the type
    (double or string) to compare them in.
    """
    nullable = nullable or {}
    casts = ", ".join(f'cast("{c}" as {k.replace("string", "varchar")}) as "{c}"'
                      for c, k in nullable.items())

    def register(fn: Callable[[Tables], DataFrame]):
        assert name not in _QUERIES, name
        _QUERIES[name] = lambda spark, sf_dir: comparable(
            fn(Tables(spark, sf_dir)), nullable)
        if oracle is not None:
            text = ansi_with(oracle)
            _ORACLES[name] = f"select * replace ({casts}) from (\n{text}\n) r" if casts else text
        return fn

    return register


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def all_oracles() -> dict[str, str]:
    return dict(_ORACLES)
