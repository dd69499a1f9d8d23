"""Written tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession, functions as F


@cache
def _one_machine_folder() -> str:
    return tempfile.mkdtemp(prefix="llm-")


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``.

    Where the setting is absent a temporary folder serves, but only if everything
    runs on one machine; on a cluster this raises instead.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _one_machine_folder()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


#: Rows that pass between Spark and Python at once where rows hold whole texts or sets.
BATCH_ROWS = 512
#: Rows of a task at least, and tasks at least, where the result of a shuffle is written.
ROWS_PER_TASK, LEAST_TASKS = 20_000, 32
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Jobs that run inside pass at most ``rows`` rows at once to Python, which bounds what
    a task holds beside its rows; the session's own setting comes back afterwards."""
    before = spark.conf.get(_BATCH, None)
    spark.conf.set(_BATCH, str(rows))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before) if before else spark.conf.unset(_BATCH)


def written(df: DataFrame, label: str, batch_rows: int = BATCH_ROWS, options: dict[str, int | bool] | None = None) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, without lineage, and still
    readable when executors are lost. Python sees ``batch_rows`` rows at once; ``options`` are the writer's."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    with small_batches(spark, batch_rows):
        df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_tasks(df: DataFrame, rows: int) -> DataFrame:
    """``df``, a result of shuffles over ``rows`` rows, in the tasks that Spark gives them by their
    size, but in no more than one per ``ROWS_PER_TASK`` rows (``LEAST_TASKS`` where there are
    fewer), so that a small table is not written as one tiny file per shuffle partition."""
    return df.coalesce(max(LEAST_TASKS, -(-rows // ROWS_PER_TASK)))


def gathered(df: DataFrame, label: str, rows: int) -> DataFrame:
    """``written`` for results of shuffles, ``in_tasks``."""
    return written(in_tasks(df, rows), label)


def broadcast_if_small(table: DataFrame, most_rows: int) -> DataFrame:
    """A written table, marked for broadcast only while it has at most ``most_rows`` rows."""
    return F.broadcast(table) if table.count() <= most_rows else table
