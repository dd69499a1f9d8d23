"""Idempotent writes to date-partitioned Parquet tables.

Every write can be repeated after a lost executor or a failed run: appends skip
keys already stored, and Spark builds replaced partitions beside the table before
it swaps them in. Incoming rows are written once to a folder beside the table first,
so that a merge that reads them several times does not compute them again.

Merges into one table commit one after the other, so a key that two writers bring at once is
stored once: the second one merges with what the first has stored.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

from tenorline.operators.merge import first_per_key, insert_columns, latest_per_key, new_rows, patch, upsert
from tenorline.sources.tables import DAY, with_day


def _fs(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a write has been committed: its first act is to put day folders in place. What
    a failed first write leaves behind does not count.
    """
    fs, days = _fs(spark, f"{path.rstrip('/')}/{DAY}=*")
    return bool(fs.globStatus(days))


@contextmanager
def staged(spark: SparkSession, rows: DataFrame, beside: str) -> Iterator[DataFrame]:
    """``rows`` as files in a folder next to the table ``beside``, removed when done."""
    parent, _, name = beside.rstrip("/").rpartition("/")
    path = f"{parent}/_staging/{name}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    try:
        yield spark.read.schema(rows.schema).parquet(path)
    finally:
        fs, jvm_path = _fs(spark, path)
        fs.delete(jvm_path, True)


#: Seconds after which a version that was begun and not ended counts as given up.
LEASE = 3600.0
_PAUSE = 0.2


def _versions(fs, folder) -> dict[int, dict[str, float]]:
    """The markers of each version: name of the state and its time in seconds."""
    found: dict[int, dict[str, float]] = {}
    for status in fs.listStatus(folder):
        number, _, state = status.getPath().getName().partition(".")
        found.setdefault(int(number), {})[state] = status.getModificationTime() / 1000
    return found


@contextmanager
def committing(spark: SparkSession, path: str, lease: float = LEASE) -> Iterator[int]:
    """The right to change the table ``path``, as its next version; waits while another has it.

    A version begins when its marker, beside the table, is created by one writer alone, and
    ends with a second marker. Whoever finds the marker taken looks again. A writer that died
    leaves a version without an end, which counts as given up after ``lease`` seconds; as
    Spark puts files in place only when a write is complete, the table is whole either way.
    """
    parent, _, name = path.rstrip("/").rpartition("/")
    fs, folder = _fs(spark, f"{parent}/_versions/{name}")
    fs.mkdirs(folder)

    def marker(number: int, state: str):
        return spark._jvm.org.apache.hadoop.fs.Path(folder, f"{number:012d}.{state}")

    while True:
        versions = _versions(fs, folder)
        last = max(versions, default=0)
        states = versions.get(last, {"ended": 0.0})
        if "ended" not in states and time.time() - states["begun"] < lease:
            time.sleep(_PAUSE)
            continue
        try:
            fs.create(marker(last + 1, "begun"), False).close()
            break
        except Py4JJavaError as e:
            if "FileAlreadyExists" not in str(e):
                raise
    try:
        yield last + 1
    finally:
        fs.create(marker(last + 1, "ended"), True).close()
        for number in versions:
            if number < last:
                for state in versions[number]:
                    fs.delete(marker(number, state), False)


def _by_day(df: DataFrame):
    """A partitioned writer. Rows are rebalanced by day, so that files are neither many
    and tiny nor, for a hot day, one and huge.
    """
    return df.hint("rebalance", DAY).write.partitionBy(DAY)


def write_table(df: DataFrame, path: str) -> None:
    """Replaces the table."""
    _by_day(with_day(df)).mode("overwrite").parquet(path)


def _touched(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Only the target's partitions that ``rows`` fall into.

    The days are named in the plan, so untouched partitions are not even listed
    as input; there is at most one per calendar day.
    """
    days = [r[DAY] for r in rows.select(DAY).distinct().collect()]
    return target.filter(F.col(DAY).isin(days))


def append_new(spark: SparkSession, path: str, rows: DataFrame, key: Sequence[str],
               order: Sequence[str]) -> None:
    """Insert-ignore into the stored table, which is created if absent.

    Columns that the table lacks raise, but for those of ``order``.
    """
    with staged(spark, with_day(rows), path) as incoming, committing(spark, path):
        if not table_exists(spark, path):
            write_table(first_per_key(incoming.drop(DAY), key, order), path)
            return
        target = spark.read.parquet(path)
        fresh = new_rows(_touched(target, incoming).select(*key), incoming, key, order)
        columns = insert_columns(fresh, target, order)
        _by_day(fresh.select(*columns)).mode("append").parquet(path)


def _merge(spark: SparkSession, path: str, rows: DataFrame, first_rows, merge) -> None:
    """Replaces the day partitions that ``rows`` touch by their merge; an absent table is created
    from ``first_rows``.

    New partitions replace the old ones when all of them are written, so the merge may read
    what it replaces.
    """
    with staged(spark, with_day(rows), path) as source, committing(spark, path):
        if not table_exists(spark, path):
            write_table(first_rows(source.drop(DAY)), path)
            return
        target = spark.read.parquet(path)
        touched = _touched(target, source).select(*target.columns)
        _by_day(merge(touched, source)).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def upsert_rows(spark: SparkSession, path: str, rows: DataFrame, key: Sequence[str],
                order: Sequence[str]) -> None:
    """Whole-row upsert that rewrites only the touched day partitions; an absent table is
    created. The key must fix the day: a row never moves between partitions.
    """
    _merge(spark, path, rows, lambda source: latest_per_key(source, key, order),
           lambda target, source: upsert(target, source, key, order))


def patch_rows(spark: SparkSession, path: str, rows: DataFrame, key: Sequence[str],
               order: Sequence[str]) -> None:
    """Field-by-field upsert that rewrites only the touched day partitions; an absent table is
    created. The key must fix the day and hold the column it follows from.
    """
    _merge(spark, path, rows, lambda source: patch(source.limit(0), source, key, order),
           lambda target, source: patch(target, source, [*key, DAY], order))
