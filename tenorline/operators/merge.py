"""Insert-ignore and upsert as DataFrame plans: (target, source) -> new target."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _one_per_key(rows: DataFrame, key: Sequence[str], order: Sequence[str | Column], pick) -> DataFrame:
    """One whole row per key, chosen by an aggregate that combines before the shuffle."""
    whole = F.struct(*[F.col(c) for c in rows.columns])
    chosen = rows.groupBy(*key).agg(pick(whole, F.struct(*order)).alias("_row"))
    return chosen.select("_row.*")


def first_per_key(rows: DataFrame, key: Sequence[str],
                  order: Sequence[str | Column]) -> DataFrame:
    return _one_per_key(rows, key, order, F.min_by)


def latest_per_key(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _one_per_key(rows, key, order, F.max_by)


def new_rows(target: DataFrame, incoming: DataFrame, key: Sequence[str],
             order: Sequence[str]) -> DataFrame:
    """Incoming rows that an insert-ignore would add: first of the batch, not stored yet."""
    first = first_per_key(incoming, key, order)
    return first.join(target.select(*key), list(key), "left_anti").select(*incoming.columns)


def insert_columns(rows: DataFrame, target: DataFrame, helpers: Sequence[str]) -> list[str]:
    """Columns of ``rows`` to store; one that neither the target has nor ``helpers`` names raises."""
    unknown = set(rows.columns) - set(target.columns) - set(helpers)
    if unknown:
        raise ValueError(f"columns the table lacks: {sorted(unknown)}")
    return [c for c in rows.columns if c in target.columns]


def insert_ignore(target: DataFrame, incoming: DataFrame, key: Sequence[str],
                  order: Sequence[str]) -> DataFrame:
    """Stored rows win over incoming ones; of a batch the first by ``order`` wins.

    Columns of ``incoming`` that the target lacks raise, but for those of ``order``.
    """
    fresh = new_rows(target, incoming, key, order)
    keep = insert_columns(fresh, target, order)
    return target.unionByName(fresh.select(*keep), allowMissingColumns=True)


def upsert(target: DataFrame, source: DataFrame, key: Sequence[str], order: Sequence[str],
           on_update: Mapping[str, Column] | None = None) -> DataFrame:
    """Whole-row replace: a matched target row takes every column from the source,
    null where the source lacks it. Of a batch the latest by ``order`` wins.

    ``on_update`` overrides columns of replaced (not of inserted) rows. Columns of ``source``
    that the target lacks raise, but for those of ``order``.
    """
    key = list(key)
    latest = latest_per_key(source, key, order)
    if on_update:
        stored = target.select(*key).distinct().withColumn("_stored", F.lit(True))
        latest = latest.join(stored, key, "left").withColumns({
            c: F.when(F.col("_stored"), value).otherwise(F.col(c) if c in source.columns else None)
            for c, value in on_update.items()
        }).drop("_stored")
    keep = insert_columns(latest, target, order)
    untouched = target.join(latest.select(*key), key, "left_anti").select(*target.columns)
    return untouched.unionByName(latest.select(*keep), allowMissingColumns=True)


def patch(target: DataFrame, source: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Field-by-field upsert: a matched target row takes each field that the source gives and
    keeps the stored one where the source is null or lacks the column. Rows with a new key are
    added. Of a batch the latest value by ``order`` that is not null wins, per field.

    Columns of ``source`` that the target lacks raise, but for those of ``order``.
    """
    key, at = list(key), F.struct(*order)
    fields = [c for c in insert_columns(source, target, order) if c not in key]
    given = source.groupBy(*key).agg(*[
        F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(f"_given_{c}") for c in fields] or [F.count(F.lit(1)).alias("_n")])
    return target.join(given, key, "full_outer").select(*[
        F.coalesce(f"_given_{c}", c).alias(c) if c in fields else c for c in target.columns])


def split_by_id(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows without an id, to insert; rows with one, to upsert)."""
    return rows.filter(F.col("id").isNull()).drop("id"), rows.filter(F.col("id").isNotNull())


def key_violations(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; empty when a unique index could be built."""
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
