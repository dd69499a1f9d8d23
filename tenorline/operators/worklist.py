"""Which quotes should exist but are not stored yet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

KEY = ("dt", "ticker")


def _keys(quotes: DataFrame, key: Sequence[str]) -> DataFrame:
    """Distinct keys, combined before the shuffle, so a repeated key cannot pile up."""
    return quotes.select(*key).distinct()


def missing_prices(expected: DataFrame, stored: DataFrame,
                   key: Sequence[str] = KEY) -> DataFrame:
    """Expected quotes without a fetched row."""
    return expected.join(_keys(stored.filter("fetched"), key), list(key), "left_anti")


def missing_quotes(expected: DataFrame, stored: DataFrame, *, refetch: bool = False,
                   key: Sequence[str] = KEY) -> DataFrame:
    """Expected quotes with the unfetched row that waits for them, or nulls.

    With ``refetch`` sessions whose quote is already fetched come back as well,
    with nulls. ``stored`` is unique on the key, so one join tells all states
    apart.
    """
    key = list(key)
    done = F.coalesce(F.col("fetched"), F.lit(False))
    joined = expected.join(stored, key, "left")
    if not refetch:
        return joined.filter(~done)
    extra = [c for c in stored.columns if c not in key]
    return joined.withColumns({c: F.when(~done, F.col(c)) for c in extra})


def rows_to_seed(expected: DataFrame, stored: DataFrame,
                 key: Sequence[str] = KEY) -> DataFrame:
    """Expected quotes with no stored row at all, as empty rows to insert."""
    absent = expected.join(_keys(stored, key), list(key), "left_anti")
    return absent.withColumn("fetched", F.lit(False))


def for_tickers(quotes: DataFrame, tickers: DataFrame) -> DataFrame:
    """IN-list of any length as a semi-join."""
    return quotes.join(tickers.select("ticker"), "ticker", "left_semi")


def oldest(quotes: DataFrame, condition: Column, limit: int | None = None) -> DataFrame:
    """All that meet the condition, or the first ``limit`` of them by day."""
    found = quotes.filter(condition)
    return found if limit is None else found.orderBy("dt", "ticker").limit(limit)


def newest(quotes: DataFrame, condition: Column, limit: int | None = None) -> DataFrame:
    found = quotes.filter(condition)
    return found if limit is None else found.orderBy(F.desc("dt"), "ticker").limit(limit)


def fetch_state(fetched: Column) -> Column:
    return F.when(fetched.isNull(), "unknown").when(fetched, "fetched").otherwise("pending")
