"""Last quote per symbol and the at-the-money pick."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tenorline.functions.trading_days import session_close


def last_per_key(samples: DataFrame, key: Sequence[str], columns: Sequence[str],
                 order: Sequence[str], *others: Column) -> DataFrame:
    """Last non-null value of each column in time order.

    ``order`` must be total inside a key. Each column keeps its own latest
    non-null value, so a row of the result may mix several samples. Values are
    combined map-side; a hot symbol ships one row per task. ``others`` are
    further aggregates.
    """
    at = F.struct(*order)
    return samples.groupBy(*key).agg(*[
        F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in columns
    ], *others)


def last_hour(samples: DataFrame, sample_ts: str = "sample_ts", hour: int | None = None) -> DataFrame:
    """Samples of the hour before their session's close, which moves with daylight saving
    time and early closes; or, given a literal ``hour``, from that UTC hour to midnight.
    """
    if hour is not None:
        return samples.filter(F.hour(sample_ts) >= hour)
    close = session_close(F.to_date(sample_ts))
    return samples.filter(F.col(sample_ts).between(close - F.expr("interval 1 hour"), close))


def nearest_strike(strike: str, delta: str, target: float) -> Column:
    """Strike whose delta is closest to ``target``; the lowest strike on ties."""
    distance = F.abs(F.col(delta) - F.lit(target))
    return F.min_by(strike, F.struct(distance, F.col(strike)))


def atm_strike(quotes: DataFrame, by: Sequence[str], target: float, strike: str = "strike",
               delta: str = "delta", name: str = "atm_strike") -> DataFrame:
    return quotes.groupBy(*by).agg(nearest_strike(strike, delta, target).alias(name))


def rows_at_strike(rows: DataFrame, atm: DataFrame, by: Sequence[str],
                   strike: str = "strike", name: str = "atm_strike") -> DataFrame:
    """Rows of ``rows`` whose strike is their group's ATM strike.

    The strike is part of the key, so the join spreads over strikes even where
    one group holds most rows.
    """
    picks = atm.select(*by, F.col(name).alias(strike))
    return rows.join(picks, [*by, strike], "left_semi")


def atm_position(quotes: DataFrame, by: Sequence[str], target: float, strike: str = "strike",
                 delta: str = "delta") -> DataFrame:
    """ATM strike and its 0-based position among the group's rows by strike, ascending.

    Rows first collapse to one per strike; the position is then a conditional
    sum over them, so no group is sorted or gathered in one place.
    """
    by = list(by)
    per_strike = quotes.groupBy(*by, F.col(strike).alias("_strike")).agg(
        F.min(F.abs(F.col(delta) - F.lit(target))).alias("_distance"),
        F.count(F.lit(1)).alias("_rows"),
    )
    atm = per_strike.groupBy(*by).agg(
        F.min_by("_strike", F.struct("_distance", "_strike")).alias("atm_strike"))
    placed = per_strike.join(atm, by)
    below = F.when(F.col("_strike") < F.col("atm_strike"), F.col("_rows")).otherwise(0)
    return placed.groupBy(*by, "atm_strike").agg(F.sum(below).alias("position"))


def metrics_by_week(spreads: DataFrame, week: Column, dte: Column, delta: Column,
                    measures: Sequence[str], levels: Sequence[int] = (30, 40, 50, 60, 70)) -> DataFrame:
    """Mean differences by expiry week, days to expiry and delta level.

    A row belongs to the level its absolute delta, in percent, rounds to.
    """
    level = (F.round(F.abs(delta) * 10).cast("int") * 10).alias("delta_level")
    return (
        spreads.select(week.alias("week"), dte.alias("dte"), level, *measures)
        .filter(F.col("delta_level").isin(list(levels)))
        .groupBy("week", "dte", "delta_level")
        .agg(F.count(F.lit(1)).alias("n"), *[F.avg(m).alias(f"avg_{m}") for m in measures])
    )
