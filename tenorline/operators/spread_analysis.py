"""Volatility and price differences of calendar spreads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tenorline.operators.structures import chain_pairs
from tenorline.sources.tables import day_of

LEG_COLUMNS = ("id", "ticker", "iv", "close", "exp_date", "strike", "dte", "delta", "option_type")


def _worth_trading(dte: Column, delta: Column, side: Column) -> Column:
    return (dte > 10) & (delta > 0.4) & (delta < 0.6) & (side == "call")


def _measures(f: str, b: str) -> list[Column]:
    def col(leg: str, name: str) -> Column:
        return F.col(leg.format(name))

    return [
        col(b, "id").alias("id_b"), col(b, "iv").alias("biv"),
        col(f, "id").alias("id_f"), col(f, "iv").alias("fiv"),
        (col(f, "iv") - col(b, "iv")).alias("ivdiff"),
        F.to_date("dt").alias("dt"),
        col(f, "exp_date").alias("exp_date_f"), col(b, "exp_date").alias("exp_date_b"),
        (col(b, "close") - col(f, "close")).alias("pricediff"),
        col(f, "delta").alias("delta_f"), col(f, "strike").alias("strike_f"),
    ]


def analyse_stored(spreads: DataFrame, quotes: DataFrame) -> DataFrame:
    """Stored spreads joined to both legs by the quotes' key (dt, ticker).

    The front leg comes first: its predicate reaches the quote scan and shrinks
    everything that follows. The day is part of both keys, so that a stored table
    is read only where spreads have days; the key is unique, so none is hot.
    """
    keyed = quotes.select(day_of(quotes).alias("day"), "dt", *LEG_COLUMNS)
    front = keyed.select(*[F.col(c).alias(f"f_{c}") for c in keyed.columns]).filter(
        _worth_trading(F.col("f_dte"), F.col("f_delta"), F.col("f_option_type")))
    back = keyed.select(*[F.col(c).alias(f"b_{c}") for c in keyed.columns])

    def same(leg: str) -> Column:
        return ((F.col("day") == F.col(f"{leg}_day")) & (F.col("dt") == F.col(f"{leg}_dt"))
                & (F.col(f"ticker_{leg}") == F.col(f"{leg}_ticker")))

    return (
        spreads.select(day_of(spreads).alias("day"), "dt", "ticker_f", "ticker_b")
        .join(front, same("f")).join(back, same("b"))
        .select(*_measures("f_{}", "b_{}"))
    )


def analyse_chains(quotes: DataFrame, gap: int) -> DataFrame:
    """The same measures straight from the quotes: pairing carries the legs' columns,
    so one shuffle by chain replaces the spread table and both id joins.

    Both legs share the option type and a back leg expires after its front, so
    these two conditions already hold for every row that can take part and are
    applied before the shuffle. The grain of ``quotes`` must be unique.
    """
    eligible = quotes.filter((F.col("option_type") == "call") & (F.col("dte") > 10))
    pairs = chain_pairs(eligible, -gap, LEG_COLUMNS, ("_b", "_f"))
    kept = pairs.filter(
        _worth_trading(F.col("dte_f"), F.col("delta_f"), F.col("option_type_f")))
    return kept.select(*_measures("{}_f", "{}_b"))
