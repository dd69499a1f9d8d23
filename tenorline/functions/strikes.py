"""Strike selection around a close price."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_to_base(x: Column, base: int = 5) -> Column:
    """Nearest multiple of ``base``, ties to the even multiple."""
    return (F.lit(base) * F.bround(x / F.lit(base))).cast("int")


def atm_round(close: Column) -> Column:
    """At-the-money strike: close to whole units, ties to even."""
    return F.bround(close, 0)


def near_strikes(close: Column, below: int = 5, step: int = 5) -> Column:
    """Strikes from ``below`` under the rounded close up to, not including, it."""
    centre = round_to_base(close, step)
    return F.sequence(centre - below, centre - 1, F.lit(step))


def near_the_close(strike: Column, close: Column, below: int = 5, step: int = 5) -> Column:
    """Membership in ``near_strikes`` as a predicate."""
    centre = round_to_base(close, step)
    return strike.between(centre - below, centre - 1) & ((strike - (centre - below)) % step == 0)


def ladder_bounds(close: Column, distance: int = 100) -> tuple[Column, Column]:
    """First and last whole strike of the ladder around the truncated close."""
    base = close.cast("int")
    return base - distance, base + distance - 1


def strike_ladder(close: Column, distance: int = 100) -> Column:
    low, high = ladder_bounds(close, distance)
    return F.sequence(low, high)


def on_ladder(strike: Column, close: Column, distance: int = 100) -> Column:
    """Membership in the ladder as a predicate, so no ladder need be exploded for a join."""
    low, high = ladder_bounds(close, distance)
    return strike.between(low, high) & (strike == F.floor(strike))


def with_option_types() -> Column:
    """One element per side; ``explode`` it for the strike x side grid."""
    return F.array(F.lit("put"), F.lit("call"))
