"""Pairs of option quotes: calendars, verticals, diagonals, straddles.

A quote's grain is (day, underlying, option type, strike, days to expiry); a
pairing fixes how the partner's grain differs from the row's own. The shift is
always part of an equi-key, never a residual predicate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tenorline.sources.tables import day_of

GRAIN = ("underlying_ticker", "option_type", "strike", "dte")
TOO_MANY = "more than one quote matches"


def _complete(quotes: DataFrame) -> DataFrame:
    """Rows with a null in the grain never pair."""
    return quotes.filter(" and ".join(f"{c} is not null" for c in ("dt", *GRAIN)))


def _exactly_one(count: Column) -> Column:
    """True for one match, false for none, an error for more."""
    return F.when(count > 1, F.raise_error(F.lit(TOO_MANY))).otherwise(count == 1)


def _fields(columns: Sequence[str], suffix: str) -> list[Column]:
    return [F.col(c).alias(f"{c}{suffix}") for c in columns]


def match_legs(quotes: DataFrame, *, dte_diff: int = 0, strike_diff: float = 0,
               invert: bool = False, carry: Sequence[str] = ("id", "ticker"),
               suffixes: tuple[str, str] = ("_row", "_match"),
               unique_grain: bool = False, strict: bool = True) -> DataFrame:
    """Every quote next to the one quote of its day and underlying that matches it.

    The match has ``strike = row.strike + strike_diff``, ``row.dte - match.dte =
    dte_diff`` and the same option type, or the other one when ``invert``.

    Unless the caller vouches that the grain is unique, candidates are first
    combined to one row per grain with their count, so duplicates cannot
    multiply pairs: a row meeting more than one candidate raises, or with
    ``strict=False`` gets the least candidate and its count in ``matches``.
    Hot rows on the probing side are split by AQE, as both sides enter the join
    straight from a shuffle.
    """
    base = _complete(quotes)
    day = day_of(quotes)
    side = F.col("option_type")
    wanted = F.when(side == "put", "call").otherwise("put") if invert else side
    rows = base.select(
        day.alias("_day"), F.col("underlying_ticker").alias("_underlying"),
        wanted.alias("_type"), F.col("strike").alias("_strike"), F.col("dte").alias("_dte"),
        F.col("dt"), *_fields(carry, suffixes[0]),
    )
    keys = ["_day", "_underlying", "_type", "_strike", "_dte"]
    grain = [
        day.alias("_day"), F.col("underlying_ticker").alias("_underlying"),
        side.alias("_type"), F.col("strike").alias("_strike"), F.col("dte").alias("_dte"),
    ]
    if unique_grain:
        candidates = base.select(*grain, *_fields(carry, suffixes[1]))
    else:
        candidates = (
            base.groupBy(*grain)
            .agg(F.count(F.lit(1)).alias("matches"),
                 F.min(F.struct(*_fields(carry, suffixes[1]))).alias("_candidate"))
        )
    candidates = candidates.withColumns({
        "_strike": F.col("_strike") - F.lit(strike_diff),
        "_dte": F.col("_dte") + F.lit(dte_diff),
    })
    pairs = rows.join(candidates, keys)
    if unique_grain:
        return pairs.drop(*keys)
    if strict:
        # Only candidates that are met may raise. The partition id makes the condition
        # non-deterministic, which keeps the optimizer from moving it below the join.
        after_join = F.spark_partition_id() >= 0
        pairs = pairs.filter(F.when(after_join, _exactly_one(F.col("matches")))).drop("matches")
    return pairs.select(*[c for c in pairs.columns if c not in (*keys, "_candidate")],
                        "_candidate.*")


def spread_label(gap: Column, underlying: Column) -> Column:
    return F.concat(gap.cast("string"), F.lit("d_calendar_"), F.lower(underlying))


def time_spreads(quotes: DataFrame, dte_diff: int, *, unique_grain: bool = False,
                 carry: Sequence[str] = ("id", "ticker"),
                 front_weekday: int | None = None,
                 back_weekday: int | None = None) -> DataFrame:
    """Calendar spreads whose legs expire ``dte_diff`` days apart, over all days at once.

    The front (near) leg is ``_f``, the back (far) leg ``_b``. The expiry
    weekdays are only enforced when given.
    """
    wanted = [*carry, "underlying_ticker"]
    if front_weekday is not None or back_weekday is not None:
        wanted.append("exp_date")
    legs = list(dict.fromkeys(wanted))
    if unique_grain:
        pairs = chain_pairs(quotes, -dte_diff, legs, ("_b", "_f"))
    else:
        pairs = match_legs(quotes, dte_diff=dte_diff, carry=legs, suffixes=("_b", "_f"))
    for weekday, leg in ((front_weekday, "_f"), (back_weekday, "_b")):
        if weekday is not None:
            pairs = pairs.filter(F.weekday(f"exp_date{leg}") == weekday)
    label = spread_label(F.lit(dte_diff), F.col("underlying_ticker_f"))
    return pairs.select("dt", *[f"{c}{s}" for s in ("_f", "_b") for c in carry],
                        label.alias("desc"))


def _chain(quotes: DataFrame, carry: Sequence[str]) -> tuple[DataFrame, WindowSpec]:
    """Quotes as (chain key, dte, ``_row``) and the window over one (day, underlying,
    strike, type) by days to expiry. ``_row`` holds what is carried, once, for the
    row itself as well as for its partners.
    """
    rows = _complete(quotes).select(
        day_of(quotes).alias("_day"), "underlying_ticker", "strike", "option_type",
        F.col("dte").cast("int").alias("dte"),
        F.struct("dt", *[F.col(c).alias(f"c_{c}") for c in carry]).alias("_row"),
    )
    return rows, Window.partitionBy(
        "_day", "underlying_ticker", "strike", "option_type").orderBy("dte")


def _carried(row: str, carry: Sequence[str], suffix: str) -> list[Column]:
    return [F.col(f"{row}.c_{c}").alias(f"{c}{suffix}") for c in carry]


def _partner(chain: WindowSpec, shift: int) -> tuple[Column, Column]:
    """Count and first of the rows exactly ``shift`` days further along the chain."""
    there = chain.rangeBetween(shift, shift)
    return F.count(F.lit(1)).over(there), F.first("_row").over(there)


def chain_pairs(quotes: DataFrame, shift: int, carry: Sequence[str],
                suffixes: tuple[str, str]) -> DataFrame:
    """``match_legs`` along a chain: each row next to the one ``shift`` days later expiring.

    One shuffle instead of a self-join, for quotes whose grain is unique: a chain
    then holds one row per expiry, so its size is bounded by the listed
    expiries. A row that meets several partners still raises.
    """
    rows, chain = _chain(quotes, carry)
    count, partner = _partner(chain, shift)
    return (
        rows.select("_row", count.alias("_n"), partner.alias("_partner"))
        .filter(_exactly_one(F.col("_n")))
        .select("_row.dt", *_carried("_row", carry, suffixes[0]),
                *_carried("_partner", carry, suffixes[1]))
    )


def doubled_grains(quotes: DataFrame) -> DataFrame:
    """Grains that several quotes of a day share, with their count, and so no pair can use."""
    return (
        _complete(quotes).groupBy(day_of(quotes).alias("day"), *GRAIN)
        .agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    )


def chain_spreads(quotes: DataFrame, gaps: Sequence[int], carry: Sequence[str] = ("id", "ticker"),
                  strict: bool = True) -> DataFrame:
    """``time_spreads`` for several gaps in one shuffle, where the grain is unique.

    A row that meets several partners raises; with ``strict=False`` pairs of which either
    grain is doubled are left out (``doubled_grains`` lists them) and the rest remains.
    """
    rows, chain = _chain(quotes, carry)
    alone = F.lit(True) if strict else F.count(F.lit(1)).over(chain.rangeBetween(0, 0)) == 1
    one = _exactly_one(F.col("_leg.n")) if strict else F.col("_leg.n") == 1
    partners: list[Column] = []
    for gap in gaps:
        count, front = _partner(chain, -gap)
        partners += [count.alias(f"_n_{gap}"), front.alias(f"_front_{gap}")]
    any_partner = " + ".join(f"_n_{gap}" for gap in gaps)
    legs = F.explode(F.array(*[
        F.struct(F.lit(gap).alias("gap"), F.col(f"_n_{gap}").alias("n"),
                 F.col(f"_front_{gap}").alias("front"))
        for gap in gaps
    ]))
    paired = (
        rows.select("underlying_ticker", "_row", alone.alias("_alone"), *partners)
        .filter(f"_alone and {any_partner} > 0")
        .select("underlying_ticker", "_row", legs.alias("_leg"))
        .filter(one)
    )
    label = spread_label(F.col("_leg.gap"), F.col("underlying_ticker"))
    front, back = _carried("_leg.front", carry, "_f"), _carried("_row", carry, "_b")
    return paired.select(F.col("_leg.front.dt").alias("dt"), *front, *back, label.alias("desc"))


def friday_monday(quotes: DataFrame, **options) -> DataFrame:
    return time_spreads(quotes, 3, **options)


def friday_friday(quotes: DataFrame, **options) -> DataFrame:
    return time_spreads(quotes, 7, **options)


def monday_friday(quotes: DataFrame, **options) -> DataFrame:
    return time_spreads(quotes, 4, **options)


def wide_pairs(samples: DataFrame, gap: int, label: str, carry: Sequence[str],
               unique_grain: bool = False) -> DataFrame:
    """Front rows next to the back row ``gap`` days further out, all columns twice."""
    if unique_grain:
        pairs = chain_pairs(samples, gap, carry, ("_f", "_b"))
    else:
        pairs = match_legs(samples, dte_diff=-gap, carry=carry, suffixes=("_f", "_b"))
    return pairs.withColumn("pair_desc", F.lit(label))


def friday_monday_wide(samples: DataFrame, carry: Sequence[str], **options) -> DataFrame:
    return wide_pairs(samples, 3, "fm3dte_calendar", carry, **options)


def friday_friday_wide(samples: DataFrame, carry: Sequence[str], **options) -> DataFrame:
    return wide_pairs(samples, 7, "ff7dte_calendar", carry, **options)
