"""Relative-value volatility from sampled quotes, all days and underlyings in one plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from tenorline.functions import symbols
from tenorline.functions.dates import expiry_code, year_week
from tenorline.functions.legs import back_minus_front, mid_and_width
from tenorline.operators.filters import delta_band, universe
from tenorline.operators.snapshot import last_hour, last_per_key
from tenorline.operators.structures import wide_pairs
from tenorline.sources.raw_samples import typed_samples

# Names of the sample layout's columns and of the summary's.
SNAPSHOT_COLUMNS = (
    "ask", "bid", "strike", "call_put", "delta", "theta", "lastTradingDay", "quoteTimeInLong",
    "daysToExpiration", "volatility", "lastTradingDayDes", "lastTradingDayWeekNumber",
)

MEASURED = ("ask", "bid", "delta", "theta", "lastTradingDay", "quoteTimeInLong",
            "daysToExpiration", "volatility")

SUMMARY_COLUMNS = ("lastTradingDayWeekNumber_f", "mid_diff", "volatility_diff", "delta_diff",
                   "delta_f", "daysToExpiration_f")


@dataclass(frozen=True)
class Selection:
    """Front legs of interest and the delta that counts as at the money."""

    code: str = "EW1"
    side: str = "p"
    low: float = -0.8
    high: float = -0.1
    target: float = -0.7


def last_hour_snapshot(samples: DataFrame, hour: int | None = None) -> DataFrame:
    """Last quote per symbol and day of the hour before the close (or from a literal UTC
    ``hour`` on). ``samples`` come from ``typed_samples``.

    Underlying, strike and side follow from the symbol and the labels from the
    trading day, so only measured columns are aggregated; the code keeps the last
    trading day that has one. The symbol's fields are read from an aggregate of
    it: conditions on them then apply to symbols, not to every sample.
    """
    late = last_hour(samples, "sampleTimeInLong", hour)
    dated = late.withColumns({
        "day": F.to_date("sampleTimeInLong"),
        "_coded_day": F.when(F.col("lastTradingDayDes").isNotNull(), F.col("lastTradingDay")),
    })
    order = ("sampleTimeInLong", "quoteTimeInLong", "tradeTimeInLong")
    last = last_per_key(dated, ("day", "symbol"), (*MEASURED, "_coded_day"), order,
                        F.max("symbol").alias("_symbol"))
    symbol = F.col("_symbol")
    return last.withColumns({
        "underlying": symbols.underlying(symbol),
        "strike": symbols.strike(symbol),
        "call_put": symbols.call_put(symbol),
        "lastTradingDayDes": expiry_code(F.to_date("_coded_day")),
        "lastTradingDayWeekNumber": year_week(F.to_date("lastTradingDay")),
    }).select("day", "underlying", "symbol", *SNAPSHOT_COLUMNS)


def paired_snapshot(snapshot: DataFrame, gap: int = 3,
                    label: str = "fm3dte_calendar") -> DataFrame:
    """Front and back rows side by side with their differences.

    The snapshot has one row per symbol and day, so pairing runs along chains.
    """
    grain = snapshot.withColumns({
        "dt": F.col("day"), "underlying_ticker": F.col("underlying"),
        "option_type": F.when(F.col("call_put") == "c", "call")
        .when(F.col("call_put") == "p", "put"),
        "dte": F.col("daysToExpiration"),
    })
    carry = ("underlying", "symbol", *SNAPSHOT_COLUMNS)
    pairs = wide_pairs(grain, gap, label, carry, unique_grain=True)
    return back_minus_front(mid_and_width(pairs.withColumnRenamed("dt", "day")),
                            ("volatility", "delta", "theta"))


def band_rows(pairs: DataFrame, pick: Selection) -> DataFrame:
    """Pairs of one side inside the delta band."""
    return pairs.filter(F.col("call_put_f") == pick.side).filter(
        delta_band(F.col("delta_f"), pick.low, pick.high))


def atm_summary(pairs: DataFrame, pick: Selection = Selection()) -> DataFrame:
    """Rows at the ATM strike of their day and underlying, over all front expiries.

    The strike is picked among the rows with the front code. Both steps share
    one window over (day, underlying), whose rows are bounded by the contracts
    listed on one underlying.
    """
    coded = F.col("lastTradingDayDes_f") == pick.code
    distance = F.abs(F.col("delta_f") - F.lit(pick.target))
    nearest = F.min_by("strike_f", F.when(coded, F.struct(distance, F.col("strike_f"))))
    group = Window.partitionBy("day", "underlying_f")
    picked = band_rows(pairs, pick).withColumn("_atm", nearest.over(group))
    return picked.filter(F.col("strike_f") == F.col("_atm")).drop("_atm")


def relative_value(raw: DataFrame, pick: Selection = Selection(), **chosen) -> DataFrame:
    """Raw sample rows to the summary table; ``chosen`` are the bounds of ``universe``."""
    samples = universe(typed_samples(raw), **chosen)
    pairs = paired_snapshot(last_hour_snapshot(samples))
    return atm_summary(pairs, pick).select("day", "underlying_f", "strike_f", *SUMMARY_COLUMNS)
