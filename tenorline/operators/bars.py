"""Price bars from single trades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tenorline.functions.trading_days import ZONE

#: Spans of a fixed length, which are counted in UTC.
FIXED = ("minute", "hour")
#: Spans of the calendar, which begin at midnight of the exchange.
CALENDAR = ("day", "week", "month", "quarter", "year")
_MONTHS = {"month": 1, "quarter": 3, "year": 12}


def bar_start(ts: Column, time_span: str, multiplier: int = 1, zone: str = ZONE) -> Column:
    """The instant at which the bar of ``ts`` begins.

    Days and longer spans begin at local midnight, weeks on Mondays, so a day of a clock
    change has 23 or 25 hours. Several days or weeks are counted from Monday, 5 January 1970,
    several months, quarters or years from January 1970.
    """
    if time_span in FIXED:
        return F.window(ts, f"{multiplier} {time_span}")["start"]
    if time_span not in CALENDAR:
        raise ValueError(f"no such time span: {time_span}")
    day = F.to_date(F.from_utc_timestamp(ts, zone))
    if time_span in _MONTHS:
        size = _MONTHS[time_span] * multiplier
        month = (F.year(day) - 1970) * 12 + F.month(day) - 1
        first = F.add_months(F.lit("1970-01-01").cast("date"), month - F.pmod(month, F.lit(size)))
    else:
        size = multiplier * (7 if time_span == "week" else 1)
        first = F.date_sub(day, F.pmod(F.unix_date(day) - 4, F.lit(size)))
    return F.to_utc_timestamp(first.cast("timestamp"), zone)


def aggregate_bars(ticks: DataFrame, time_span: str, multiplier: int = 1, *, ticker: str = "ticker",
                   ts: str = "ts", price: str = "price", size: str = "size",
                   tiebreak: str = "tick_id", zone: str = ZONE) -> DataFrame:
    """Volume, volume-weighted price, close and trade count per ``multiplier`` x ``time_span``,
    from minutes to years (``bar_start``).

    All aggregates combine map-side, so a hot ticker ships one row per bar and task.
    """
    weighted = F.sum(F.col(price) * F.col(size))
    return (
        ticks.groupBy(F.col(ticker).alias("ticker"), bar_start(F.col(ts), time_span, multiplier, zone).alias("dt"))
        .agg(
            F.sum(size).alias("volume"),
            F.try_divide(weighted, F.sum(size)).alias("volume_weighted_price"),
            F.max_by(price, F.struct(ts, tiebreak)).alias("close"),
            F.count(F.lit(1)).alias("transaction_number"),
        )
        .select("ticker", "dt", "volume", "volume_weighted_price", "close", "transaction_number")
    )
