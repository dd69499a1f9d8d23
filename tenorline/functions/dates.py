"""Expiry codes, week labels and day counts, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Weekly-expiry letters, Monday to Friday.
WEEKDAY_CODES = ("A", "B", "C", "D", "EW")


def week_of_month(d: Column) -> Column:
    """Week number inside the month, weeks starting on Sunday, as text."""
    days_before_first = F.dayofweek(F.trunc(d, "MM")) - 1
    return F.ceil((F.dayofmonth(d) + days_before_first) / 7).cast("int").cast("string")


def expiry_code(d: Column, strict: bool = False) -> Column:
    """Weekday letter plus week of month, e.g. ``EW4``.

    Weekends have no letter: null, or an error when ``strict``.
    """
    codes = F.array(*[F.lit(c) for c in WEEKDAY_CODES])
    pick = F.element_at if strict else F.try_element_at
    return F.concat(pick(codes, F.weekday(d) + 1), week_of_month(d))


def year_week(d: Column) -> Column:
    """``year-week`` with Monday weeks; days before the first Monday are week 00."""
    week = F.floor((F.dayofyear(d) + 6 - F.weekday(d)) / 7)
    return F.concat(F.year(d).cast("string"), F.lit("-"), F.lpad(week.cast("string"), 2, "0"))


def from_epoch_ms(c: Column) -> Column:
    return F.timestamp_millis(c.cast("long"))


def dte_calendar(exp_date: Column, dt: Column) -> Column:
    """Days to expiry by calendar date."""
    return F.datediff(exp_date, F.to_date(dt))


def dte_elapsed(exp_close: Column, dt: Column) -> Column:
    """Whole 24-hour periods between two instants (one less across a spring clock change)."""
    return F.floor((F.unix_micros(exp_close) - F.unix_micros(dt)) / F.lit(86_400_000_000)).cast("int")


def exp_weekday(exp_date: Column) -> Column:
    """Expiry weekday, Monday = 0."""
    return F.weekday(exp_date)
