"""Session calendars: New York by rule, any other exchange by its list of days.

New York sessions are decided by column expressions over a date, so that calendar needs no
join: explode a date range and filter. Valid from 1995 on; early closes and unscheduled
closures as known. ``ExchangeCalendar`` has closures and short days as tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

ZONE = "America/New_York"

# Full-day closures outside the yearly rules.
CLOSURES = (
    "2001-09-11", "2001-09-12", "2001-09-13", "2001-09-14",
    "2004-06-11", "2007-01-02", "2012-10-29", "2012-10-30",
    "2018-12-05", "2025-01-09",
)

# Unscheduled early closes, minutes after local midnight.
SHORT_DAYS = {
    "1996-01-08": 14 * 60,
    "1997-10-27": 15 * 60 + 30,
    "1997-12-26": 13 * 60,
    "1999-12-31": 13 * 60,
    "2003-12-26": 13 * 60,
    "2005-06-01": 15 * 60 + 56,
}

OPEN_MINUTE = 9 * 60 + 30
CLOSE_MINUTE = 16 * 60
EARLY_MINUTE = 13 * 60


def easter(year: Column) -> Column:
    """Gregorian Easter Sunday (Butcher's computus)."""
    century = F.floor(year / 100)
    leap_skip = F.floor(century / 4)
    correction = F.floor((century - F.floor((century + 8) / 25) + 1) / 3)
    epact = (19 * (year % 19) + century - leap_skip - correction + 15) % 30
    to_sunday = (32 + 2 * (century % 4) + 2 * F.floor((year % 100) / 4) - epact - year % 4) % 7
    shift = F.floor((year % 19 + 11 * epact + 22 * to_sunday) / 451)
    days_after_march_22 = epact + to_sunday - 7 * shift
    return F.date_add(F.make_date(year, F.lit(3), F.lit(22)), days_after_march_22.cast("int"))


def _observed(dom: Column, weekday: Column, day: int) -> Column:
    """A fixed-date holiday: Saturday moves to Friday, Sunday to Monday."""
    return (
        (dom == day)
        | ((dom == day - 1) & (weekday == 4))
        | ((dom == day + 1) & (weekday == 0))
    )


def is_holiday(d: Column) -> Column:
    y, m, dom, wd = F.year(d), F.month(d), F.dayofmonth(d), F.weekday(d)
    third_monday = (wd == 0) & dom.between(15, 21)
    by_month = (
        F.when(m == 1, (dom == 1) | ((dom == 2) & (wd == 0)) | (third_monday & (y >= 1998)))
        .when(m == 2, third_monday)
        .when(m.isin(3, 4), (wd == 4) & (F.date_add(d, 2) == easter(y)))
        .when(m == 5, (wd == 0) & (dom >= 25))
        .when(m == 6, _observed(dom, wd, 19) & (y >= 2022))
        .when(m == 7, _observed(dom, wd, 4))
        .when(m == 9, (wd == 0) & (dom <= 7))
        .when(m == 11, (wd == 3) & dom.between(22, 28))
        .when(m == 12, _observed(dom, wd, 25))
        .otherwise(F.lit(False))
    )
    return by_month | d.isin(*[F.lit(c).cast("date") for c in CLOSURES])


def _session_rule(d: Column) -> Column:
    return (F.weekday(d) < 5) & ~is_holiday(d)


def is_session(d: Column) -> Column:
    """Whether the date is a session.

    The rule names its date many times; as an array element the date is worked
    out once per row, even where the optimizer replaces ``d`` by its definition.
    """
    return F.exists(F.array(d), _session_rule)


def _close_minute(d: Column) -> Column:
    y, m, dom, wd = F.year(d), F.month(d), F.dayofmonth(d), F.weekday(d)
    before_july_4 = (m == 7) & (dom == 3) & (wd.isin(0, 1, 3) | ((wd == 2) & (y >= 2013)))
    after_july_4 = (m == 7) & (dom == 5) & (wd == 4) & (y < 2013)
    after_thanksgiving = (m == 11) & (wd == 4) & dom.between(23, 29)
    christmas_eve = (m == 12) & (dom == 24) & (wd < 4)
    minute = F.when(
        before_july_4 | after_july_4 | after_thanksgiving | christmas_eve, EARLY_MINUTE
    )
    for day, at in SHORT_DAYS.items():
        minute = minute.when(d == F.lit(day).cast("date"), at)
    return minute.otherwise(CLOSE_MINUTE)


def _instant(d: Column, minute: Column, zone: str = ZONE) -> Column:
    local = F.timestamp_seconds(F.unix_date(d).cast("long") * 86_400 + minute * 60)
    return F.to_utc_timestamp(local, zone)


def session_open(d: Column) -> Column:
    return _instant(d, F.lit(OPEN_MINUTE))


def session_close(d: Column) -> Column:
    return _instant(d, _close_minute(d))


def last_session_on_or_before(d: Column) -> Column:
    """The date itself if it is a session, else the nearest before it.

    The longest closure in the rules spans six days, so eight days always hold a session.
    """
    earlier = F.sequence(F.date_sub(d, 8), F.date_sub(d, 1))
    return F.when(_session_rule(d), d).otherwise(F.array_max(F.filter(earlier, _session_rule)))


@dataclass(frozen=True)
class ExchangeCalendar:
    """An exchange whose calendar is data: ``closures`` (day) are dates without a session besides the
    ``weekend`` (Monday = 0), ``short_days`` (day, minute) close at another minute after local
    midnight. Both hold one row per such date, a few hundred in all; repeated rows count once.
    """

    zone: str
    open_minute: int
    close_minute: int
    closures: DataFrame
    short_days: DataFrame
    weekend: tuple[int, ...] = (5, 6)

    def sessions(self, days: DataFrame, name: str) -> DataFrame:
        """The rows of ``days`` whose date in column ``name`` is a session."""
        closed = self.closures.select(F.col("day").cast("date").alias(name))
        return days.filter(~F.weekday(name).isin(*self.weekend)).join(closed, name, "left_anti").select(*days.columns)

    def with_instants(self, sessions: DataFrame, name: str) -> DataFrame:
        short = self.short_days.groupBy(F.col("day").cast("date").alias(name)).agg(F.min("minute").alias("_minute"))
        minute = F.coalesce("_minute", F.lit(self.close_minute))
        return sessions.join(short, name, "left").select(
            *sessions.columns, _instant(F.col(name), F.lit(self.open_minute), self.zone).alias("market_open"),
            _instant(F.col(name), minute, self.zone).alias("market_close"))


def sessions_in(ranges: DataFrame, start: str, end: str, name: str = "session",
                calendar: ExchangeCalendar | None = None) -> DataFrame:
    """Each row of ``ranges`` repeated for its sessions, both ends included.

    By the New York rule a narrow explode-and-filter: no shuffle, no join, no driver loop.
    With a ``calendar`` the days also meet its closures.
    """
    ok = ranges.filter(F.col(start) <= F.col(end))
    days = ok.withColumn(name, F.explode(F.sequence(F.to_date(start), F.to_date(end))))
    return calendar.sessions(days, name) if calendar else days.filter(_session_rule(F.col(name)))


def market_schedule(ranges: DataFrame, start: str, end: str, calendar: ExchangeCalendar | None = None) -> DataFrame:
    """``sessions_in`` plus the opening and closing instants."""
    sessions = sessions_in(ranges, start, end, calendar=calendar)
    if calendar:
        return calendar.with_instants(sessions, "session")
    return sessions.withColumns({
        "market_open": session_open(F.col("session")),
        "market_close": session_close(F.col("session")),
    })


def closed_by(schedule: DataFrame, as_of: Column) -> DataFrame:
    """Sessions whose close is not in the future of ``as_of``."""
    return schedule.filter(F.col("market_close") <= as_of)


def date_chunks(ranges: DataFrame, size: int, start: str = "sd", end: str = "ed") -> DataFrame:
    """Each date range cut into runs of ``size`` calendar days, the last one shorter."""
    first = F.sequence(F.col(start), F.col(end), F.expr(f"interval {int(size)} days"))
    return (
        ranges.filter(F.col(start) <= F.col(end))
        .withColumn(start, F.explode(first))
        .withColumn(end, F.least(F.date_add(start, size - 1), F.col(end)))
    )
