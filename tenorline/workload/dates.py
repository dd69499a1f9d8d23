"""Fixed dates the checked queries ask for."""

from datetime import date

SAMPLE_DAY = date(1998, 6, 1)
RANGE = (date(1997, 3, 3), date(1997, 9, 29))
AS_OF = date(1999, 11, 15)

# Full-day New York closures in the years of the test tables, listed
# one by one so that the rules in the library are checked against a plain calendar.
CLOSED_SQL = "(values " + ", ".join(f"(date '{d}')" for d in """
1994-12-26
1995-01-02 1995-02-20 1995-04-14 1995-05-29 1995-07-04 1995-09-04 1995-11-23 1995-12-25
1996-01-01 1996-02-19 1996-04-05 1996-05-27 1996-07-04 1996-09-02 1996-11-28 1996-12-25
1997-01-01 1997-02-17 1997-03-28 1997-05-26 1997-07-04 1997-09-01 1997-11-27 1997-12-25
1998-01-01 1998-01-19 1998-02-16 1998-04-10 1998-05-25 1998-07-03 1998-09-07 1998-11-26
1998-12-25
1999-01-01 1999-01-18 1999-02-15 1999-04-02 1999-05-31 1999-07-05 1999-09-06 1999-11-25
1999-12-24
2000-01-17 2000-02-21 2000-04-21 2000-05-29 2000-07-04 2000-09-04 2000-11-23 2000-12-25
2001-01-01 2001-01-15 2001-02-19 2001-04-13 2001-05-28 2001-07-04 2001-09-03
2001-09-11 2001-09-12 2001-09-13 2001-09-14 2001-11-22 2001-12-25
""".split()) + ")"

# Early closes of the same years, minutes after local midnight.
SHORT_SQL = "(values " + ", ".join(
    f"(date '{d}', {m})" for d, m in (
        ("1995-07-03", 780), ("1995-11-24", 780), ("1996-01-08", 840), ("1996-07-05", 780),
        ("1996-11-29", 780), ("1996-12-24", 780), ("1997-07-03", 780), ("1997-10-27", 930),
        ("1997-11-28", 780), ("1997-12-24", 780), ("1997-12-26", 780), ("1998-11-27", 780),
        ("1998-12-24", 780), ("1999-11-26", 780), ("1999-12-31", 780), ("2000-07-03", 780),
        ("2000-11-24", 780), ("2001-07-03", 780), ("2001-11-23", 780), ("2001-12-24", 780),
    )) + ")"

# London bank holidays of the same years, and days that close at 12:30.
LONDON_CLOSED = """
1994-12-26 1994-12-27
1995-01-02 1995-04-14 1995-04-17 1995-05-08 1995-05-29 1995-08-28 1995-12-25 1995-12-26
1996-01-01 1996-04-05 1996-04-08 1996-05-06 1996-05-27 1996-08-26 1996-12-25 1996-12-26
1997-01-01 1997-03-28 1997-03-31 1997-05-05 1997-05-26 1997-08-25 1997-12-25 1997-12-26
1998-01-01 1998-04-10 1998-04-13 1998-05-04 1998-05-25 1998-08-31 1998-12-25 1998-12-28
1999-01-01 1999-04-02 1999-04-05 1999-05-03 1999-05-31 1999-08-30 1999-12-27 1999-12-28 1999-12-31
2000-01-03 2000-04-21 2000-04-24 2000-05-01 2000-05-29 2000-08-28 2000-12-25 2000-12-26
2001-01-01 2001-04-13 2001-04-16 2001-05-07 2001-05-28 2001-08-27 2001-12-25 2001-12-26
""".split()
LONDON_SHORT = "1996-12-24 1996-12-31 1997-12-24 1997-12-31 1998-12-24 1998-12-31 1999-12-24 2001-12-24".split()

# Every day of the tables' years: session or not, and its closing instant in UTC.
DAYS_SQL = f"""
days as (
  select cast(g as date) as d,
         extract(isodow from g) < 6 and c.col0 is null as is_session,
         cast(timezone('UTC', timezone('America/New_York',
           g + to_minutes(cast(coalesce(s.col1, 960) as int)))) as timestamp) as close_at,
         cast(timezone('UTC', timezone('America/New_York',
           g + to_minutes(570))) as timestamp) as open_at
  from generate_series(timestamp '1994-12-20', timestamp '2001-12-31', interval 1 day) t(g)
  left join {CLOSED_SQL} c on c.col0 = cast(g as date)
  left join {SHORT_SQL} s on s.col0 = cast(g as date))
"""
