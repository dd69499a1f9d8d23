"""Calendar, worklists, contract windows and first-n reports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from tenorline.functions.trading_days import (
    ExchangeCalendar, closed_by, date_chunks, market_schedule, session_close,
)
from tenorline.operators.contracts import (
    atm_vintage, contract_sessions, contracts_to_ingest, nth_session, option_worklist,
)
from tenorline.operators.spot import attach_spot
from tenorline.operators.worklist import (
    missing_prices, missing_quotes, newest, oldest, rows_to_seed,
)
from tenorline.operators.merge import new_rows
from tenorline.schema import OPTION_KEY
from tenorline.workload.dates import AS_OF, DAYS_SQL, LONDON_CLOSED, LONDON_SHORT, RANGE
from tenorline.workload.registry import query
from tenorline.workload.views import Tables

RANGES_SQL = """
ranges as (select ticker, min(dt) as sd, max(dt) as ed from stock_quotes group by ticker)
"""


def ranges(t: Tables) -> DataFrame:
    """First and last stored day per ticker."""
    return t.stock_quotes.groupBy("ticker").agg(
        F.to_date(F.min("dt")).alias("sd"), F.to_date(F.max("dt")).alias("ed"))


@query("market_calendar", f"""
with {DAYS_SQL}, {RANGES_SQL}
select ticker, cast(d as varchar) as session, open_at as market_open, close_at as market_close
from ranges join days on d between sd and ed where is_session
""")
def market_calendar(t: Tables):
    return market_schedule(ranges(t), "sd", "ed").select(
        "ticker", "session", "market_open", "market_close")


def london(t: Tables) -> ExchangeCalendar:
    days = lambda names: t.spark.createDataFrame([(d,) for d in names], "day string")
    return ExchangeCalendar("Europe/London", 8 * 60, 16 * 60 + 30, days(LONDON_CLOSED),
                            days(LONDON_SHORT).withColumn("minute", F.lit(12 * 60 + 30)))


def _days(names) -> str:
    return ", ".join(f"date '{d}'" for d in names)


@query("market_calendar_london", f"""
with {RANGES_SQL}, days as (
  select cast(g as date) as d,
         cast(timezone('UTC', timezone('Europe/London', g + to_minutes(480))) as timestamp) as market_open,
         cast(timezone('UTC', timezone('Europe/London', g + to_minutes(
           case when cast(g as date) in ({_days(LONDON_SHORT)}) then 750 else 990 end))) as timestamp) as market_close
  from generate_series(timestamp '1994-12-20', timestamp '2001-12-31', interval 1 day) t(g)
  where extract(isodow from g) < 6 and cast(g as date) not in ({_days(LONDON_CLOSED)}))
select ticker, cast(d as varchar) as session, market_open, market_close from ranges join days on d between sd and ed
""")
def market_calendar_london(t: Tables):
    """Another exchange, whose closures and short days are tables."""
    return market_schedule(ranges(t), "sd", "ed", london(t)).select("ticker", "session", "market_open", "market_close")


@query("market_closes", f"""
with {DAYS_SQL}, {RANGES_SQL}
select ticker, close_at as dt from ranges join days on d between sd and ed where is_session
""")
def market_closes(t: Tables):
    return market_schedule(ranges(t), "sd", "ed").select(
        "ticker", F.col("market_close").alias("dt"))


@query("closed_sessions", f"""
with {DAYS_SQL}, {RANGES_SQL}
select ticker, close_at as dt from ranges join days on d between sd and ed
where is_session and close_at <= timestamp '1999-11-15 21:00:00'
""")
def closed_sessions(t: Tables):
    now = F.lit(datetime.combine(AS_OF, datetime.min.time()).replace(hour=21).isoformat(sep=" "))
    done = closed_by(market_schedule(ranges(t), "sd", "ed"), now.cast("timestamp"))
    return done.select("ticker", F.col("market_close").alias("dt"))


def stored_at_close(df: DataFrame) -> DataFrame:
    """Quotes carry the closing instant of their day."""
    return df.withColumn("dt", session_close(F.to_date("dt")))


@query("missing_stock", f"""
with {DAYS_SQL}, {RANGES_SQL}
select ticker, close_at as dt from ranges join days on d between sd and ed
where is_session and not exists (select 1 from stock_quotes s
                                 where s.ticker = ranges.ticker and s.dt = d and s.fetched)
""")
def missing_stock(t: Tables):
    return missing_prices(market_closes(t), stored_at_close(t.stock_quotes), ("ticker", "dt")).select(
        "ticker", "dt")


CONTRACT_CLOSES_SQL = f"""
{DAYS_SQL}, bounds as (
  select c.ticker, c.listed, max(d) as last_session
  from contracts c join days on d between c.exp_date - 9 and c.exp_date
  where is_session group by 1, 2),
expected as (
  select ticker, d, close_at from bounds join days on d >= listed and d < last_session
  where is_session)
"""


def contract_closes(t: Tables) -> DataFrame:
    return contract_sessions(t.contracts).select("ticker", session_close(F.col("session")).alias("dt"))


def waiting(t: Tables) -> DataFrame:
    return stored_at_close(t.option_quotes.select("id", "ticker", "dt", "fetched"))


@query("missing_option_faithful", f"""
with {CONTRACT_CLOSES_SQL}
select e.ticker, e.close_at as dt, q.id, q.fetched
from expected e left join option_quotes q
  on q.ticker = e.ticker and q.dt = e.d and not coalesce(q.fetched, false)
""", nullable={"id": "double", "fetched": "string"})
def missing_option_faithful(t: Tables):
    return missing_quotes(contract_closes(t), waiting(t), refetch=True).select(
        "ticker", "dt", "id", "fetched")


@query("missing_option", f"""
with {CONTRACT_CLOSES_SQL}
select e.ticker, e.close_at as dt, q.id, q.fetched
from expected e left join option_quotes q on q.ticker = e.ticker and q.dt = e.d
where not coalesce(q.fetched, false)
""", nullable={"id": "double", "fetched": "string"})
def missing_option(t: Tables):
    return missing_quotes(contract_closes(t), waiting(t)).select("ticker", "dt", "id", "fetched")


@query("contracts_to_ingest", """
select c.ticker, c.underlying_ticker, c.option_type, cast(c.strike as bigint) as strike,
       cast(c.exp_date as varchar) as exp_date, cast(min(s.dt) as varchar) as listed
from stock_quotes s join contracts c
  on c.underlying_ticker = s.ticker and c.listed <= s.dt and c.exp_date >= s.dt
 and c.exp_date <= s.dt + 40
 and c.strike in (cast(5 * round_even(s.close / 5, 0) as int) - 10,
                  cast(5 * round_even(s.close / 5, 0) as int) - 5)
where extract(isodow from c.exp_date) in (1, 5) group by 1, 2, 3, 4, 5
""")
def contracts_near_the_money(t: Tables):
    """The listing arrives on two days; two strikes below the close."""
    again = t.contracts.withColumn("listed", F.date_add("listed", 1))
    return contracts_to_ingest(t.stock_quotes, t.contracts.unionByName(again), below=10)


@query("attach_spot", """
select q.id, cast(q.dt as timestamp) as dt, q.underlying_ticker, s.close as spot
from option_quotes q left join stock_quotes s on s.dt = q.dt and s.ticker = q.underlying_ticker
""")
def spot(t: Tables):
    return attach_spot(t.option_quotes, t.stock_quotes).select(
        "id", "dt", "underlying_ticker", "spot")


@query("seed_stock_worklist", f"""
with {DAYS_SQL}, {RANGES_SQL}
select ticker, cast(d as timestamp) as dt, false as fetched
from ranges join days on d between sd and ed
where is_session and not exists (select 1 from stock_quotes s
                                 where s.ticker = ranges.ticker and s.dt = d)
""")
def seed_stock_worklist(t: Tables):
    sessions = market_schedule(ranges(t), "sd", "ed").select(
        "ticker", F.col("session").cast("timestamp").alias("dt"))
    return rows_to_seed(sessions, t.stock_quotes, ("ticker", "dt"))


@query("seed_option_worklist", """
select cast(s.dt as timestamp) as dt, c.ticker, c.underlying_ticker, c.option_type,
       cast(c.strike as bigint) as strike, cast(c.exp_date as varchar) as exp_date
from stock_quotes s join contracts c
  on c.underlying_ticker = s.ticker and c.listed <= s.dt and c.exp_date >= s.dt
 and c.exp_date <= s.dt + 70
 and c.strike between cast(trunc(s.close) as int) - 100 and cast(trunc(s.close) as int) + 99
where not exists (select 1 from option_quotes q where q.ticker = c.ticker and q.dt = s.dt)
""")
def seed_option_worklist(t: Tables):
    seeds = option_worklist(t.stock_quotes, t.contracts)
    return new_rows(t.option_quotes, seeds, OPTION_KEY, ("exp_date",)).select(
        "dt", "ticker", "underlying_ticker", "option_type", "strike", "exp_date")


@query("contract_sessions", f"""
with {DAYS_SQL}, bounds as (
  select c.ticker, c.listed, max(d) as last_session
  from contracts c join days on d between c.exp_date - 9 and c.exp_date
  where is_session group by 1, 2)
select ticker, cast(d as varchar) as session
from bounds join days on d >= listed and d < last_session where is_session
""")
def contract_session_rows(t: Tables):
    return contract_sessions(t.contracts).select("ticker", "session")


VINTAGES_SQL = """
vintages as (
  select distinct ticker, date_trunc('month', dt)::date as sd,
         date_trunc('month', dt)::date + (case when part = 1 then 100 else 72 end) as ed
  from stock_quotes, (values (1), (2)) p(part)),
days_in as (
  select v.ticker, v.sd, v.ed, s.dt, s.close,
         row_number() over (partition by v.ticker, v.sd, v.ed order by s.dt) as n
  from vintages v join stock_quotes s on s.ticker = v.ticker and s.dt between v.sd and v.ed),
at_money as (
  select a.ticker as underlying_ticker, a.sd, a.ed, round_even(a.close, 0) as atm, b.dt as day11
  from days_in a join days_in b
    on a.ticker = b.ticker and a.sd = b.sd and a.ed = b.ed and b.n = 11
  where a.n = 1),
chosen as (
  select m.underlying_ticker, m.sd, m.ed, m.day11, c.ticker as contract, c.option_type, c.strike,
         c.exp_date
  from at_money m join contracts c
    on c.underlying_ticker = m.underlying_ticker and c.strike = m.atm
   and c.listed <= m.sd and c.exp_date >= m.sd and c.exp_date <= m.sd + 60),
stored as (
  select ticker as contract, dt, case when fetched then close end as close from option_quotes),
unpriced as (
  select c.underlying_ticker, c.sd, c.ed, c.contract, c.option_type, c.strike, c.exp_date, s.dt
  from chosen c join stored s on s.contract = c.contract and s.dt between c.sd and c.ed
  where s.close is null or s.close = 0
  union all
  select c.underlying_ticker, c.sd, c.ed, c.contract, c.option_type, c.strike, c.exp_date, c.day11
  from chosen c where not exists (
    select 1 from stored s where s.contract = c.contract and s.dt = c.day11))
"""


def vintages(t: Tables) -> DataFrame:
    """Two vintages per ticker and month, with one start and different ends."""
    months = t.stock_quotes.select("ticker", F.trunc("dt", "MM").alias("sd")).distinct()
    return months.withColumn("ed", F.explode(F.array(F.date_add("sd", 100), F.date_add("sd", 72))))


def partly_priced(t: Tables) -> DataFrame:
    """Stored quotes, of which only the fetched ones have a price."""
    return t.option_quotes.withColumn("close", F.when(F.col("fetched"), F.col("close")))


@query("atm_vintage", f"""
with {VINTAGES_SQL}
select underlying_ticker, cast(sd as varchar) as sd, cast(ed as varchar) as ed, contract,
       option_type, cast(strike as bigint) as strike, cast(exp_date as varchar) as exp_date,
       cast(dt as timestamp) as dt from unpriced
""")
def atm_vintage_rows(t: Tables):
    return atm_vintage(vintages(t), t.stock_quotes, t.contracts, partly_priced(t)).select(
        "underlying_ticker", "sd", "ed", "contract", "option_type", "strike", "exp_date", "dt")


@query("nth_session", """
select ticker, cast(dt as timestamp) as dt, n from (
  select ticker, dt, cast(row_number() over (partition by ticker order by dt) as int) as n
  from (select distinct ticker, dt from stock_quotes) d) x where n = 11
""")
def nth_session_rows(t: Tables):
    return nth_session(t.stock_quotes, 11)


@query("date_chunks", f"""
with {RANGES_SQL}, starts as (
  select ticker, ed, cast(unnest(generate_series(cast(sd as timestamp), cast(ed as timestamp),
                                                 interval 20 days)) as date) as sd from ranges)
select ticker, cast(sd as varchar) as sd, cast(least(sd + 19, ed) as varchar) as ed from starts
""")
def date_chunk_rows(t: Tables):
    return date_chunks(ranges(t), 20).select("ticker", "sd", "ed")


@query("next_worklist_asc", """
select ticker, cast(dt as timestamp) as dt, close from stock_quotes
where not fetched order by dt, ticker limit 300
""")
def next_worklist_asc(t: Tables):
    return oldest(t.stock_quotes, ~F.col("fetched"), 300).select("ticker", "dt", "close")


@query("next_worklist_desc", """
select id, ticker, cast(dt as timestamp) as dt from option_quotes
where fetched is null and dt > date '1997-03-03' and dt < date '1997-09-29'
order by dt desc, ticker limit 100
""")
def next_worklist_desc(t: Tables):
    after, before = (F.lit(d).cast("timestamp") for d in RANGE)
    pending = F.col("fetched").isNull() & (F.col("dt") > after) & (F.col("dt") < before)
    return newest(t.option_quotes, pending, 100).select("id", "ticker", "dt")


@query("stock_days_after", """
select ticker, cast(dt as timestamp) as dt, close from stock_quotes
where ticker = 'U1' and dt > date '1997-03-03' order by dt limit 1000
""")
def stock_days_after(t: Tables):
    later = (F.col("ticker") == "U1") & (F.col("dt") > F.lit(RANGE[0]).cast("timestamp"))
    return oldest(t.stock_quotes, later, 1000).select("ticker", "dt", "close")
