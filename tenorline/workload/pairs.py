"""Structures, spread analysis and at-the-money selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from tenorline.functions.black_scholes import Terms, with_greeks, year_fraction
from tenorline.functions.dates import year_week
from tenorline.functions.legs import back_minus_front
from tenorline.operators.filters import delta_band
from tenorline.operators.snapshot import (
    atm_position, atm_strike, last_hour, last_per_key, metrics_by_week, rows_at_strike,
)
from tenorline.operators.spot import attach_spot
from tenorline.operators.spread_analysis import analyse_chains, analyse_stored
from tenorline.operators.structures import (
    friday_friday, friday_friday_wide, friday_monday, friday_monday_wide, match_legs,
    monday_friday, time_spreads, wide_pairs,
)
from tenorline.plans.calendar_spreads import all_day_spreads, set_aside, spreads_to_store
from tenorline.plans.relative_value import (
    SUMMARY_COLUMNS, Selection, atm_summary, last_hour_snapshot, paired_snapshot, relative_value,
)
from tenorline.schema import RAW_SAMPLES
from tenorline.session import scratch_dir
from tenorline.sources.raw_samples import scan_raw, typed_samples
from tenorline.sources.tables import read_table
from tenorline.workload.dates import DAYS_SQL
from tenorline.workload.pricing import MODEL_SQL
from tenorline.workload.registry import query
from tenorline.workload.views import Tables

SAME_CHAIN = """f.dt = b.dt and f.underlying_ticker = b.underlying_ticker
  and f.option_type = b.option_type and f.strike = b.strike"""


def spread_sql(gap: int, extra: str = "") -> str:
    return f"""
    select cast(f.dt as timestamp) as dt, f.ticker as ticker_f, b.ticker as ticker_b,
           f.id as id_f, b.id as id_b,
           concat('{gap}d_calendar_', lower(f.underlying_ticker)) as "desc"
    from option_quotes f join option_quotes b on {SAME_CHAIN} and b.dte = f.dte + {gap} {extra}
    """


@query("timespread", spread_sql(3))
def timespread(t: Tables):
    return time_spreads(t.option_quotes, 3)


@query("spread_fm", spread_sql(3))
def spread_fm(t: Tables):
    return friday_monday(t.option_quotes, unique_grain=True)


@query("spread_ff", spread_sql(7))
def spread_ff(t: Tables):
    return friday_friday(t.option_quotes, unique_grain=True)


@query("spread_mf", spread_sql(4))
def spread_mf(t: Tables):
    return monday_friday(t.option_quotes, unique_grain=True)


@query("spread_fm_strict", spread_sql(
    3, "and extract(isodow from f.exp_date) = 5 and extract(isodow from b.exp_date) = 1"))
def spread_fm_strict(t: Tables):
    return friday_monday(t.option_quotes, front_weekday=4, back_weekday=0)


def match_sql(condition: str) -> str:
    return f"""
    select cast(f.dt as timestamp) as dt, f.id as id_row, f.ticker as ticker_row,
           b.id as id_match, b.ticker as ticker_match
    from option_quotes f join option_quotes b
      on f.dt = b.dt and f.underlying_ticker = b.underlying_ticker and {condition}
    """


@query("match_vertical", match_sql(
    "b.option_type = f.option_type and b.strike = f.strike + 5 and b.dte = f.dte"))
def match_vertical(t: Tables):
    return match_legs(t.option_quotes, strike_diff=5)


@query("match_diagonal", match_sql(
    "b.option_type = f.option_type and b.strike = f.strike - 5 and f.dte - b.dte = 4"))
def match_diagonal(t: Tables):
    return match_legs(t.option_quotes, strike_diff=-5, dte_diff=4)


@query("match_straddle", match_sql(
    "b.option_type <> f.option_type and b.strike = f.strike and b.dte = f.dte"))
def match_straddle(t: Tables):
    return match_legs(t.option_quotes, invert=True)


WIDE = ("id", "ticker", "strike", "dte", "iv", "delta", "close")


def wide_sql(gap: int, label: str) -> str:
    legs = ", ".join(f"{s}.{c} as {c}_{s}" for s in ("f", "b") for c in WIDE)
    return f"""
    select cast(f.dt as timestamp) as dt, {legs}, '{label}' as pair_desc
    from option_quotes f join option_quotes b on {SAME_CHAIN} and f.dte - b.dte = -{gap}
    """


@query("pair_wide", wide_sql(3, "fm3dte_calendar"))
def pair_wide(t: Tables):
    return friday_monday_wide(t.option_quotes, WIDE)


@query("pair_wide_ff", wide_sql(7, "ff7dte_calendar"))
def pair_wide_ff(t: Tables):
    return friday_friday_wide(t.option_quotes, WIDE)


ANALYSIS_SQL = f"""
select b.id as id_b, b.iv as biv, f.id as id_f, f.iv as fiv, round(f.iv - b.iv, 6) as ivdiff,
       cast(f.dt as varchar) as dt, cast(f.exp_date as varchar) as exp_date_f,
       cast(b.exp_date as varchar) as exp_date_b, round(b.close - f.close, 6) as pricediff,
       f.delta as delta_f, f.strike as strike_f
from option_quotes f join option_quotes b on {SAME_CHAIN} and b.dte = f.dte + 3
where f.dte > 10 and f.delta > 0.4e0 and f.delta < 0.6e0 and f.option_type = 'call'
"""


def _rounded(analysis):
    return analysis.withColumns({c: F.round(c, 6) for c in ("ivdiff", "pricediff")})


@query("spread_analysis", ANALYSIS_SQL)
def spread_analysis(t: Tables):
    return _rounded(analyse_chains(t.option_quotes, 3)).orderBy("exp_date_f", "strike_f", "id_f")


@query("spread_analysis_stored", ANALYSIS_SQL)
def spread_analysis_stored(t: Tables):
    spreads = friday_monday(t.option_quotes, unique_grain=True)
    return _rounded(analyse_stored(spreads, t.option_quotes))


# A second root quotes some grains of the first again.
ROOTS_SQL = f"""
{DAYS_SQL}, roots as (
  select * from option_quotes
  union all select * replace (concat(ticker, '-W') as ticker, -id as id) from option_quotes
  where id % 11 = 0),
counted as (
  select q.*, count(*) over (partition by q.dt, q.underlying_ticker, q.option_type, q.strike, q.dte)
    as quotes from roots q join days on days.d = q.dt where days.is_session),
opened as (select * from counted where quotes = 1)
"""


def two_roots(t: Tables):
    again = t.option_quotes.filter("id % 11 = 0").withColumns({
        "ticker": F.concat("ticker", F.lit("-W")), "id": -F.col("id")})
    return t.option_quotes.unionByName(again)


@query("spread_all_days", f"with {ROOTS_SQL}" + " union all ".join(
    spread_sql(g).replace("option_quotes", "opened") for g in (3, 7, 4)))
def spread_all_days(t: Tables):
    return all_day_spreads(two_roots(t))


@query("spreads_set_aside", f"""
with {ROOTS_SQL}
select cast(dt as varchar) as day, underlying_ticker, option_type, cast(strike as bigint) as strike,
       dte, count(*) as n
from counted where quotes > 1 group by 1, 2, 3, 4, 5
""")
def spreads_set_aside(t: Tables):
    return set_aside(two_roots(t))


@query("spreads_to_store", f"with {ROOTS_SQL}" + " union all ".join(
    spread_sql(g).replace("option_quotes", "opened") for g in (7, 4)))
def spreads_not_stored(t: Tables):
    """The 3-day spreads are stored already; the rest is new."""
    return spreads_to_store(two_roots(t), friday_monday(t.option_quotes, unique_grain=True))


@query("last_quote", """
with late as (select * from raw_samples where hour(sample_ts) >= 20),
ranked as (
  select symbol, bid, ask,
         row_number() over (partition by symbol, bid is null order by sample_ts desc, event_id desc)
           as rb,
         row_number() over (partition by symbol, ask is null order by sample_ts desc, event_id desc)
           as ra
  from late)
select symbol, max(case when bid is not null and rb = 1 then bid end) as bid,
       max(case when ask is not null and ra = 1 then ask end) as ask
from ranked group by symbol
""")
def last_quote(t: Tables):
    late = last_hour(t.raw_samples, hour=20)
    return last_per_key(late, ("symbol",), ("bid", "ask"), ("sample_ts", "event_id"))


@query("distinct_dte", "select distinct underlying_ticker, dte from option_quotes")
def distinct_dte(t: Tables):
    return t.option_quotes.select("underlying_ticker", "dte").distinct()


@query("max_monday_expiry", """
select underlying_ticker,
       cast(max(case when extract(isodow from exp_date) = 1 then exp_date end) as varchar)
         as max_monday_expiry,
       cast(min(dt) as timestamp) as first_dt, cast(max(dt) as timestamp) as last_dt
from option_quotes group by 1
""")
def max_monday_expiry(t: Tables):
    monday = F.when(F.weekday("exp_date") == 0, F.col("exp_date"))
    return t.option_quotes.groupBy("underlying_ticker").agg(
        F.max(monday).alias("max_monday_expiry"), F.min("dt").alias("first_dt"),
        F.max("dt").alias("last_dt"))


ATM_BY = ("dt", "underlying_ticker", "dte")


@query("atm_strike", """
select cast(dt as timestamp) as dt, underlying_ticker, dte, strike as atm_strike from (
  select *, row_number() over (partition by dt, underlying_ticker, dte
                               order by abs(delta - (-0.3e0)), strike) as rn
  from option_quotes where option_type = 'put') x
where rn = 1
""")
def atm_strike_rows(t: Tables):
    puts = t.option_quotes.filter(F.col("option_type") == "put")
    return atm_strike(puts, ATM_BY, -0.3)


@query("atm_rows", """
select id, cast(dt as timestamp) as dt, underlying_ticker, dte, strike, delta from (
  select *, row_number() over (partition by dt, underlying_ticker, dte
                               order by abs(delta - (-0.3e0)), strike) as rn
  from option_quotes where option_type = 'put') x
where rn = 1
""")
def atm_rows(t: Tables):
    puts = t.option_quotes.filter(F.col("option_type") == "put")
    atm = atm_strike(puts, ATM_BY, -0.3)
    return rows_at_strike(puts, atm, ATM_BY).select(
        "id", "dt", "underlying_ticker", "dte", "strike", "delta")


@query("atm_position", """
with puts as (
  select *, row_number() over (partition by dt, underlying_ticker, dte
                               order by abs(delta - (-0.3e0)), strike) as rn
  from option_quotes where option_type = 'put'),
atm as (select dt, underlying_ticker, dte, strike from puts where rn = 1)
select cast(a.dt as timestamp) as dt, a.underlying_ticker, a.dte, a.strike as atm_strike,
       (select count(*) from puts p where p.dt = a.dt
          and p.underlying_ticker = a.underlying_ticker and p.dte = a.dte
          and p.strike < a.strike) as position
from atm a
""")
def atm_position_rows(t: Tables):
    puts = t.option_quotes.filter(F.col("option_type") == "put")
    return atm_position(puts, ATM_BY, -0.3)


MEASURES = ("mid_diff", "iv_diff", "delta_diff", "theta_diff", "vega_diff", "gamma_diff")


@query("metrics_by_week", f"""
with {MODEL_SQL}, measured as (
  select q.*, n.s * n.pdf1 * sqrt(n.t) as vega, n.pdf1 / (n.s * n.v * sqrt(n.t)) as gamma
  from option_quotes q left join n on n.id = q.id),
pairs as (
  select strftime(f.exp_date, '%Y-%W') as week, f.dte,
         cast(round(abs(f.delta) * 10, 0) as int) * 10 as delta_level, b.close - f.close as mid_diff,
         b.iv - f.iv as iv_diff, b.delta - f.delta as delta_diff, b.theta - f.theta as theta_diff,
         b.vega - f.vega as vega_diff, b.gamma - f.gamma as gamma_diff
  from measured f join measured b on {SAME_CHAIN} and b.dte = f.dte + 3)
select week, dte, delta_level, count(*) as n,
       {", ".join(f"round(avg({m}), 6) + 0.0e0 as avg_{m}" for m in MEASURES)}
from pairs where delta_level in (30, 40, 50, 60, 70) group by 1, 2, 3
""")
def metrics(t: Tables):
    """A quote's close stands for its mid; vega and gamma come from its volatility."""
    priced = attach_spot(t.option_quotes, t.stock_quotes).withColumn("years", year_fraction(F.col("dte")))
    greeks = with_greeks(priced.withColumnsRenamed({"delta": "_delta", "theta": "_theta"}), Terms())
    quotes = greeks.drop("delta", "theta").withColumnsRenamed(
        {"_delta": "delta", "_theta": "theta", "close": "mid"})
    legs = ("mid", "iv", "delta", "theta", "vega", "gamma")
    pairs = back_minus_front(
        wide_pairs(quotes, 3, "3d", (*legs, "dte", "exp_date"), unique_grain=True), legs)
    out = metrics_by_week(pairs, year_week(F.col("exp_date_f")), F.col("dte_f"), F.col("delta_f"), MEASURES)
    return out.withColumns({f"avg_{m}": F.round(f"avg_{m}", 6) + 0.0 for m in MEASURES})


# Relative-value volatility from samples: the last hour holds the second and third sample
# of a winter day, the first of a summer day and none of a day that closes early; the third
# one's ask is missing now and then.

SNAPSHOT_SQL = f"""
{DAYS_SQL}, late as (
  select day, underlying, symbol, bid, ask, delta, theta, volatility, "daysToExpiration" as dte,
         epoch_ms("lastTradingDay") as ltd, "sampleTimeInLong" as sampled
  from option_samples join days on days.d = option_samples.day
  where epoch_ms("sampleTimeInLong") between close_at - interval 1 hour and close_at),
snap as (
  select day, underlying, symbol, arg_max(bid, sampled) as bid,
         arg_max(ask, sampled) filter (where ask is not null) as ask, arg_max(delta, sampled) as delta,
         arg_max(theta, sampled) as theta, arg_max(volatility, sampled) as volatility, max(dte) as dte,
         max(ltd) as ltd,
         lower(substring(split_part(symbol, '_', 2), 7, 1)) as call_put,
         cast(substring(split_part(symbol, '_', 2), 8) as double) as strike
  from late group by day, underlying, symbol),
comp as (
  select f.day, f.underlying as underlying_f, f.symbol as symbol_f, b.symbol as symbol_b,
         f.strike as strike_f, f.call_put as call_put_f, f.delta as delta_f,
         f.dte as "daysToExpiration_f",
         strftime(f.ltd, '%Y-%W') as "lastTradingDayWeekNumber_f",
         case extract(isodow from f.ltd) when 1 then 'A' when 2 then 'B' when 3 then 'C'
            when 4 then 'D' when 5 then 'EW' end || cast(cast(ceil((day(f.ltd)
            + extract(isodow from date_trunc('month', f.ltd)) % 7) / 7.0) as int) as varchar)
           as code,
         round((b.ask + b.bid) / 2 - (f.ask + f.bid) / 2, 6) as mid_diff,
         round((b.ask - b.bid) - (f.ask - f.bid), 6) as width_diff,
         round(b.volatility - f.volatility, 6) as volatility_diff,
         round(b.delta - f.delta, 6) as delta_diff, round(b.theta - f.theta, 6) as theta_diff
  from snap f join snap b on f.day = b.day and f.underlying = b.underlying
   and f.strike = b.strike and f.call_put = b.call_put and b.dte = f.dte + 3),
band as (
  select * from comp where call_put_f = 'p' and delta_f > -0.8e0 and delta_f < -0.1e0),
picked as (
  select day, underlying_f, strike_f from (
    select *, row_number() over (partition by day, underlying_f
                                 order by abs(delta_f - (-0.7e0)), strike_f) as rn
    from band where code = 'EW1') x where rn = 1),
summary as (
  select band.* from band join picked using (day, underlying_f, strike_f))
"""

DIFFS = ("mid_diff", "width_diff", "volatility_diff", "delta_diff", "theta_diff")


@query("last_hour_snapshot", f"""
with {SNAPSHOT_SQL}
select cast(day as varchar) as day, underlying, symbol, bid, ask, delta, volatility,
       dte as "daysToExpiration", strike, call_put from snap
""")
def snapshot_rows(t: Tables):
    return last_hour_snapshot(typed_samples(t.option_samples)).select(
        "day", "underlying", "symbol", "bid", "ask", "delta", "volatility", "daysToExpiration",
        "strike", "call_put")


@query("snapshot_pairs", f"""
with {SNAPSHOT_SQL}
select cast(day as varchar) as day, symbol_f, symbol_b, {", ".join(DIFFS)} from comp
""")
def snapshot_pairs(t: Tables):
    pairs = paired_snapshot(last_hour_snapshot(typed_samples(t.option_samples)))
    return pairs.select("day", "symbol_f", "symbol_b",
                        *[F.round(c, 6).alias(c) for c in DIFFS])


SUMMARY_SELECT = """
select cast(day as varchar) as day, underlying_f, strike_f, "lastTradingDayWeekNumber_f",
       mid_diff, volatility_diff, delta_diff, delta_f, "daysToExpiration_f" from summary
"""


def _summary_columns(df):
    return df.select("day", "underlying_f", "strike_f", *[
        F.round(c, 6).alias(c) if c.endswith("_diff") else F.col(c) for c in SUMMARY_COLUMNS])


@query("atm_summary", f"with {SNAPSHOT_SQL} {SUMMARY_SELECT}")
def atm_summary_rows(t: Tables):
    pairs = paired_snapshot(last_hour_snapshot(typed_samples(t.option_samples)))
    return _summary_columns(atm_summary(pairs, Selection()))


@query("relative_value", f"with {SNAPSHOT_SQL} {SUMMARY_SELECT} where underlying_f in ('U0', 'U1', 'U2')")
def relative_value_rows(t: Tables):
    """From sample files, over a universe of three underlyings."""
    path = scratch_dir(t.spark, "samples")
    t.option_samples.select(*RAW_SAMPLES.fieldNames()).write.parquet(path)
    raw = scan_raw(t.spark, path, RAW_SAMPLES, "*.parquet")
    return _summary_columns(relative_value(raw, underlyings=("U0", "U1", "U2")))


@query("metrics_v1", f"""
with {SNAPSHOT_SQL}
select "lastTradingDayWeekNumber_f", mid_diff, volatility_diff, delta_diff, delta_f,
       "daysToExpiration_f" from summary
""")
def metrics_table(t: Tables):
    """The six summary columns, written as a table and read back."""
    path = scratch_dir(t.spark, "metrics_v1")
    summary = _summary_columns(relative_value(t.option_samples))
    summary.select(*SUMMARY_COLUMNS).write.parquet(path)
    return read_table(t.spark, path)
