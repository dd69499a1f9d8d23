"""Column functions and row predicates over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tenorline.functions import dates, sql, strikes, symbols, values
from tenorline.functions.legs import mid_and_width, quote_diffs
from tenorline.functions.trading_days import session_close
from tenorline.operators.contracts import contracts_on_days
from tenorline.operators.filters import (
    between_days, delta_band, monday_or_friday, on_day, universe,
)
from tenorline.operators.structures import wide_pairs
from tenorline.operators.worklist import fetch_state, for_tickers
from tenorline.sources.raw_samples import epochs_to_timestamps, typed_samples, with_symbol_fields
from tenorline.workload.dates import AS_OF, DAYS_SQL, RANGE, SAMPLE_DAY
from tenorline.workload.registry import query
from tenorline.workload.views import Tables


def order_day(t: Tables):
    return t.table("orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))


@query("week_of_month", """
select o_orderkey,
       cast(cast(ceil((day(o_orderdate)
         + extract(isodow from date_trunc('month', o_orderdate)) % 7) / 7.0) as int) as varchar)
         as week_of_month
from orders
""")
def week_of_month(t: Tables):
    return order_day(t).select("o_orderkey", dates.week_of_month(F.col("d")).alias("week_of_month"))


@query("expiry_code", """
select o_orderkey,
       case extract(isodow from o_orderdate) when 1 then 'A' when 2 then 'B' when 3 then 'C'
            when 4 then 'D' when 5 then 'EW' end
       || cast(cast(ceil((day(o_orderdate)
            + extract(isodow from date_trunc('month', o_orderdate)) % 7) / 7.0) as int) as varchar)
         as expiry_code
from orders
""")
def expiry_code(t: Tables):
    return order_day(t).select("o_orderkey", dates.expiry_code(F.col("d")).alias("expiry_code"))


@query("year_week", "select o_orderkey, strftime(o_orderdate, '%Y-%W') as year_week from orders")
def year_week(t: Tables):
    return order_day(t).select("o_orderkey", dates.year_week(F.col("d")).alias("year_week"))


@query("sql_functions", """
select event_id, strftime(ts, '%Y-%W') as year_week,
       cast(cast(ceil((day(ts) + extract(isodow from date_trunc('month', ts)) % 7) / 7.0) as int) as varchar)
         as week_of_month,
       case extract(isodow from ts) when 1 then 'A' when 2 then 'B' when 3 then 'C' when 4 then 'D' when 5 then 'EW' end
         || cast(cast(ceil((day(ts) + extract(isodow from date_trunc('month', ts)) % 7) / 7.0) as int) as varchar)
         as expiry_code,
       date_trunc('milliseconds', ts) as at_ms,
       split_part(symbol, '_', 1) as underlying, cast(substring(split_part(symbol, '_', 2), 8) as double) as strike,
       lower(substring(split_part(symbol, '_', 2), 7, 1)) as call_put
from (select r.*, e.ts from raw_samples r join events e on e.event_id = r.event_id) x
""")
def sql_functions(t: Tables):
    """The functions called from SQL text."""
    sql.register(t.spark)
    return t.spark.sql("""
        select event_id, year_week(cast(sample_ts as date)) as year_week, week_of_month(cast(sample_ts as date)) as week_of_month,
               expiry_code(cast(sample_ts as date)) as expiry_code, from_epoch_ms(unix_millis(cast(sample_ts as timestamp))) as at_ms,
               symbol_underlying(symbol) as underlying, symbol_strike(symbol) as strike, symbol_call_put(symbol) as call_put
        from {samples}""", samples=t.raw_samples)


@query("epoch_ms_columns", """
select symbol, epoch_ms("expirationDate") as "expirationDate",
       epoch_ms("lastTradingDay") as "lastTradingDay",
       epoch_ms("quoteTimeInLong") as "quoteTimeInLong",
       epoch_ms("tradeTimeInLong") as "tradeTimeInLong",
       epoch_ms("sampleTimeInLong") as "sampleTimeInLong"
from option_samples
""")
def epoch_ms_columns(t: Tables):
    return epochs_to_timestamps(t.option_samples).select(
        "symbol", "expirationDate", "lastTradingDay", "quoteTimeInLong", "tradeTimeInLong",
        "sampleTimeInLong")


@query("symbol_underlying", """
select event_id, split_part(symbol, '_', 1) as underlying from raw_samples
""")
def symbol_underlying(t: Tables):
    return t.raw_samples.select("event_id", symbols.underlying(F.col("symbol")).alias("underlying"))


@query("symbol_strike", """
select event_id, cast(substring(split_part(symbol, '_', 2), 8) as double) as strike
from raw_samples
""")
def symbol_strike(t: Tables):
    return t.raw_samples.select("event_id", symbols.strike(F.col("symbol")).alias("strike"))


@query("symbol_call_put", """
select event_id, lower(substring(split_part(symbol, '_', 2), 7, 1)) as call_put from raw_samples
""")
def symbol_call_put(t: Tables):
    return with_symbol_fields(t.raw_samples).select("event_id", "call_put")


PAIR_SQL = """
pairs as (
  select f.id as id_f, b.id as id_b, f.iv as iv_f, b.iv as iv_b, f.delta as delta_f,
         b.delta as delta_b, f.theta as theta_f, b.theta as theta_b, f.close as close_f,
         b.close as close_b
  from option_quotes f join option_quotes b
    on f.dt = b.dt and f.underlying_ticker = b.underlying_ticker
   and f.option_type = b.option_type and f.strike = b.strike and b.dte = f.dte + 3)
"""


@query("leg_diffs", f"""
with {PAIR_SQL}
select id_f, id_b, round(iv_b - iv_f, 6) as iv_diff, round(delta_b - delta_f, 6) as delta_diff,
       round(theta_b - theta_f, 6) as theta_diff
from pairs
""")
def leg_diffs(t: Tables):
    pairs = wide_pairs(t.option_quotes, 3, "3d", ("id", "iv", "delta", "theta"),
                       unique_grain=True)
    return quote_diffs(pairs).select(
        "id_f", "id_b", *[F.round(f"{n}_diff", 6).alias(f"{n}_diff")
                          for n in ("iv", "delta", "theta")])


@query("mid_width_diff", f"""
with {PAIR_SQL}
select id_f, id_b,
       round((close_b + 2 * iv_b + close_b - iv_b) / 2
             - (close_f + 2 * iv_f + close_f - iv_f) / 2, 6) as mid_diff,
       round(3 * iv_b - 3 * iv_f, 6) as width_diff
from pairs
""")
def mid_width_diff(t: Tables):
    quoted = t.option_quotes.withColumns({
        "ask": F.col("close") + 2 * F.col("iv"), "bid": F.col("close") - F.col("iv")})
    pairs = wide_pairs(quoted, 3, "3d", ("id", "ask", "bid"), unique_grain=True)
    return mid_and_width(pairs).select(
        "id_f", "id_b", F.round("mid_diff", 6).alias("mid_diff"),
        F.round("width_diff", 6).alias("width_diff"))


@query("dte_calendar", """
select id, cast(exp_date - dt as int) as dte_calendar from option_quotes
""")
def dte_calendar(t: Tables):
    return t.option_quotes.select(
        "id", dates.dte_calendar(F.col("exp_date"), F.col("dt")).alias("dte_calendar"))


@query("dte_elapsed", f"""
with {DAYS_SQL}
select q.id, cast(floor((epoch_ms(e.close_at) - epoch_ms(s.close_at)) / 86400000.0) as int)
         as dte_elapsed
from option_quotes q join days s on s.d = q.dt join days e on e.d = q.exp_date
""")
def dte_elapsed(t: Tables):
    return t.option_quotes.select("id", dates.dte_elapsed(
        session_close(F.col("exp_date")), session_close(F.to_date("dt"))).alias("dte_elapsed"))


@query("exp_weekday", """
select id, cast(extract(isodow from exp_date) - 1 as int) as exp_date_weekday from option_quotes
""")
def exp_weekday(t: Tables):
    return t.option_quotes.select(
        "id", dates.exp_weekday(F.col("exp_date")).alias("exp_date_weekday"))


@query("round_to_base", """
select ticker, cast(dt as timestamp) as dt, cast(5 * round_even(close / 5, 0) as int) as rounded
from stock_quotes
""")
def round_to_base(t: Tables):
    return t.stock_quotes.select(
        "ticker", "dt", strikes.round_to_base(F.col("close")).alias("rounded"))


@query("near_strikes", """
select ticker, cast(dt as timestamp) as dt, cast(5 * round_even(close / 5, 0) as int) - 5 as strike
from stock_quotes
""")
def near_strikes(t: Tables):
    return t.stock_quotes.select(
        "ticker", "dt", F.explode(strikes.near_strikes(F.col("close"))).alias("strike"))


@query("strike_ladder", """
select ticker, cast(dt as timestamp) as dt,
       unnest(generate_series(cast(trunc(close) as bigint) - 100, cast(trunc(close) as bigint) + 99))
         as strike
from stock_quotes
""")
def strike_ladder(t: Tables):
    ladder = strikes.strike_ladder(F.col("close")).cast("array<bigint>")
    return t.stock_quotes.select("ticker", "dt", F.explode(ladder).alias("strike"))


@query("atm_round", """
select ticker, cast(dt as timestamp) as dt, round_even(close, 0) as atm from stock_quotes
""")
def atm_round(t: Tables):
    return t.stock_quotes.select("ticker", "dt", strikes.atm_round(F.col("close")).alias("atm"))


@query("clean_nonfinite", """
select id, case when dte > 4 then iv end as cleaned from option_quotes
""")
def clean_nonfinite(t: Tables):
    broken = (
        F.when(F.col("dte") == 3, F.lit(float("inf"))).when(F.col("dte") == 4, F.lit(float("nan")))
        .otherwise(F.col("iv"))
    )
    return t.option_quotes.select("id", values.finite(broken).alias("cleaned"))


@query("iv_units", """
select id, round(iv, 6) as iv, round(iv * 100, 6) as iv_percent from option_quotes
""")
def iv_units(t: Tables):
    percent = F.col("option_type") == "put"
    mixed = F.when(percent, values.iv_as_percent(F.col("iv"))).otherwise(F.col("iv"))
    fraction = values.iv_as_fraction(mixed, percent)
    return t.option_quotes.select(
        "id", F.round(fraction, 6).alias("iv"),
        F.round(values.iv_as_percent(fraction), 6).alias("iv_percent"))


@query("storage_rounding", """
select ticker, cast(dt as timestamp) as dt,
       cast(cast(open / 3 as decimal(8,2)) as double) as price,
       cast(cast(close / 700 as decimal(12,4)) as double) as iv,
       cast(try_cast(close * 100000 as decimal(8,2)) as double) as too_large
from stock_quotes
""")
def storage_rounding(t: Tables):
    return t.stock_quotes.select(
        "ticker", "dt", values.stored_price(F.col("open") / 3).alias("price"),
        values.stored_iv(F.col("close") / 700).alias("iv"),
        values.stored_price(F.col("close") * 100000).alias("too_large"))


@query("filter_universe", """
select symbol, epoch_ms("lastTradingDay") as "lastTradingDay",
       epoch_ms("sampleTimeInLong") as "sampleTimeInLong"
from option_samples
where underlying in ('U1', 'U3')
  and epoch_ms("lastTradingDay") >= timestamp '1997-03-03'
  and epoch_ms("lastTradingDay") <= timestamp '1997-09-29'
""")
def filter_universe(t: Tables):
    return universe(typed_samples(t.option_samples), ["U1", "U3"], *RANGE).select(
        "symbol", "lastTradingDay", "sampleTimeInLong")


@query("quotes_for_day", """
select id, cast(dt as timestamp) as dt, ticker, close, fetched
from option_quotes where underlying_ticker = 'U3' and dt = date '1998-06-01'
""")
def quotes_for_day(t: Tables):
    return on_day(t.option_quotes, "U3", SAMPLE_DAY).select("id", "dt", "ticker", "close", "fetched")


@query("quotes_between", """
select ticker, cast(dt as timestamp) as dt, close from stock_quotes
where fetched and dt between date '1997-03-03' and date '1997-09-29'
""")
def quotes_between(t: Tables):
    return between_days(t.stock_quotes, *RANGE).filter("fetched").select("ticker", "dt", "close")


@query("fetch_state_counts", """
select underlying_ticker, case when fetched is null then 'unknown' when fetched then 'fetched'
       else 'pending' end as state, count(*) as n,
       sum(case when coalesce(fetched, false) then 0 else 1 end)::bigint as to_fetch
from option_quotes group by 1, 2
""")
def fetch_state_counts(t: Tables):
    todo = values.unfetched(F.col("fetched")).cast("long")
    return t.option_quotes.groupBy(
        "underlying_ticker", fetch_state(F.col("fetched")).alias("state")
    ).agg(F.count(F.lit(1)).alias("n"), F.sum(todo).alias("to_fetch"))


@query("quotes_for_tickers", """
select id, ticker, close from option_quotes
where ticker in (select ticker from contracts where extract(isodow from exp_date) in (1, 5))
""")
def quotes_for_tickers(t: Tables):
    """Quotes of the contracts that expire on a Monday or Friday."""
    wanted = t.contracts.filter(monday_or_friday(F.col("exp_date")))
    return for_tickers(t.option_quotes, wanted).select("id", "ticker", "close")


@query("mon_fri_expiries", """
select id, cast(exp_date as varchar) as exp_date from option_quotes
where extract(isodow from exp_date) in (1, 5)
""")
def mon_fri_expiries(t: Tables):
    return t.option_quotes.filter(monday_or_friday(F.col("exp_date"))).select("id", "exp_date")


@query("unexpired", """
select ticker, cast(exp_date as varchar) as exp_date from contracts
where exp_date > date '1999-11-15'
""")
def unexpired(t: Tables):
    return t.contracts.filter(F.col("exp_date") > F.lit(AS_OF)).select("ticker", "exp_date")


@query("contracts_in_window", """
select cast(s.dt as timestamp) as dt, c.ticker, cast(c.exp_date as varchar) as exp_date
from stock_quotes s join contracts c
  on c.underlying_ticker = s.ticker and c.listed <= s.dt and c.exp_date >= s.dt
 and c.exp_date <= s.dt + 40
""")
def contracts_in_window(t: Tables):
    return contracts_on_days(t.stock_quotes, t.contracts, 40).select("dt", "ticker", "exp_date")


@query("needs_price", """
select id, fetched from option_quotes where fetched is null or not fetched
""", nullable={"fetched": "string"})
def needs_price(t: Tables):
    close = F.when(F.col("fetched"), F.col("close")).when(~F.col("fetched"), 0.0)
    return t.option_quotes.withColumn("close", close).filter(
        values.needs_price(F.col("close"))).select("id", "fetched")


@query("delta_band", """
select id, delta from option_quotes
where option_type = 'put' and delta > -0.8e0 and delta < -0.1e0
""")
def delta_band_rows(t: Tables):
    puts = t.option_quotes.filter(F.col("option_type") == "put")
    return puts.filter(delta_band(F.col("delta"))).select("id", "delta")


@query("front_code_filter", """
select id, cast(exp_date as varchar) as exp_date from option_quotes
where option_type = 'put' and extract(isodow from exp_date) = 5
  and ceil((day(exp_date) + extract(isodow from date_trunc('month', exp_date)) % 7) / 7.0) = 1
""")
def front_code_filter(t: Tables):
    code = dates.expiry_code(F.col("exp_date"))
    return t.option_quotes.filter((F.col("option_type") == "put") & (code == "EW1")).select(
        "id", "exp_date")


@query("union_calls_puts", """
select id, option_type, close from option_quotes
""")
def union_calls_puts(t: Tables):
    calls = t.option_quotes.filter(F.col("option_type") == "call")
    puts = t.option_quotes.filter(F.col("option_type") == "put")
    return calls.unionByName(puts.drop("theta"), allowMissingColumns=True).select(
        "id", "option_type", "close")


@query("strike_type_grid", """
select distinct underlying_ticker, cast(strike as int) as strike, o.side as option_type
from option_quotes q, (values ('put'), ('call')) as o(side)
""")
def strike_type_grid(t: Tables):
    grid = t.option_quotes.select("underlying_ticker", F.col("strike").cast("int").alias("strike"))
    return grid.distinct().withColumn("option_type", F.explode(strikes.with_option_types()))

