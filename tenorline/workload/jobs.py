"""Whole ingest jobs over the test views. Quotes carry the closing instant of their day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tenorline.functions.black_scholes import Terms, with_price, year_fraction
from tenorline.functions.trading_days import session_close
from tenorline.operators.spot import attach_spot
from tenorline.plans.ingest import (
    PRICES, atm_vintage_refresh, contract_prices, late_spot, option_ingest, option_refresh,
    stock_ingest, stock_refresh,
)
from tenorline.session import scratch_dir
from tenorline.sinks.csv_export import export_per_underlying
from tenorline.sources.tables import read_csv
from tenorline.workload.dates import AS_OF, DAYS_SQL, RANGE
from tenorline.workload.pricing import MODEL_SQL
from tenorline.workload.registry import query
from tenorline.workload.schedules import VINTAGES_SQL, partly_priced, ranges, vintages
from tenorline.workload.sources_sinks import landed_bars
from tenorline.workload.views import Tables


def at_close(df: DataFrame) -> DataFrame:
    return df.withColumn("dt", session_close(F.to_date("dt")))


def landed_option_bars(t: Tables, no_data: Column) -> DataFrame:
    return responses(t.option_quotes, no_data)


# Of the quotes some are stored with a price, some seeded without, and some not at all. Some
# responses say that there is no data, and sessions after AS_OF are still to come. Quotes that
# nobody has answered yet are among the fixtures of ``test_store``.

CLOSED = f"close_at <= timestamp '{AS_OF} 22:00:00'"


def now() -> Column:
    return F.lit(f"{AS_OF} 22:00:00").cast("timestamp")


@query("stock_ingest", f"""
with {DAYS_SQL}
select s.ticker, d.close_at as dt, true as fetched,
       case when s.fetched is not null then s.open end as open,
       case when s.fetched is not null then s.high end as high,
       case when s.fetched is not null then s.low end as low,
       case when s.fetched is not null then s.close end as close,
       s.fetched is not null and s.volume % 2 = 0 as seeded
from stock_quotes s join days d on d.d = s.dt
where d.is_session and {CLOSED} and not coalesce(s.fetched, false)
""")
def stock_ingest_rows(t: Tables):
    """Fetched quotes are stored, pending ones of even volume seeded; unknown ones answer
    without data."""
    stock = at_close(t.stock_quotes)
    known = stock.filter("fetched or (not fetched and volume % 2 = 0)")
    stored = known.withColumns({
        "id": F.lit(1).cast("long"), **{c: F.when(F.col("fetched"), F.col(c)) for c in PRICES}})
    rows = stock_ingest(ranges(t), stored, at_close(landed_bars(t)), now())
    return rows.select("ticker", "dt", *PRICES, "fetched", F.col("id").isNotNull().alias("seeded"))


# Prices follow from the known volatility, which inverting them must give back.

MODELLED_SQL = """
modelled as (
  select *, s * n1 - kdf * n2 - case when option_type = 'put' then s - kdf else 0 end as price,
         s * pdf1 * sqrt(t) as model_vega
  from n),
told as (
  select *, price > 0 and price > case when option_type = 'put' then kdf - s else s - kdf end
            and 7.5e-8 * (s + kdf) / model_vega <= 1e-3 as told,
         case when option_type = 'put' then n1 - 1 else n1 end as m_delta,
         pdf1 / (s * v * sqrt(t)) as m_gamma,
         -s * pdf1 * v / (2 * sqrt(t))
           + 0.0025e0 * kdf * (case when option_type = 'put' then 1 - n2 else -n2 end) as m_theta
  from modelled)
"""

DERIVED_SQL = """
round(case when {0} then p.v end, 3) as iv, round(case when {0} then p.m_delta end, 3) + 0.0e0 as delta,
round(case when {0} then p.m_gamma end, 3) + 0.0e0 as gamma,
round(case when {0} then p.model_vega end, 3) + 0.0e0 as vega,
round(case when {0} then p.m_theta end, 3) + 0.0e0 as theta
"""

VALUES = ("iv", "delta", "gamma", "vega", "theta")


def rounded(rows: DataFrame) -> list[Column]:
    return [(F.round(c, 3) + (0.0 if c != "iv" else 0)).alias(c) for c in VALUES]


def modelled(t: Tables) -> DataFrame:
    """Option quotes at the model price of their volatility, or at their own without a spot.
    Written, as the price's long expression would be repeated through the whole plan.
    """
    priced = with_price(
        attach_spot(t.option_quotes, t.stock_quotes).withColumn("years", year_fraction(F.col("dte"))), Terms())
    path = scratch_dir(t.spark, "modelled")
    priced.withColumn("close", F.coalesce("model_price", "close")).drop(
        "model_price", "spot", "years").write.parquet(path)
    return t.spark.read.parquet(path)


def responses(quotes: DataFrame, no_data: Column) -> DataFrame:
    """One response per quote; where ``no_data`` holds it says so."""
    answer = F.to_json(F.struct(
        F.lit("OK").alias("status"), F.date_format("dt", "yyyy-MM-dd").alias("from"),
        F.col("ticker").alias("symbol"), F.col("close").alias("open"),
        F.col("close").alias("high"), F.col("close").alias("low"), "close", "volume",
        F.col("close").alias("afterHours"), F.col("close").alias("preMarket"),
    ))
    nothing = F.to_json(F.struct(F.lit("NOT_FOUND").alias("status")))
    return quotes.select("ticker", "dt", F.when(no_data, nothing).otherwise(answer).alias("body"))


@query("option_ingest", f"""
with {DAYS_SQL}, {MODEL_SQL}, {MODELLED_SQL}, bounds as (
  select c.ticker, c.underlying_ticker, c.exp_date, c.listed, max(d) as last_session
  from contracts c join days on d between c.exp_date - 9 and c.exp_date
  where is_session group by all),
expected as (
  select b.*, d.d, d.close_at from bounds b join days d on d.d >= listed and d.d < last_session
  where d.is_session and {CLOSED}),
wanted as (
  select e.*, q.id, q.fetched, case when q.fetched is null then coalesce(p.price, q.close) end as close
  from expected e join option_quotes q on q.ticker = e.ticker and q.dt = e.d
  left join told p on p.id = q.id
  where not coalesce(q.fetched, false))
select case when w.id % 2 = 0 then w.id end as id, w.ticker, w.close_at as dt, true as fetched,
       round(w.close, 6) as close,
       case when w.close is not null then cast(w.exp_date - w.d as int) end as dte, s.close as spot,
       {DERIVED_SQL.format("w.close is not null and s.close is not null and p.told")}
from wanted w left join stock_quotes s
  on s.ticker = w.underlying_ticker and s.dt = w.d and s.fetched
left join told p on p.id = w.id
""", nullable={"id": "double", "dte": "double"})
def option_ingest_rows(t: Tables):
    """Every contract from its listing on. Fetched quotes are stored and so are the others of
    even id, unpriced; pending ones answer without data."""
    quotes = at_close(modelled(t))
    stored = quotes.filter("coalesce(fetched, false) or id % 2 = 0")
    landed = responses(quotes, F.coalesce(~F.col("fetched"), F.lit(False)))
    rows = option_ingest(t.contracts, stored, at_close(t.stock_quotes), landed, as_of=now())
    return rows.select("id", "ticker", "dt", "fetched", F.round("close", 6).alias("close"), "dte",
                       "spot", *rounded(rows))


@query("stock_refresh", """
select ticker, cast(dt as timestamp) as dt, open, high, low, close, volume, true as fetched
from stock_quotes where not fetched
""")
def stock_refresh_rows(t: Tables):
    """Unfetched rows are stored without prices until responses fill them."""
    empty = t.stock_quotes.withColumns({
        c: F.when(F.col("fetched"), F.col(c)) for c in PRICES})
    return stock_refresh(empty, landed_bars(t)).select("ticker", "dt", *PRICES, "volume", "fetched")


@query("option_refresh", f"""
with {MODEL_SQL}, {MODELLED_SQL}
select q.id, cast(q.dt as timestamp) as dt, q.ticker, true as fetched,
       round(case when q.option_type = 'call' then coalesce(p.price, q.close) end, 6) as close,
       case when q.option_type = 'call' then q.dte end as dte, s.close as spot,
       {DERIVED_SQL.format("q.option_type = 'call' and p.told")}
from option_quotes q left join stock_quotes s on s.dt = q.dt and s.ticker = q.underlying_ticker
left join told p on p.id = q.id
where q.fetched is null and q.dt > date '1997-03-03' and q.dt < date '1997-09-29'
""", nullable={"dte": "double"})
def option_refresh_rows(t: Tables):
    """Stored rows have no price; puts answer without data."""
    quotes = modelled(t)
    stored = quotes.withColumn("close", F.lit(None).cast("double"))
    landed = responses(quotes, F.col("option_type") == "put")
    rows = option_refresh(stored, t.stock_quotes, landed, *RANGE)
    return rows.select("id", "dt", "ticker", "fetched", F.round("close", 6).alias("close"), "dte",
                       "spot", *rounded(rows))


@query("late_spot", f"""
with {MODEL_SQL}, {MODELLED_SQL}
select q.id, cast(q.dt as timestamp) as dt, q.ticker, round(p.price, 6) as close, q.dte, s.close as spot,
       {DERIVED_SQL.format("true")}
from option_quotes q join stock_quotes s on s.dt = q.dt and s.ticker = q.underlying_ticker and s.fetched
join told p on p.id = q.id
where p.told
""")
def late_spot_rows(t: Tables):
    """All quotes were priced before their underlying, of which only some are known by now."""
    stored = modelled(t).drop("dte").withColumns({
        "fetched": F.lit(True), **{c: F.lit(None).cast("double") for c in VALUES}})
    rows = late_spot(stored, t.stock_quotes)
    return rows.select("id", "dt", "ticker", F.round("close", 6).alias("close"), "dte", "spot", *rounded(rows))


@query("atm_vintage_refresh", f"""
with {VINTAGES_SQL}
select u.contract as ticker, cast(u.sd as varchar) as sd, cast(u.ed as varchar) as ed, cast(u.dt as timestamp) as dt,
       true as fetched, q.close, cast(u.exp_date - u.dt as int) as dte, s.close as spot
from unpriced u join option_quotes q on q.ticker = u.contract and q.dt = u.dt
left join stock_quotes s on s.ticker = u.underlying_ticker and s.dt = u.dt
""")
def atm_vintage_refresh_rows(t: Tables):
    rows = atm_vintage_refresh(vintages(t), t.stock_quotes, t.contracts, partly_priced(t),
                               landed_option_bars(t, F.lit(False)))
    return rows.select("ticker", "sd", "ed", "dt", "fetched", "close", "dte", "spot")


CONTRACT_CSV = T.StructType([
    T.StructField("ticker", T.StringType()), T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()), T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()), T.StructField("volume", T.LongType()),
    T.StructField("dt", T.DateType()), T.StructField("underlying_ticker", T.StringType()),
    T.StructField("expiration_date", T.DateType()), T.StructField("contract_type", T.StringType()),
    T.StructField("strike_price", T.LongType()),
])


@query("contract_price_csv", f"""
with {DAYS_SQL}, prices as (
  select c.ticker, q.close as open, q.close, q.volume, q.dt, c.underlying_ticker, c.exp_date,
         c.option_type, c.strike
  from contracts c join option_quotes q on q.ticker = c.ticker and q.dt = c.listed
  join days d on d.d = c.listed
  where d.is_session and c.exp_date > c.listed)
select ticker, open, close, volume, cast(dt as varchar) as dt, underlying_ticker,
       cast(exp_date as varchar) as expiration_date, option_type as contract_type,
       cast(strike as bigint) as strike_price,
       concat(underlying_ticker, '-', max(dt) over (partition by underlying_ticker), '.csv') as file
from prices
""")
def contract_price_csv(t: Tables):
    """Every contract on its listing day, exported to a file per underlying and read back."""
    wanted = t.contracts.withColumns({"sd": F.col("listed"), "ed": F.col("listed")})
    prices = contract_prices(wanted, at_close(landed_option_bars(t, F.lit(False))))
    path = scratch_dir(t.spark, "contract-prices")
    export_per_underlying(prices, path)
    return read_csv(t.spark, path, CONTRACT_CSV).select(
        "ticker", "open", "close", "volume", "dt", "underlying_ticker", "expiration_date",
        "contract_type", "strike_price", F.col("_metadata.file_name").alias("file"))
