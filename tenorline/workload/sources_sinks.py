"""Scans, vendor responses, merges and exports."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from tenorline.functions.dates import exp_weekday
from tenorline.operators.bars import aggregate_bars
from tenorline.operators.contracts import terms_as_of
from tenorline.operators.filters import on_day
from tenorline.operators.merge import insert_ignore, key_violations, patch, split_by_id, upsert
from tenorline.schema import normalize_layout
from tenorline.session import scratch_dir
from tenorline.sinks.csv_export import export_csv
from tenorline.sinks.parquet_tables import append_new, patch_rows, upsert_rows, write_table
from tenorline.sources.raw_samples import scan_raw
from tenorline.sources.tables import read_csv, read_table
from tenorline.sources.vendor_json import parse_aggregate_bars, parse_contracts, parse_daily_bars
from tenorline.workload.dates import SAMPLE_DAY
from tenorline.workload.registry import query
from tenorline.workload.views import Tables

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
])


@query("scan_raw", """
select event_id, ts, user_id, event_type, value, cast(null as bigint) as sample_epoch from events
""", nullable={"sample_epoch": "double"})
def scan(t: Tables):
    """The events file does not start with an epoch; ``test_sources`` reads files that do."""
    return scan_raw(t.spark, t.path("events"), EVENTS, "*.parquet")


DAY_COLUMNS = ("id", "ticker", "option_type", "strike", "dte", "close", "iv")


@query("scan_quotes_day", """
select id, ticker, option_type, cast(strike as bigint) as strike, dte, close, iv
from option_quotes where underlying_ticker = 'U1' and dt = date '1998-06-01'
""")
def scan_quotes_day(t: Tables):
    """One day's folder of a stored table."""
    path = scratch_dir(t.spark, "option-quotes")
    write_table(t.option_quotes, path)
    return on_day(read_table(t.spark, path), "U1", SAMPLE_DAY).select(*DAY_COLUMNS)


# Vendor responses, rendered from the views with the vendor's field names.

def landed_bars(t: Tables):
    """One response per stock quote; those never fetched answer without data."""
    answer = F.to_json(F.struct(
        F.lit("OK").alias("status"), F.date_format("dt", "yyyy-MM-dd").alias("from"),
        F.col("ticker").alias("symbol"), "open", "high", "low", "close", "volume",
        (F.col("close") + 0.25).alias("afterHours"), (F.col("open") - 0.25).alias("preMarket"),
    ))
    no_data = F.to_json(F.struct(F.lit("NOT_FOUND").alias("status")))
    body = F.when(F.col("fetched").isNull(), no_data).otherwise(answer)
    return t.stock_quotes.select("ticker", "dt", body.alias("body"))


@query("parse_daily_bar_json", """
select ticker, cast(dt as timestamp) as dt,
       case when fetched is null then 'NOT_FOUND' else 'OK' end as status,
       case when fetched is not null then open end as open,
       case when fetched is not null then high end as high,
       case when fetched is not null then low end as low,
       case when fetched is not null then close end as close,
       case when fetched is not null then volume end as volume,
       case when fetched is not null then round(open - 0.25e0, 4) end as pre_market,
       case when fetched is not null then round(close + 0.25e0, 4) end as after_market
from stock_quotes
""", nullable={"volume": "double"})
def parse_daily_bar_json(t: Tables):
    return parse_daily_bars(landed_bars(t)).withColumns({
        c: F.round(c, 4) for c in ("pre_market", "after_market")})


def landed_contracts(t: Tables):
    """One response per contract and listing day."""
    contract = F.struct(
        "ticker", "underlying_ticker", F.col("option_type").alias("contract_type"),
        F.col("strike").alias("strike_price"),
        F.date_format("exp_date", "yyyy-MM-dd").alias("expiration_date"),
        F.lit("OCASPS").alias("cfi"), F.lit("american").alias("exercise_style"),
        F.lit("XNAS").alias("primary_exchange"), F.lit(100).alias("shares_per_contract"),
    )
    body = F.to_json(F.struct(F.array(contract).alias("results")))
    return t.contracts.select(F.col("listed").alias("dt"), body.alias("body"))


@query("parse_contracts_json", """
select cast(listed as varchar) as dt, ticker, underlying_ticker, option_type,
       cast(strike as double) as strike, cast(exp_date as varchar) as exp_date
from contracts
""")
def parse_contracts_json(t: Tables):
    return parse_contracts(landed_contracts(t))


@query("parse_agg_bars_json", """
select ticker, volume, round(px, 6) as volume_weighted_price, close,
       cast(dt as timestamp) as dt, volume as transaction_number
from (select *, (open + close) / 2 as px from stock_quotes) x
""")
def parse_agg_bars_json(t: Tables):
    bar = F.struct(
        F.col("volume").alias("v"), ((F.col("open") + F.col("close")) / 2).alias("vw"),
        F.col("open").alias("o"), F.col("close").alias("c"), F.col("high").alias("h"),
        F.col("low").alias("l"), F.unix_millis("dt").alias("t"), F.col("volume").alias("n"),
    )
    landed = t.stock_quotes.select(
        "ticker", F.to_json(F.struct(F.array(bar).alias("results"))).alias("body"))
    return parse_aggregate_bars(landed).withColumn(
        "volume_weighted_price", F.round("volume_weighted_price", 6))


@query("contract_terms_join", """
select q.id, q.ticker, c.underlying_ticker as c_underlying_ticker,
       c.option_type as c_option_type, cast(c.strike as bigint) as c_strike,
       cast(c.exp_date as varchar) as c_exp_date
from option_quotes q join contracts c
  on q.ticker = c.ticker and c.listed <= q.dt and q.dt <= c.exp_date
""")
def contract_terms_join(t: Tables):
    return terms_as_of(t.option_quotes, t.contracts).select(
        "id", "ticker", "c_underlying_ticker", "c_option_type", "c_strike", "c_exp_date")


STOCK_CSV = T.StructType([
    T.StructField("ticker", T.StringType()), T.StructField("dt", T.TimestampType()),
    T.StructField("open", T.DoubleType()), T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()), T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.LongType()), T.StructField("fetched", T.BooleanType()),
])


@query("scan_csv", """
select ticker, cast(dt as timestamp) as dt, open, high, low, close, volume, fetched
from stock_quotes
""", nullable={"fetched": "string"})
def scan_csv(t: Tables):
    path = scratch_dir(t.spark, "stock-csv")
    columns = [F.col(f.name) for f in STOCK_CSV.fields]
    t.stock_quotes.select(*columns).write.option("header", True).csv(path)
    return read_csv(t.spark, path, STOCK_CSV)


@query("agg_bars", """
with ticks as (
  select event_type as ticker, time_bucket(interval '4 hours', ts) as dt, ts, event_id,
         value as price, user_id % 10 + 1 as size from events),
lasts as (
  select ticker, dt, price from (
    select ticker, dt, price,
           row_number() over (partition by ticker, dt order by ts desc, event_id desc) as rn
    from ticks) r where rn = 1)
select t.ticker, t.dt, cast(sum(t.size) as bigint) as volume,
       round(sum(t.price * t.size) / sum(t.size), 6) as volume_weighted_price,
       any_value(l.price) as close, count(*) as transaction_number
from ticks t join lasts l on t.ticker = l.ticker and t.dt = l.dt
group by t.ticker, t.dt
""")
def agg_bars(t: Tables):
    return aggregate_bars(ticks(t), "hour", 4).withColumn(
        "volume_weighted_price", F.round("volume_weighted_price", 6))


def ticks(t: Tables):
    return t.table("events").select(
        F.col("event_type").alias("ticker"), "ts", F.col("event_id").alias("tick_id"),
        F.col("value").alias("price"), (F.col("user_id") % 10 + 1).alias("size"))


#: Time spans with a multiplier, and the start of a bar on the exchange's clock in SQL.
SPANS = {
    ("minute", 30): "timezone('UTC', time_bucket(interval '30 minutes', ts))",
    ("hour", 1): "timezone('UTC', date_trunc('hour', ts))",
    ("day", 1): "timezone('America/New_York', date_trunc('day', local))",
    ("week", 1): "timezone('America/New_York', date_trunc('week', local))",
    ("week", 2): "timezone('America/New_York', time_bucket(interval '14 days', local, timestamp '1970-01-05'))",
    ("month", 1): "timezone('America/New_York', date_trunc('month', local))",
    ("quarter", 1): "timezone('America/New_York', date_trunc('quarter', local))",
    ("quarter", 2): "timezone('America/New_York', time_bucket(interval '6 months', local, timestamp '1970-01-01'))",
    ("year", 1): "timezone('America/New_York', date_trunc('year', local))",
}


@query("agg_bars_calendar", f"""
with ticks as (
  select event_type as ticker, ts, timezone('America/New_York', timezone('UTC', ts)) as local, event_id,
         value as price, user_id % 10 + 1 as size from events),
spread as (
  {" union all ".join(f"select '{n} {span}' as span, {start} as dt, * from ticks" for (span, n), start in SPANS.items())})
select span, ticker, cast(timezone('UTC', dt) as timestamp) as dt, cast(sum(size) as bigint) as volume,
       round(sum(price * size) / sum(size), 6) as volume_weighted_price,
       arg_max(price, (ts, event_id)) as close, count(*) as transaction_number
from spread group by span, ticker, dt
""")
def agg_bars_calendar(t: Tables):
    """Bars of all time spans; those of the calendar follow New York across clock changes."""
    bars = [aggregate_bars(ticks(t), span, n).withColumn("span", F.lit(f"{n} {span}")) for span, n in SPANS]
    together = bars[0]
    for more in bars[1:]:
        together = together.unionByName(more)
    return together.withColumn("volume_weighted_price", F.round("volume_weighted_price", 6))


# Target and batch for the merges: quotes not known to be pending are stored, quotes
# not known to be fetched arrive again, each twice, with another close.

TARGET_SQL = "select * from option_quotes where fetched is null or fetched"
BATCH_SQL = "select * from option_quotes where fetched is null or not fetched"


def target_rows(t: Tables):
    return t.option_quotes.filter(F.coalesce("fetched", F.lit(True)))


def batch_rows(t: Tables):
    again = t.option_quotes.filter(~F.coalesce("fetched", F.lit(False)))
    attempts = F.explode(F.array(F.lit(1), F.lit(2)))
    return again.withColumn("attempt", attempts).withColumn(
        "close", F.round(F.col("close") + F.col("attempt"), 2))


@query("insert_ignore", f"""
with target as ({TARGET_SQL}), batch as ({BATCH_SQL})
select id, cast(dt as timestamp) as dt, ticker, close, iv, volume from target
union all
select id, cast(dt as timestamp), ticker, round(close + 1, 2), iv, volume from batch b
where not exists (select 1 from target t where t.dt = b.dt and t.ticker = b.ticker)
""")
def insert_ignore_rows(t: Tables):
    columns = ["id", "dt", "ticker", "close", "iv", "volume"]
    return insert_ignore(target_rows(t).select(*columns),
                         batch_rows(t).select(*columns, "attempt"),
                         ("dt", "ticker"), ("attempt",))


@query("upsert_full_row", f"""
with target as ({TARGET_SQL}), batch as ({BATCH_SQL})
select id, cast(dt as timestamp) as dt, ticker, close, iv, volume from target t
where not exists (select 1 from batch b where b.id = t.id)
union all
select id, cast(dt as timestamp), ticker, round(close + 2, 2), cast(null as double), volume
from batch
""")
def upsert_full_row(t: Tables):
    columns = ["id", "dt", "ticker", "close", "iv", "volume"]
    source = batch_rows(t).select(*columns, "attempt").drop("iv")
    return upsert(target_rows(t).select(*columns), source, ("id",), ("attempt",))


# Patches: the first attempt brings a close, the second only a volume, neither has a volatility.

PATCHED_SQL = f"""
with target as ({TARGET_SQL}), batch as ({BATCH_SQL})
select coalesce(t.id, b.id) as id, cast(coalesce(t.dt, b.dt) as timestamp) as dt, coalesce(t.ticker, b.ticker) as ticker,
       coalesce(round(b.close + 1, 2), t.close) as close, t.iv, coalesce(b.volume + 2, t.volume) as volume
from target t full join batch b on b.id = t.id
"""
PATCHED = ["id", "dt", "ticker", "close", "iv", "volume"]


def patches(t: Tables):
    first = F.col("attempt") == 1
    return batch_rows(t).select(
        "id", "dt", "ticker", F.when(first, F.col("close")).alias("close"),
        F.when(~first, F.col("volume") + 2).alias("volume"), "attempt")


@query("upsert_patch", PATCHED_SQL)
def upsert_patch(t: Tables):
    return patch(target_rows(t).select(*PATCHED), patches(t), ("id", "dt", "ticker"), ("attempt",))


@query("store_patch", PATCHED_SQL)
def store_patch(t: Tables):
    """The same through a stored table, a day's partition at a time."""
    path = scratch_dir(t.spark, "option-quotes")
    write_table(target_rows(t).select(*PATCHED), path)
    patch_rows(t.spark, path, patches(t), ("id", "dt", "ticker"), ("attempt",))
    return read_table(t.spark, path).select(*PATCHED)


@query("split_write", f"""
with target as ({TARGET_SQL}), batch as ({BATCH_SQL})
select cast(dt as timestamp) as dt, ticker, close, volume from target where fetched
union all
select cast(dt as timestamp), ticker, round(close + case when fetched is null then 2 else 1 end, 2),
       volume
from batch
""")
def split_write(t: Tables):
    """Rows that wait in the table come with their id and replace it; new ones have none."""
    columns = ["id", "dt", "ticker", "close", "volume"]
    rows = batch_rows(t).withColumn("id", F.when(F.col("fetched").isNull(), F.col("id")))
    new, known = split_by_id(rows.select(*columns, "attempt"))
    replaced = upsert(target_rows(t).select(*columns), known, ("id",), ("attempt",))
    return insert_ignore(replaced, new, ("dt", "ticker"), ("attempt",)).drop("id")


@query("store_append_upsert", f"""
with target as ({TARGET_SQL}), batch as ({BATCH_SQL})
select id, cast(dt as timestamp) as dt, ticker, close, volume from target t
where not exists (select 1 from batch b where b.id = t.id)
union all
select id, cast(dt as timestamp), ticker, round(close + 2, 2), volume from batch
""")
def store_append_upsert(t: Tables):
    """The same merges through the stored table: create, append new keys, replace days."""
    columns = ["id", "dt", "ticker", "close", "volume"]
    path = scratch_dir(t.spark, "option-quotes")
    batch = batch_rows(t).select(*columns, "attempt")
    write_table(target_rows(t).select(*columns), path)
    append_new(t.spark, path, batch, ("dt", "ticker"), ("attempt",))
    upsert_rows(t.spark, path, batch, ("dt", "ticker"), ("attempt",))
    return read_table(t.spark, path).select(*columns)


@query("key_violations", f"""
with target as ({TARGET_SQL}), batch as ({BATCH_SQL})
select cast(dt as timestamp) as dt, ticker, count(*) as n
from (select dt, ticker from target union all select dt, ticker from batch) x
group by dt, ticker having count(*) > 1
""")
def key_violation_rows(t: Tables):
    again = t.option_quotes.filter(~F.coalesce("fetched", F.lit(False)))
    both = target_rows(t).select("dt", "ticker").unionByName(again.select("dt", "ticker"))
    return key_violations(both, ("dt", "ticker"))


@query("normalize_layout", """
select id, ticker, underlying_ticker,
       cast((extract(isodow from exp_date) - 1) as int) as exp_date_weekday, iv
from option_quotes
""")
def normalize_old_layout(t: Tables):
    old = t.option_quotes.select(
        "id", F.col("ticker").alias("symbol"), F.col("underlying_ticker").alias("ticker"),
        exp_weekday(F.col("exp_date")).alias("weekday"), "iv")
    return normalize_layout(old)


STOCK_EXPORT = T.StructType([
    T.StructField("ticker", T.StringType()), T.StructField("dt", T.TimestampType()),
    T.StructField("close", T.DoubleType()), T.StructField("volume", T.LongType()),
])


@query("export_csv", """
select ticker, cast(dt as timestamp) as dt, close, volume, ticker as u,
       cast(dt as varchar) as d
from stock_quotes
""")
def export_stock_csv(t: Tables):
    path = scratch_dir(t.spark, "csv-export")
    export_csv(t.stock_quotes.select("ticker", "dt", "close", "volume"), path, "ticker")
    layout = T.StructType([*STOCK_EXPORT.fields, T.StructField("u", T.StringType()),
                           T.StructField("d", T.DateType())])
    return read_csv(t.spark, path, layout)
