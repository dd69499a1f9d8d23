"""Streaming runs to the end of what has landed; the result is compared with batch SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from tenorline.operators.contracts import listed_once
from tenorline.session import scratch_dir
from tenorline.sinks.parquet_tables import write_table
from tenorline.sources.tables import read_table
from tenorline.sources.vendor_json import parse_daily_bars
from tenorline.streaming.ingest import (
    LANDED_CONTRACTS, dedupe, enriched_quotes, first_listings, hourly_last_quote, insert_ignore_into, landed_stream, patch_into,
    to_files, upsert_into,
)
from tenorline.workload.pricing import ENRICHED_NULLABLE, ENRICHED_SQL, quotes_at_model_price, rounded
from tenorline.workload.registry import query
from tenorline.workload.sources_sinks import (
    BATCH_SQL, PATCHED, PATCHED_SQL, TARGET_SQL, batch_rows, landed_bars, landed_contracts, patches, target_rows,
)
from tenorline.workload.views import RAW_SAMPLES, Tables

QUOTE_ROWS = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("dt", T.TimestampType()),
    T.StructField("ticker", T.StringType()), T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.LongType()), T.StructField("attempt", T.IntegerType()),
])
STORED = ("id", "dt", "ticker", "close", "volume")


def run_to_table(stream: DataFrame, t: Tables, label: str) -> DataFrame:
    path = scratch_dir(t.spark, label)
    to_files(stream, path, scratch_dir(t.spark, f"{label}-checkpoint")).awaitTermination()
    return t.spark.read.schema(stream.schema).parquet(path)


def landed_batch(t: Tables) -> DataFrame:
    """The repeated quote rows as a stream of landed JSON files."""
    path = scratch_dir(t.spark, "landed-quotes")
    batch_rows(t).select(*[f.name for f in QUOTE_ROWS.fields]).write.json(path)
    return landed_stream(t.spark, path, QUOTE_ROWS)


@query("stream_ingest", """
select ticker, cast(dt as timestamp) as dt,
       case when fetched is null then 'NOT_FOUND' else 'OK' end as status,
       case when fetched is not null then open end as open,
       case when fetched is not null then close end as close,
       case when fetched is not null then volume end as volume
from stock_quotes
""", nullable={"volume": "double"})
def stream_ingest(t: Tables):
    path = scratch_dir(t.spark, "landed-bars")
    landed_bars(t).write.json(path)
    bars = parse_daily_bars(landed_stream(t.spark, path))
    return run_to_table(bars.select("ticker", "dt", "status", "open", "close", "volume"), t,
                        "stream-bars")


@query("stream_insert_ignore", f"""
with target as ({TARGET_SQL}), batch as ({BATCH_SQL})
select id, cast(dt as timestamp) as dt, ticker, close, volume from target
union all
select id, cast(dt as timestamp), ticker, round(close + 1, 2), volume from batch b
where not exists (select 1 from target t where t.dt = b.dt and t.ticker = b.ticker)
""")
def stream_insert_ignore(t: Tables):
    path = scratch_dir(t.spark, "stream-quotes")
    write_table(target_rows(t).select(*STORED), path)
    insert_ignore_into(landed_batch(t), path, ("dt", "ticker"), ("attempt",),
                       scratch_dir(t.spark, "insert-checkpoint")).awaitTermination()
    return read_table(t.spark, path).select(*STORED)


@query("stream_upsert", f"""
with target as ({TARGET_SQL}), batch as ({BATCH_SQL})
select id, cast(dt as timestamp) as dt, ticker, close, volume from target t
where not exists (select 1 from batch b where b.id = t.id)
union all
select id, cast(dt as timestamp), ticker, round(close + 2, 2), volume from batch
""")
def stream_upsert(t: Tables):
    path = scratch_dir(t.spark, "stream-upserts")
    write_table(target_rows(t).select(*STORED), path)
    upsert_into(landed_batch(t), path, ("dt", "ticker"), ("attempt",),
                scratch_dir(t.spark, "upsert-checkpoint")).awaitTermination()
    return read_table(t.spark, path).select(*STORED)


@query("stream_patch", PATCHED_SQL)
def stream_patch(t: Tables):
    path, landed = scratch_dir(t.spark, "stream-patches"), scratch_dir(t.spark, "landed-patches")
    rows = patches(t)
    write_table(target_rows(t).select(*PATCHED), path)
    rows.write.json(landed)
    patch_into(landed_stream(t.spark, landed, rows.schema), path, ("id", "dt", "ticker"), ("attempt",),
               scratch_dir(t.spark, "patch-checkpoint")).awaitTermination()
    return read_table(t.spark, path).select(*PATCHED)


@query("stream_contracts", """
select ticker, underlying_ticker, option_type, cast(strike as double) as strike,
       cast(exp_date as varchar) as exp_date, cast(listed as varchar) as listed
from contracts
""")
def stream_contracts(t: Tables):
    """Every contract is listed again two days after its first listing."""
    path = scratch_dir(t.spark, "landed-contracts")
    again = F.explode(F.array(F.col("dt"), F.date_add("dt", 2)))
    landed_contracts(t).withColumn("dt", again).write.json(path)
    given = run_to_table(first_listings(landed_stream(t.spark, path, LANDED_CONTRACTS)), t, "stream-contracts")
    return listed_once(given)


@query("stream_enrich", ENRICHED_SQL.replace("left join stock_quotes", "join stock_quotes"), nullable=ENRICHED_NULLABLE)
def stream_enrich(t: Tables):
    """All quotes land first with the prices of fetched stock days, the other prices after a restart.
    The tables span seven years, and quotes that have no price at all wait to the end."""
    landed, spots = scratch_dir(t.spark, "landed-options"), scratch_dir(t.spark, "landed-spots")
    out, checkpoint = scratch_dir(t.spark, "stream-enriched"), scratch_dir(t.spark, "enrich-checkpoint")
    quotes = quotes_at_model_price(t).select("id", "dt", "ticker", "underlying_ticker", "option_type", "strike", "exp_date", "close")
    prices = t.stock_quotes.select("dt", "ticker", "close", "fetched")
    quotes.write.json(landed)
    fetched = F.coalesce(F.col("fetched"), F.lit(False))
    for arrived in (prices.filter(fetched), prices.filter(~fetched)):
        arrived.write.mode("append").json(spots)
        stream = enriched_quotes(landed_stream(t.spark, landed, quotes.schema), landed_stream(t.spark, spots, prices.schema), "4000 days")
        to_files(stream, out, checkpoint).awaitTermination()
    return rounded(t.spark.read.schema(stream.schema).parquet(out))


def event_stream(t: Tables) -> DataFrame:
    # As a pattern, so that the table may be one file or a folder of files.
    pattern = f"{t.sf_dir}/{{events.parquet}}"
    events = t.spark.readStream.schema(t.spark.read.parquet(pattern).schema).parquet(pattern)
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return t.spark.sql(RAW_SAMPLES.replace("from events", "from {events}"), events=events)


@query("stream_last_quote", """
with closing as (
  select *, date_trunc('hour', sample_ts) as window_start from raw_samples
  where date_trunc('hour', sample_ts) + interval 1 hour
        <= (select max(sample_ts) from raw_samples) - interval 10 minutes),
ranked as (
  select window_start, symbol, bid, ask,
         row_number() over (partition by window_start, symbol
                            order by sample_ts desc, event_id desc) as rb,
         row_number() over (partition by window_start, symbol, ask is null
                            order by sample_ts desc, event_id desc) as ra
  from closing)
select window_start, symbol, max(case when rb = 1 then bid end) as bid,
       max(case when ask is not null and ra = 1 then ask end) as ask
from ranked group by window_start, symbol
""")
def stream_last_quote(t: Tables):
    quotes = hourly_last_quote(event_stream(t), ("bid", "ask"), ("sample_ts", "event_id"))
    return run_to_table(quotes, t, "stream-last")


@query("stream_dedupe", f"""
select id, cast(dt as timestamp) as dt, ticker from ({BATCH_SQL}) b
""")
def stream_dedupe(t: Tables):
    once = dedupe(landed_batch(t), ("dt", "ticker"), "dt", "8 days")
    return run_to_table(once.select("id", "dt", "ticker"), t, "stream-dedupe")
