"""Incremental landing: response files in, new quote rows out, each exactly once."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from datetime import UTC, datetime, time, timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tenorline.operators.contracts import TERMS
from tenorline.operators.enrich import DERIVED, derive
from tenorline.sinks.parquet_tables import append_new, patch_rows, upsert_rows
from tenorline.sources.vendor_json import LANDED_BAR, parse_contracts


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def _disk_state(spark: SparkSession) -> Iterator[None]:
    """Keys under a watermark can outgrow executor memory: queries started inside keep their
    state in RocksDB. A query copies the setting when it starts, so the session gets its own back.
    """
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(STATE_STORE, before) if before else spark.conf.unset(STATE_STORE)


def landed_stream(spark: SparkSession, path: str, schema: T.StructType = LANDED_BAR,
                  files_per_trigger: int | None = None) -> DataFrame:
    """Landed JSON files as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def to_files(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Processes what has landed and stops; output files are committed once per batch."""
    with _disk_state(stream.sparkSession):
        return (
            stream.writeStream.format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(availableNow=True).start()
        )


def _each_batch(stream: DataFrame, checkpoint: str,
                write: Callable[[DataFrame], None]) -> StreamingQuery:
    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, _: write(batch)).trigger(availableNow=True).start()
    )


def insert_ignore_into(stream: DataFrame, path: str, key: Sequence[str], order: Sequence[str],
                       checkpoint: str) -> StreamingQuery:
    """Insert-ignore of every batch. A replayed batch finds its own rows stored and adds none."""
    return _each_batch(stream, checkpoint, lambda batch: append_new(
        batch.sparkSession, path, batch, key, order))


def upsert_into(stream: DataFrame, path: str, key: Sequence[str], order: Sequence[str],
                checkpoint: str) -> StreamingQuery:
    """Whole-row upsert of every batch; a replay writes the same rows again."""
    return _each_batch(stream, checkpoint, lambda batch: upsert_rows(
        batch.sparkSession, path, batch, key, order))


def patch_into(stream: DataFrame, path: str, key: Sequence[str], order: Sequence[str],
               checkpoint: str) -> StreamingQuery:
    """Field-by-field upsert of every batch; a replay writes the same fields again."""
    return _each_batch(stream, checkpoint, lambda batch: patch_rows(
        batch.sparkSession, path, batch, key, order))


LANDED_CONTRACTS = T.StructType([T.StructField("dt", T.DateType()), T.StructField("body", T.StringType())])
LISTED = "ticker string, underlying_ticker string, option_type string, strike double, exp_date date, listed date"
_KEPT = timedelta(days=1)


def _first_listing(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Keeps the earliest day a contract was listed on, until it has expired."""
    if state.hasTimedOut:
        state.remove()
        return
    earliest = min(batch["listed"].min() for batch in batches)
    if state.exists and state.get[0] <= earliest:
        return
    state.update((earliest,))
    expired = datetime.combine(key[-1] or earliest, time.min, UTC) + _KEPT
    state.setTimeoutTimestamp(max(int(expired.timestamp() * 1000), state.getCurrentWatermarkMs() + 1))
    yield pd.DataFrame([(*key, earliest)], columns=["ticker", *TERMS, "listed"])


def first_listings(landed: DataFrame, delay: str = "10 days") -> DataFrame:
    """Contract-list responses (dt, body) as a stream to (ticker, terms, listed): a contract is
    given out once, when its first listing arrives, and again only if one of an earlier day
    arrives after it, so the least ``listed`` of what was given out is the first.

    State is one day per contract, forgotten once the watermark, ``delay`` behind the latest
    listing, has passed its expiry.
    """
    listings = (parse_contracts(landed).withColumnRenamed("dt", "listed")
                .withColumn("_at", F.col("listed").cast("timestamp")).withWatermark("_at", delay))
    return listings.groupBy("ticker", *TERMS).applyInPandasWithState(
        _first_listing, LISTED, "listed date", "append", GroupStateTimeout.EventTimeTimeout)


def enriched_quotes(quotes: DataFrame, stock_quotes: DataFrame, delay: str = "10 days") -> DataFrame:
    """Option quotes with spot and derived values, both inputs as streams: a quote is given out
    once, as soon as it and its underlying's price at the same ``dt`` have landed, in either order.

    One whose spot has not landed when the watermark, ``delay`` behind the slower stream, passes
    it is given out with null spot and derived values. Of several prices at one instant the first
    to arrive counts; prices that are null count as not landed. State is the quotes and prices
    that are younger than the watermark. Columns of ``quotes`` named like derived ones are replaced.
    """
    spots = dedupe(
        stock_quotes.filter(F.col("close").isNotNull()).select(
            "dt", F.col("ticker").alias("underlying_ticker"), F.col("close").alias("spot")),
        ("dt", "underlying_ticker"), "dt", delay)
    waiting = quotes.drop(*DERIVED, "spot").withWatermark("dt", delay)
    return derive(waiting.join(spots, ["dt", "underlying_ticker"], "left"))


def dedupe(stream: DataFrame, key: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """First arrival per key; keys are forgotten once the watermark has passed them."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(key))


def hourly_last_quote(stream: DataFrame, columns: Sequence[str], order: Sequence[str], *,
                      symbol: str = "symbol", event_time: str = "sample_ts",
                      window: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Last non-null values per symbol and tumbling window, rows later than ``delay`` dropped.

    State is one row per open (window, symbol).
    """
    at = F.struct(*order)
    return (
        stream.withWatermark(event_time, delay)
        .groupBy(F.window(event_time, window).alias("_window"), symbol)
        .agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in columns])
        .select(F.col("_window.start").alias("window_start"), symbol, *columns)
    )
