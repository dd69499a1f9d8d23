"""Ingest jobs: worklist, landed responses, enrichment, rows to write.

Each job is one lazy plan over all tickers, contracts and days. A job returns
the rows to write; ``sinks.parquet_tables`` stores them idempotently.

One rule holds for all: a response that gives a price, or says that there is no
data, answers a quote. Answered quotes are ``fetched``, those without data with
null prices. Quotes that nobody has answered yet are neither written nor marked,
so they are asked for again, and a stored price is never replaced by nothing.

A quote may be priced before the price of its underlying has landed. It is stored without
derived values, and ``late_spot`` gives them once the underlying's price is there.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from tenorline.functions.trading_days import closed_by, market_schedule, session_close, sessions_in
from tenorline.operators.contracts import TERMS, atm_vintage, contract_sessions
from tenorline.operators.enrich import enrich
from tenorline.operators.merge import first_per_key
from tenorline.operators.worklist import missing_quotes, newest, oldest
from tenorline.sources.vendor_json import NO_DATA, parse_daily_bars

KEY = ["ticker", "dt"]
PRICES = ("open", "high", "low", "close")
BAR = (*PRICES, "volume", "pre_market", "after_market")


def _answers(landed: DataFrame, unique: bool = False) -> DataFrame:
    """One answer per request; of repeated responses one with prices is kept.

    ``unique`` says that responses are not repeated, which saves ordering them.
    """
    bars = parse_daily_bars(landed).select(*KEY, "status", *BAR).filter(
        F.col("close").isNotNull() | (F.col("status") == NO_DATA))
    if not unique:
        bars = first_per_key(bars, KEY, (F.col("close").isNull(), *BAR))
    return bars.drop("status")


def _priced(landed: DataFrame) -> DataFrame:
    return _answers(landed).filter(F.col("close").isNotNull())


def _filled(worklist: DataFrame, answers: DataFrame) -> DataFrame:
    """The answered rows of ``worklist``, with the answer's prices or, without data, their own."""
    answer = answers.select(*KEY, F.struct(*BAR).alias("_bar"))
    priced = F.col("_bar.close").isNotNull()
    filled = {c: F.when(priced, F.col(f"_bar.{c}")).otherwise(F.col(c))
              for c in BAR if c in worklist.columns}
    return (
        worklist.join(answer, KEY).withColumns({**filled, "fetched": F.lit(True)})
        .select(*worklist.columns)
    )


def stock_ingest(ranges: DataFrame, stored: DataFrame, landed: DataFrame,
                 as_of: Column | None = None, *, unique: bool = False) -> DataFrame:
    """Answered stock quotes for the sessions of each (ticker, sd, ed) not fetched yet.

    Only sessions closed by ``as_of`` (now) count. ``id`` is null for rows to insert and
    that of the seeded row for rows to replace. ``unique`` vouches that no request has
    been answered twice.
    """
    as_of = F.current_timestamp() if as_of is None else as_of
    closes = closed_by(market_schedule(ranges, "sd", "ed"), as_of).select(
        "ticker", F.col("market_close").alias("dt")).distinct()
    wanted = missing_quotes(closes, stored.select("id", *KEY, "fetched"), key=KEY)
    return wanted.join(_answers(landed, unique), KEY).select(
        "id", *KEY, *PRICES, F.lit(True).alias("fetched"))


def option_ingest(contracts: DataFrame, stored: DataFrame, stock_quotes: DataFrame,
                  landed: DataFrame, *, refetch: bool = False,
                  as_of: Column | None = None, unique: bool = False) -> DataFrame:
    """Enriched answered quotes for every contract's missing sessions up to expiry.

    Only sessions closed by ``as_of`` (now) count. ``id`` is null for rows to insert and
    set for rows to replace. ``unique`` vouches that no request has been answered twice.
    """
    as_of = F.current_timestamp() if as_of is None else as_of
    sessions = contract_sessions(contracts).select(
        "ticker", *TERMS, session_close(F.col("session")).alias("dt")).filter(F.col("dt") <= as_of)
    waiting = stored.select("id", *KEY, "fetched")
    wanted = missing_quotes(sessions, waiting, refetch=refetch, key=KEY)
    priced = wanted.join(_answers(landed, unique), KEY)
    return enrich(priced, stock_quotes.filter("fetched")).withColumn("fetched", F.lit(True))


def stock_refresh(stored: DataFrame, landed: DataFrame, limit: int | None = None) -> DataFrame:
    """The unfetched stock quotes that have been answered; ``limit`` takes the oldest only."""
    return _filled(oldest(stored, ~F.col("fetched"), limit), _answers(landed))


def option_refresh(stored: DataFrame, stock_quotes: DataFrame, landed: DataFrame,
                   after: date, before: date, limit: int | None = None) -> DataFrame:
    """The option quotes of unknown state in (after, before) that have been answered, priced
    and enriched; ``limit`` takes the newest only.
    """
    unknown = (
        F.col("fetched").isNull() & (F.col("dt") > F.lit(after)) & (F.col("dt") < F.lit(before))
    )
    worklist = newest(stored, unknown, limit)
    absent = {c: F.lit(None).cast("double") for c in BAR if c not in worklist.columns}
    return enrich(_filled(worklist.withColumns(absent), _answers(landed)), stock_quotes)


def atm_vintage_refresh(vintages: DataFrame, stock_quotes: DataFrame, contracts: DataFrame,
                        stored: DataFrame, landed: DataFrame) -> DataFrame:
    """Unpriced at-the-money quotes of each vintage, priced and enriched where a bar landed."""
    wanted = atm_vintage(vintages, stock_quotes, contracts, stored).withColumnRenamed(
        "contract", "ticker")
    return enrich(wanted.join(_priced(landed), KEY), stock_quotes).withColumn("fetched", F.lit(True))


def late_spot(stored: DataFrame, stock_quotes: DataFrame) -> DataFrame:
    """Stored option quotes that are priced but have no derived values, with those that the
    underlying's price, now known, gives. Quotes still without one, or whose price gives no
    volatility, are not among them, so a second run finds nothing.
    """
    pending = stored.filter("fetched and close is not null and iv is null")
    known = stock_quotes.filter("fetched and close is not null")
    return enrich(pending, known).filter("iv is not null")


def contract_prices(contracts: DataFrame, landed: DataFrame) -> DataFrame:
    """Daily bars of unexpired contracts with their terms, ready for the CSV export.

    ``contracts`` has (ticker, terms, sd, ed): the sessions to price, both ends included.
    """
    live = contracts.filter(F.col("exp_date") > F.col("sd"))
    sessions = sessions_in(live, "sd", "ed").withColumn("dt", session_close(F.col("session")))
    return sessions.join(_priced(landed), KEY).select(
        "ticker", *PRICES, "volume", F.to_date("dt").alias("dt"), "underlying_ticker",
        F.col("exp_date").alias("expiration_date"), F.col("option_type").alias("contract_type"),
        F.col("strike").alias("strike_price"),
    )
