"""Listed contracts: terms, listing windows, sessions to expiry, seeding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tenorline.functions.strikes import atm_round, near_the_close, on_ladder
from tenorline.functions.trading_days import last_session_on_or_before, sessions_in
from tenorline.functions.values import needs_price
from tenorline.operators.filters import monday_or_friday

TERMS = ("underlying_ticker", "option_type", "strike", "exp_date")


def listed_on(day: Column, listed: Column, exp_date: Column) -> Column:
    """Listed and not yet expired."""
    return (listed <= day) & (exp_date >= day)


def in_window(day: Column, listed: Column, exp_date: Column, days_out: int) -> Column:
    return listed_on(day, listed, exp_date) & (exp_date <= F.date_add(day, days_out))


def listed_once(contracts: DataFrame) -> DataFrame:
    """One row per contract and terms, from its first listing day on, however often it was listed."""
    return contracts.groupBy("ticker", *TERMS).agg(F.min("listed").alias("listed"))


def terms_as_of(quotes: DataFrame, contracts: DataFrame) -> DataFrame:
    """Quotes with the terms of their contract, where it was listed on the quote's day.

    Both sides can be large; they meet in a plain equi-join that AQE may turn
    into a broadcast by measured size or split where a ticker is hot. Listings
    repeated on several days count once.
    """
    terms = listed_once(contracts).select(
        "ticker", *[F.col(c).alias(f"c_{c}") for c in TERMS], "listed")
    day = F.to_date("dt")
    return quotes.join(terms, "ticker").filter(
        listed_on(day, F.col("listed"), F.col("c_exp_date")))


def contracts_on_days(stock_days: DataFrame, contracts: DataFrame, days_out: int) -> DataFrame:
    """Stock days paired with the contracts listed that day and expiring within ``days_out``.

    The window is a range, so each contract is repeated for the at most
    ``days_out + 1`` days on which it qualifies and the join becomes an equality
    on (underlying, day); stock days are the lookup side, one row per key.
    """
    first = F.greatest(F.col("listed"), F.date_sub("exp_date", days_out))
    spans = contracts.filter(first <= F.col("exp_date"))
    qualifying = spans.withColumn("day", F.explode(F.sequence(first, F.col("exp_date"))))
    days = stock_days.select(F.col("ticker").alias("underlying_ticker"),
                             F.to_date("dt").alias("day"), "dt",
                             F.col("close").alias("stock_close"))
    return qualifying.join(days, ["underlying_ticker", "day"])


def option_worklist(stock_days: DataFrame, contracts: DataFrame, *, days_out: int = 70,
                    strike_distance: int = 100) -> DataFrame:
    """Quotes to seed: per stock day the contracts whose whole strike lies on the
    ladder around the close. Membership is a predicate, so the ladder of
    ``2 * strike_distance`` strikes is never exploded.
    """
    near = contracts_on_days(stock_days, contracts, days_out).filter(
        on_ladder(F.col("strike"), F.col("stock_close"), strike_distance))
    return near.select("dt", "ticker", *TERMS)


def contracts_to_ingest(stock_days: DataFrame, contracts: DataFrame, *, days_out: int = 40,
                        below: int = 5, step: int = 5) -> DataFrame:
    """The contracts to price: on some stock day listed, expiring within ``days_out`` on a
    Monday or Friday, and struck on the ``step`` grid below the rounded close.

    One row per contract with its terms; ``listed`` is the first day that chose it.
    """
    near = contracts_on_days(stock_days, listed_once(contracts), days_out).filter(
        monday_or_friday(F.col("exp_date"))
        & near_the_close(F.col("strike"), F.col("stock_close"), below, step))
    return near.groupBy("ticker", *TERMS).agg(F.min("day").alias("listed"))


def contract_sessions(contracts: DataFrame, start: str = "listed") -> DataFrame:
    """Each contract's sessions from ``start`` to the one before its last.

    The last session is the final one on or before expiry and is left out.
    """
    bounded = contracts.withColumn("_last", last_session_on_or_before(F.col("exp_date")))
    return (
        bounded.withColumn("_until", F.date_sub("_last", 1))
        .transform(lambda df: sessions_in(df, start, "_until"))
        .drop("_last", "_until")
    )


def nth_session(stock_quotes: DataFrame, n: int, by: tuple[str, ...] = ("ticker",)) -> DataFrame:
    """The n-th stored session per ticker (1-based).

    Days are made distinct before the window, so a ticker's group holds at most
    one row per calendar day; ``row_number = n`` also limits what is shuffled.
    """
    days = stock_quotes.select(*by, "dt").distinct()
    order = Window.partitionBy(*by).orderBy("dt")
    return days.withColumn("n", F.row_number().over(order)).filter(F.col("n") == n)


def vintage_days(vintages: DataFrame, stock_quotes: DataFrame) -> DataFrame:
    """Stock quotes inside each vintage's [sd, ed], by way of month buckets.

    A vintage is repeated for the months it spans; the range test is left as a
    residual on rows that share ticker and month.
    """
    spans = vintages.withColumn("_month", F.explode(F.sequence(
        F.trunc("sd", "MM"), F.trunc("ed", "MM"), F.expr("interval 1 month"))))
    days = stock_quotes.select("ticker", "dt", "close", F.trunc("dt", "MM").alias("_month"))
    day = F.to_date("dt")
    return spans.join(days, ["ticker", "_month"]).filter(
        (day >= F.col("sd")) & (day <= F.col("ed"))).drop("_month")


def atm_vintage(vintages: DataFrame, stock_quotes: DataFrame, contracts: DataFrame,
                stored: DataFrame, *, days_out: int = 60, session: int = 11) -> DataFrame:
    """Unpriced quotes of the contracts at the money on a vintage's first day.

    ``vintages`` has (ticker, sd, ed), its key. Per vintage: the first close in range,
    rounded, is the strike; its calls and puts listed on ``sd`` and expiring within
    ``days_out`` are crossed with the ``session``-th day and inserted where not stored;
    of the contracts' quotes in range those without a price remain. Returns
    (ticker, sd, ed, contract, dt, terms).

    A vintage's days and a contract's stored quotes become one row each, bounded by the
    calendar days they span, so every table is shuffled once.
    """
    days = vintage_days(vintages.select("ticker", "sd", "ed").distinct(), stock_quotes)
    first = (
        days.groupBy("ticker", "sd", "ed")
        .agg(F.min_by("close", "dt").alias("_first_close"),
             F.sort_array(F.collect_set("dt")).alias("_days"))
        .select(F.col("ticker").alias("underlying_ticker"), "sd", "ed",
                atm_round(F.col("_first_close")).cast("double").alias("_atm"),
                F.get("_days", F.lit(session - 1)).alias("_target"))
        .filter(F.col("_target").isNotNull())
    )
    terms = listed_once(contracts).select(
        F.col("ticker").alias("contract"), *TERMS, "listed",
        F.col("strike").cast("double").alias("_atm"))
    # Vintages start on month starts or any other day: the equality is on
    # underlying and strike, narrowed by the month of expiry.
    months = F.sequence(F.trunc("sd", "MM"), F.trunc(F.date_add("sd", days_out), "MM"),
                        F.expr("interval 1 month"))
    chosen = (
        first.withColumn("_exp_month", F.explode(months))
        .join(terms.withColumn("_exp_month", F.trunc("exp_date", "MM")),
              ["underlying_ticker", "_atm", "_exp_month"])
        .filter(in_window(F.col("sd"), F.col("listed"), F.col("exp_date"), days_out))
    )
    quotes = stored.groupBy(F.col("ticker").alias("contract")).agg(F.collect_list(
        F.struct("dt", needs_price(F.col("close")).alias("open"))).alias("_stored"))

    def in_range_and_open(q: Column) -> Column:
        day = F.to_date(q["dt"])
        return (day >= F.col("sd")) & (day <= F.col("ed")) & q["open"]

    # Inserts that meet a stored quote are ignored; the stored one is judged by its price.
    have = F.coalesce(F.col("_stored.dt"), F.array().cast("array<timestamp>"))
    waiting = F.coalesce(F.filter("_stored", in_range_and_open)["dt"], F.array().cast("array<timestamp>"))
    fresh = F.filter(F.array("_target"), lambda d: ~F.array_contains(have, d))
    return (
        chosen.join(quotes, "contract", "left")
        .select("underlying_ticker", "sd", "ed", "contract", "option_type", "strike", "exp_date",
                F.explode(F.concat(waiting, fresh)).alias("dt"))
    )
