"""The jobs end to end over one folder of stored quote tables.

Each method plans over all tickers, contracts and days at once and writes
idempotently; running it again adds nothing.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tenorline.functions.trading_days import market_schedule
from tenorline.operators.contracts import contracts_to_ingest, option_worklist
from tenorline.operators.filters import between_days
from tenorline.operators.merge import key_violations, split_by_id
from tenorline.operators.spread_analysis import analyse_stored
from tenorline.operators.worklist import rows_to_seed
from tenorline.plans import ingest
from tenorline.plans.calendar_spreads import GAPS, all_day_spreads, set_aside
from tenorline.schema import (
    OPTION_KEY, OPTION_QUOTES, SPREAD_KEY, STOCK_KEY, STOCK_QUOTES, STRATEGY_TIMESPREADS, conform,
    with_natural_id,
)
from tenorline.session import prepare
from tenorline.sinks.parquet_tables import append_new, staged, table_exists, upsert_rows
from tenorline.sources.tables import DAY, read_table


@dataclass(frozen=True)
class QuoteStore:
    spark: SparkSession
    root: str

    def __post_init__(self):
        prepare(self.spark)

    def _path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def _read(self, name: str, schema: T.StructType) -> DataFrame:
        """The stored table with its day column; empty before the first write."""
        layout = T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])
        path = self._path(name)
        if not table_exists(self.spark, path):
            return self.spark.createDataFrame([], layout)
        return read_table(self.spark, path, layout)

    def _insert(self, name: str, rows: DataFrame, schema: T.StructType, key) -> None:
        identified = with_natural_id(conform(rows, schema), key)
        append_new(self.spark, self._path(name), identified, key, ("id",))

    def _replace(self, name: str, rows: DataFrame, schema: T.StructType) -> None:
        upsert_rows(self.spark, self._path(name), conform(rows, schema), STOCK_KEY, ("id",))

    def _write(self, name: str, rows: DataFrame, schema: T.StructType, key) -> None:
        """Rows with an id replace the stored ones, the others are inserted. They are computed
        once, as the first write replaces files that their plan reads.
        """
        with staged(self.spark, rows, self._path(name)) as done:
            new, known = split_by_id(done)
            if not known.isEmpty():
                self._replace(name, known, schema)
            self._insert(name, new, schema, key)

    def _span(self, table: DataFrame, frame: DataFrame, first: str, last: str) -> DataFrame:
        """The table's days from the earliest ``first`` to the latest ``last`` of ``frame``."""
        bounds = frame.agg(F.min(first).alias("first"), F.max(last).alias("last")).first()
        if bounds["first"] is None:
            return table.filter("false").drop(DAY)
        return between_days(table, bounds["first"], bounds["last"]).drop(DAY)

    @property
    def stock_quotes(self) -> DataFrame:
        return self._read("stock_quotes", STOCK_QUOTES)

    @property
    def option_quotes(self) -> DataFrame:
        return self._read("option_quotes", OPTION_QUOTES)

    @property
    def timespreads(self) -> DataFrame:
        return self._read("strategy_timespreads", STRATEGY_TIMESPREADS)

    def ingest_stock(self, ranges: DataFrame, landed: DataFrame) -> None:
        """Answered prices of the sessions of each (ticker, sd, ed): seeded rows are replaced,
        others inserted.
        """
        stored = self._span(self.stock_quotes, ranges, "sd", "ed")
        self._write("stock_quotes", ingest.stock_ingest(ranges, stored, landed),
                    STOCK_QUOTES, STOCK_KEY)

    def seed_stock(self, ranges: DataFrame) -> None:
        """An empty unfetched row for every session without any."""
        sessions = market_schedule(ranges, "sd", "ed").select(
            "ticker", F.col("market_close").alias("dt")).distinct()
        seeds = rows_to_seed(sessions, self._span(self.stock_quotes, ranges, "sd", "ed"))
        self._insert("stock_quotes", seeds, STOCK_QUOTES, STOCK_KEY)

    def refresh_stock(self, landed: DataFrame, limit: int | None = None) -> None:
        """Prices for the unfetched rows, or the oldest ``limit`` of them."""
        rows = ingest.stock_refresh(self.stock_quotes.drop(DAY), landed, limit)
        self._replace("stock_quotes", rows, STOCK_QUOTES)

    def ingest_options(self, contracts: DataFrame, landed: DataFrame) -> None:
        """Prices and derived values of each contract's sessions up to expiry.

        Rows without an id are inserted, waiting rows are replaced.
        """
        options, stocks = (
            self._span(table, contracts, "listed", "exp_date")
            for table in (self.option_quotes, self.stock_quotes)
        )
        rows = ingest.option_ingest(contracts, options, stocks, landed)
        self._write("option_quotes", rows, OPTION_QUOTES, OPTION_KEY)

    def ingest_selected_options(self, listing: DataFrame, first: date, last: date,
                                landed: DataFrame) -> None:
        """``ingest_options`` for the contracts of a listing that are near the money on a priced
        stock day from ``first`` to ``last`` and expire on a Monday or Friday soon after.
        """
        days = between_days(self.stock_quotes, first, last).drop(DAY).filter("close is not null")
        self.ingest_options(contracts_to_ingest(days, listing), landed)

    def seed_options(self, contracts: DataFrame, after: date) -> None:
        """Rows to fetch for the contracts near the money on each stock day after ``after``."""
        days = self.stock_quotes.filter(F.col(DAY) > F.lit(after)).filter("close is not null")
        seeds = option_worklist(days.drop(DAY), contracts)
        self._insert("option_quotes", seeds, OPTION_QUOTES, OPTION_KEY)

    def refresh_options(self, landed: DataFrame, after: date, before: date,
                        limit: int | None = None) -> None:
        """Prices and derived values for the rows of unknown state, or the newest ``limit``."""
        options, stocks = (
            between_days(table, after, before).drop(DAY)
            for table in (self.option_quotes, self.stock_quotes)
        )
        rows = ingest.option_refresh(options, stocks, landed, after, before, limit)
        self._replace("option_quotes", rows, OPTION_QUOTES)

    def ingest_atm_vintages(self, vintages: DataFrame, contracts: DataFrame,
                            landed: DataFrame) -> None:
        """Prices and derived values of each vintage's at-the-money quotes."""
        options, stocks = (
            self._span(table, vintages, "sd", "ed")
            for table in (self.option_quotes, self.stock_quotes)
        )
        rows = ingest.atm_vintage_refresh(vintages, stocks, contracts, options, landed)
        once = with_natural_id(rows.drop("sd", "ed").dropDuplicates(["ticker", "dt"]), OPTION_KEY)
        self._replace("option_quotes", once, OPTION_QUOTES)

    def derive_late(self, first: date, last: date) -> None:
        """Derived values for the quotes from ``first`` to ``last`` that were priced before their
        underlying."""
        options, stocks = (between_days(table, first, last).drop(DAY) for table in (self.option_quotes, self.stock_quotes))
        self._replace("option_quotes", ingest.late_spot(options, stocks), OPTION_QUOTES)

    def generate_spreads(self, first: date, last: date, gaps=GAPS) -> None:
        """Calendar spreads of all sessions from ``first`` to ``last``, but for those that
        ``doubled_quotes`` lists.
        """
        quotes = between_days(self.option_quotes, first, last)
        self._insert("strategy_timespreads", all_day_spreads(quotes, gaps),
                     STRATEGY_TIMESPREADS, SPREAD_KEY)

    def key_violations(self) -> dict[str, DataFrame]:
        """Per table the keys stored more than once; all empty unless someone wrote beside
        these jobs.
        """
        return {name: key_violations(table, key) for name, table, key in (
            ("stock_quotes", self.stock_quotes, STOCK_KEY),
            ("option_quotes", self.option_quotes, OPTION_KEY),
            ("strategy_timespreads", self.timespreads, SPREAD_KEY))}

    def doubled_quotes(self, first: date, last: date) -> DataFrame:
        """Grains shared by several quotes, of which no spread is made."""
        return set_aside(between_days(self.option_quotes, first, last))

    def analyse_spreads(self, first: date, last: date) -> DataFrame:
        """Differences of the stored spreads from ``first`` to ``last``; only those days are read."""
        return analyse_stored(between_days(self.timespreads, first, last),
                              between_days(self.option_quotes, first, last))
