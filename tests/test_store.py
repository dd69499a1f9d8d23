"""The ingest jobs against stored tables, over a week of quotes."""

import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tenorline.plans.store import QuoteStore
from tenorline.session import scratch_dir

DAYS = [date(2022, 1, d) for d in (18, 19, 20, 21)]  # Monday the 17th is a holiday
EXPIRIES = [date(2022, 1, 28), date(2022, 1, 31), date(2022, 2, 4)]
SPOT = 437.98


def closing(day):
    return datetime(day.year, day.month, day.day, 21)


def bar(ticker, day, close):
    return (ticker, closing(day), json.dumps({
        "status": "OK", "from": day.isoformat(), "symbol": ticker, "open": close, "high": close,
        "low": close, "close": close, "volume": 10, "afterHours": close, "preMarket": close}))


def nothing(ticker, day):
    return (ticker, closing(day), json.dumps({"status": "NOT_FOUND"}))


LANDED = "ticker string, dt timestamp, body string"


@pytest.fixture(scope="module")
def ranges(spark):
    return spark.createDataFrame([("SPY", date(2022, 1, 17), date(2022, 1, 21))],
                                 "ticker string, sd date, ed date")


@pytest.fixture(scope="module")
def contracts(spark):
    rows = [(f"{side[0]}{k}-{exp}", "SPY", side, float(k), exp, date(2022, 1, 18))
            for side in ("call", "put") for k in (435, 440) for exp in EXPIRIES]
    return spark.createDataFrame(rows, "ticker string, underlying_ticker string, "
                                 "option_type string, strike double, exp_date date, listed date")


def option_bars(spark, contracts, days, missing=()):
    rows = []
    for c in contracts.collect():
        for i, day in enumerate(days):
            rows.append(nothing(c["ticker"], day) if (c["ticker"], day) in missing
                        else bar(c["ticker"], day, 8.0 + i / 10))
    return spark.createDataFrame(rows, LANDED)


def test_stock_seed_refresh_and_ingest(spark, ranges):
    store = QuoteStore(spark, scratch_dir(spark, "store"))
    for _ in range(2):
        store.seed_stock(ranges)
        rows = store.stock_quotes.orderBy("dt").collect()
        assert [r["dt"] for r in rows] == [closing(d) for d in DAYS]
        assert not any(r["fetched"] for r in rows)
    landed = spark.createDataFrame([bar("SPY", d, SPOT) for d in DAYS[:3]], LANDED)
    for _ in range(2):
        store.refresh_stock(landed)
        rows = store.stock_quotes.orderBy("dt").collect()
        assert [r["fetched"] for r in rows] == [True, True, True, False]
        assert str(rows[0]["close"]) == "437.98" and rows[3]["close"] is None

    other = QuoteStore(spark, scratch_dir(spark, "store"))
    for _ in range(2):
        other.ingest_stock(ranges, landed)
        assert sorted(r["dt"] for r in other.stock_quotes.collect()) == [
            closing(d) for d in DAYS[:3]]


@pytest.fixture(scope="module")
def store(spark, ranges):
    built = QuoteStore(spark, scratch_dir(spark, "store"))
    built.ingest_stock(ranges, spark.createDataFrame([bar("SPY", d, SPOT) for d in DAYS], LANDED))
    return built


def test_option_ingest_and_spreads(spark, store, contracts):
    silent = ("c435-2022-01-28", DAYS[1])
    landed = option_bars(spark, contracts, DAYS, {silent})
    sessions = contracts.count()
    for _ in range(2):
        store.ingest_options(contracts, landed)
        rows = store.option_quotes
        assert rows.groupBy("dt", "ticker").count().filter("count > 1").isEmpty()
        traded = rows.filter("close is not null")
        assert traded.count() == sessions * len(DAYS) - 1
        assert traded.filter("iv is null or delta is null or dte is null").isEmpty()
        quiet = rows.filter((F.col("ticker") == silent[0]) & (F.col("dt") == F.lit(closing(silent[1]))))
        assert [(r["fetched"], r["iv"]) for r in quiet.collect()] == [(True, None)]
        assert rows.count() == sessions * len(DAYS)  # later sessions have no answer yet
    for _ in range(2):
        store.generate_spreads(DAYS[0], DAYS[-1])
        assert all(v.isEmpty() for v in store.key_violations().values())
        spreads = store.timespreads
        counts = {r["desc"]: r["count"] for r in spreads.groupBy("desc").count().collect()}
        # Per day, side and strike: 28 Jan/31 Jan, 31 Jan/4 Feb and 28 Jan/4 Feb; one quote
        # without a trade has no days to expiry and takes part in none.
        assert counts == {"3d_calendar_spy": 15, "4d_calendar_spy": 16, "7d_calendar_spy": 15}


def test_option_seed_and_refresh(spark, ranges, contracts, store):
    fresh = QuoteStore(spark, scratch_dir(spark, "store"))
    fresh.ingest_stock(ranges, spark.createDataFrame([bar("SPY", d, SPOT) for d in DAYS], LANDED))
    for _ in range(2):
        fresh.seed_options(contracts, date(2022, 1, 19))
        seeded = fresh.option_quotes
        assert seeded.count() == contracts.count() * 2
        assert seeded.filter("fetched is not null").isEmpty()
    landed = option_bars(spark, contracts, DAYS[2:], {("p440-2022-02-04", DAYS[3])})
    fresh.refresh_options(landed, date(2022, 1, 20) - timedelta(days=1), date(2022, 1, 23))
    states = {r["fetched"]: r["count"] for r in fresh.option_quotes.groupBy("fetched").count().collect()}
    assert states == {True: 24}
    unpriced = fresh.option_quotes.filter("fetched and iv is null").collect()
    assert [(r["ticker"], r["close"]) for r in unpriced] == [("p440-2022-02-04", None)]


def test_ingest_fills_waiting_rows_and_adds_the_rest(spark, ranges, contracts):
    mixed = QuoteStore(spark, scratch_dir(spark, "store"))
    mixed.ingest_stock(ranges, spark.createDataFrame([bar("SPY", d, SPOT) for d in DAYS], LANDED))
    mixed.seed_options(contracts, date(2022, 1, 20))
    before = {r["ticker"]: r["id"] for r in mixed.option_quotes.collect()}
    assert len(before) == contracts.count()
    mixed.ingest_options(contracts, option_bars(spark, contracts, DAYS))
    rows = mixed.option_quotes
    assert rows.filter("close is not null").count() == contracts.count() * len(DAYS)
    last = rows.filter(F.col("dt") == F.lit(closing(DAYS[3]))).collect()
    assert {r["ticker"]: r["id"] for r in last} == before and all(r["fetched"] for r in last)


def test_atm_vintage_fills_unpriced_quotes(spark, ranges):
    """Seeded quotes of the contracts struck at the first close get their price."""
    store = QuoteStore(spark, scratch_dir(spark, "store"))
    store.ingest_stock(ranges, spark.createDataFrame([bar("SPY", d, SPOT) for d in DAYS], LANDED))
    contracts = spark.createDataFrame(
        [(f"c{k}", "SPY", "call", float(k), EXPIRIES[0], date(2022, 1, 10)) for k in (437, 438, 439)],
        "ticker string, underlying_ticker string, option_type string, strike double, "
        "exp_date date, listed date")
    store.seed_options(contracts, date(2022, 1, 17))
    assert store.option_quotes.count() == 12
    vintages = spark.createDataFrame([("SPY", date(2022, 1, 17), date(2022, 1, 21))],
                                     "ticker string, sd date, ed date")
    landed = option_bars(spark, contracts, DAYS)
    store.ingest_atm_vintages(vintages, contracts, landed)
    # The week has no eleventh session yet, so nothing is at stake.
    assert store.option_quotes.filter("close is not null").isEmpty()
    from tenorline.operators.contracts import atm_vintage
    rows = atm_vintage(vintages, store.stock_quotes.drop("d"), contracts,
                       store.option_quotes.drop("d"), session=2)
    assert {(r["contract"], r["dt"]) for r in rows.collect()} == {
        ("c438", closing(d)) for d in DAYS}


def test_late_bars_are_stored_when_they_land(spark, ranges):
    """A session without a response stays open; a future one is not written at all."""
    late = QuoteStore(spark, scratch_dir(spark, "store"))
    late.ingest_stock(ranges, spark.createDataFrame([bar("SPY", d, SPOT) for d in DAYS], LANDED))
    contracts = spark.createDataFrame(
        [("c435", "SPY", "call", 435.0, date(2099, 1, 15), date(2022, 1, 18))],
        "ticker string, underlying_ticker string, option_type string, strike double, "
        "exp_date date, listed date")
    for landed, priced in ((DAYS[:1], 1), (DAYS[:1], 1), (DAYS[:3], 3)):
        late.ingest_options(contracts, spark.createDataFrame([bar("c435", d, 8.0) for d in landed], LANDED))
        rows = late.option_quotes
        assert rows.count() == priced and rows.filter("close is null or not fetched").isEmpty()


def test_seeded_sessions_get_their_prices(spark, ranges):
    seeded = QuoteStore(spark, scratch_dir(spark, "store"))
    seeded.seed_stock(ranges)
    ids = {r["dt"]: r["id"] for r in seeded.stock_quotes.collect()}
    landed = [bar("SPY", d, SPOT) for d in DAYS[:2]] + [nothing("SPY", DAYS[2])]
    for _ in range(2):
        seeded.ingest_stock(ranges, spark.createDataFrame(landed, LANDED))
        rows = seeded.stock_quotes.orderBy("dt").collect()
        assert [r["fetched"] for r in rows] == [True, True, True, False]
        assert [r["close"] is not None for r in rows] == [True, True, False, False]
        assert {r["dt"]: r["id"] for r in rows} == ids


def test_no_response_changes_nothing(spark, store, contracts):
    """Rows of unknown state keep their prices when no response, or one without data, has landed."""
    kept = QuoteStore(spark, scratch_dir(spark, "store"))
    kept.ingest_stock(spark.createDataFrame([("SPY", DAYS[0], DAYS[-1])], "ticker string, sd date, ed date"),
                      spark.createDataFrame([bar("SPY", d, SPOT) for d in DAYS], LANDED))
    kept.ingest_options(contracts, option_bars(spark, contracts, DAYS[:1]))
    path = f"{kept.root}/option_quotes"
    unknown = spark.createDataFrame(
        kept.option_quotes.drop("d").withColumn("fetched", F.lit(None).cast("boolean")).collect(),
        kept.option_quotes.drop("d").schema)
    from tenorline.sinks.parquet_tables import upsert_rows
    upsert_rows(spark, path, unknown, ("dt", "ticker"), ("id",))
    around = (DAYS[0] - timedelta(days=1), DAYS[-1])
    kept.refresh_options(spark.createDataFrame([], LANDED), *around)
    assert kept.option_quotes.filter("close is not null and fetched is null").count() == contracts.count()
    kept.refresh_options(spark.createDataFrame([nothing("c435-2022-01-28", DAYS[0])], LANDED), *around)
    row = kept.option_quotes.filter("ticker = 'c435-2022-01-28'").first()
    assert row["fetched"] and row["close"] is not None and row["iv"] is not None


def test_refresh_takes_all_that_landed(spark):
    big = QuoteStore(spark, scratch_dir(spark, "store"))
    ranges = spark.createDataFrame([("SPY", date(2019, 1, 1), date(2020, 12, 31))], "ticker string, sd date, ed date")
    big.seed_stock(ranges)
    asked = big.stock_quotes.collect()
    assert len(asked) > 500
    landed = spark.createDataFrame(
        [(r["ticker"], r["dt"], json.dumps({"status": "OK", "symbol": "SPY", "open": 1.0, "high": 1.0, "low": 1.0,
                                            "close": 1.0})) for r in asked], LANDED)
    big.refresh_stock(landed, limit=10)
    assert big.stock_quotes.filter("fetched").count() == 10
    big.refresh_stock(landed)
    assert big.stock_quotes.filter("not fetched").isEmpty()


def test_an_oversized_price_is_reported(spark, ranges):
    from tenorline.schema import STOCK_QUOTES, misfits
    wrong = QuoteStore(spark, scratch_dir(spark, "store"))
    landed = spark.createDataFrame([bar("SPY", DAYS[0], 1_234_567.0)], LANDED)
    with pytest.raises(Exception, match="does not fit decimal"):
        wrong.ingest_stock(ranges, landed)
    assert wrong.stock_quotes.isEmpty()
    rows = spark.createDataFrame([("SPY", 1_234_567.0, 1.0), ("SPY", 2.0, 1.0)], "ticker string, close double, open double")
    assert [r["columns"] for r in misfits(rows, STOCK_QUOTES).collect()] == [["close"]]


def test_absent_tables_and_failed_first_writes(spark, ranges, contracts, tmp_path):
    empty = QuoteStore(spark, str(tmp_path / "store"))
    empty.refresh_stock(spark.createDataFrame([bar("SPY", DAYS[0], SPOT)], LANDED))
    vintages = spark.createDataFrame([("SPY", DAYS[0], DAYS[-1])], "ticker string, sd date, ed date")
    empty.ingest_atm_vintages(vintages, contracts, option_bars(spark, contracts, DAYS))
    (tmp_path / "store" / "stock_quotes" / "_temporary" / "0").mkdir(parents=True, exist_ok=True)
    empty.ingest_stock(ranges, spark.createDataFrame([bar("SPY", d, SPOT) for d in DAYS], LANDED))
    assert empty.stock_quotes.count() == len(DAYS)
    assert not list((tmp_path / "store" / "_staging").iterdir())


def test_spreads_survive_a_doubled_chain(spark):
    """Two roots share one grain; every other spread is stored."""
    from tenorline.sinks.parquet_tables import append_new
    from tenorline.schema import OPTION_QUOTES, conform, with_natural_id
    two = QuoteStore(spark, scratch_dir(spark, "store"))
    rows = [(f"{root}{k}-{dte}", closing(DAYS[0]), "SPXW", "call", float(k), dte)
            for root, k, dtes in (("A", 400, (3, 6, 10)), ("B", 400, (6,)), ("A", 410, (3, 6))) for dte in dtes]
    quotes = spark.createDataFrame(rows, "ticker string, dt timestamp, underlying_ticker string, "
                                   "option_type string, strike double, dte int")
    append_new(spark, f"{two.root}/option_quotes", with_natural_id(conform(quotes, OPTION_QUOTES)), ("dt", "ticker"), ("id",))
    two.generate_spreads(DAYS[0], DAYS[0])
    assert sorted((r["ticker_f"], r["ticker_b"]) for r in two.timespreads.collect()) == [
        ("A400-3", "A400-10"), ("A410-3", "A410-6")]
    assert [(r["strike"], r["dte"], r["n"]) for r in two.doubled_quotes(DAYS[0], DAYS[0]).collect()] == [(400, 6, 2)]


def test_stored_analysis_reads_its_days_only(spark, store, contracts):
    store.ingest_options(contracts, option_bars(spark, contracts, DAYS))
    store.generate_spreads(DAYS[0], DAYS[-1])
    analysed = store.analyse_spreads(DAYS[1], DAYS[1])
    plan = analysed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(d") == 3 or plan.count("PartitionFilters: [(d") == 3 or "d#" in plan
    assert {r["dt"] for r in analysed.collect()} <= {DAYS[1]}


def test_contract_selection_feeds_the_ingest(spark, ranges):
    chosen = QuoteStore(spark, scratch_dir(spark, "store"))
    chosen.ingest_stock(ranges, spark.createDataFrame([bar("SPY", d, SPOT) for d in DAYS], LANDED))
    listing = spark.createDataFrame(
        [(f"{side}{k}-{exp}", "SPY", side, float(k), exp, day)
         for side in ("call", "put") for k in (430, 435, 436, 440) for exp in (*EXPIRIES, date(2022, 1, 26), date(2022, 6, 17))
         for day in (date(2022, 1, 10), date(2022, 1, 18))],
        "ticker string, underlying_ticker string, option_type string, strike double, exp_date date, listed date")
    landed = spark.createDataFrame([bar(t["ticker"], DAYS[1], 8.0) for t in listing.select("ticker").distinct().collect()], LANDED)
    chosen.ingest_selected_options(listing, DAYS[0], DAYS[-1], landed)
    # The close rounds to 440, so 435 is the strike; 26 January is a Wednesday, June too far out.
    assert sorted(r["ticker"] for r in chosen.option_quotes.collect()) == sorted(
        f"{side}435-{exp}" for side in ("call", "put") for exp in EXPIRIES)


def test_vintages_with_one_start_and_two_ends(spark):
    from tenorline.operators.contracts import atm_vintage
    stock = spark.createDataFrame([("SPY", closing(d), 438.2) for d in DAYS], "ticker string, dt timestamp, close double")
    contracts = spark.createDataFrame(
        [("c438", "SPY", "call", 438.0, EXPIRIES[0], date(2022, 1, 10))] * 2,
        "ticker string, underlying_ticker string, option_type string, strike double, exp_date date, listed date")
    vintages = spark.createDataFrame([("SPY", DAYS[0], DAYS[1]), ("SPY", DAYS[0], DAYS[3])], "ticker string, sd date, ed date")
    stored = spark.createDataFrame([], "ticker string, dt timestamp, close double")
    rows = atm_vintage(vintages, stock, contracts, stored, session=3)
    assert [(r["ed"], r["dt"]) for r in rows.collect()] == [(DAYS[3], closing(DAYS[2]))]


def test_a_price_that_lands_before_its_underlying(spark, ranges, contracts):
    """Bar first, spot later: the quote is stored and gets its derived values afterwards."""
    late = QuoteStore(spark, scratch_dir(spark, "store"))
    landed = option_bars(spark, contracts, DAYS, {("c435-2022-01-28", DAYS[1])})
    late.ingest_options(contracts, landed)
    rows = late.option_quotes
    assert rows.filter("fetched and close is not null").count() == contracts.count() * len(DAYS) - 1
    assert rows.filter("iv is not null").isEmpty()
    late.derive_late(DAYS[0], DAYS[-1])
    assert late.option_quotes.filter("iv is not null").isEmpty()
    late.ingest_stock(ranges, spark.createDataFrame([bar("SPY", d, SPOT) for d in DAYS[:2]], LANDED))
    for _ in range(2):
        late.derive_late(DAYS[0], DAYS[-1])
        derived = late.option_quotes.filter("iv is not null and delta is not null")
        assert {r["dt"] for r in derived.collect()} == {closing(d) for d in DAYS[:2]}
        assert late.option_quotes.count() == contracts.count() * len(DAYS)
    late.ingest_stock(ranges, spark.createDataFrame([bar("SPY", d, SPOT) for d in DAYS], LANDED))
    late.derive_late(DAYS[0], DAYS[-1])
    # As if the prices had landed in order.
    inorder = QuoteStore(spark, scratch_dir(spark, "store"))
    inorder.ingest_stock(ranges, spark.createDataFrame([bar("SPY", d, SPOT) for d in DAYS], LANDED))
    inorder.ingest_options(contracts, landed)
    read = lambda s: sorted(map(str, s.option_quotes.drop("d").collect()))
    assert read(late) == read(inorder)
    assert all(v.isEmpty() for v in late.key_violations().values())
