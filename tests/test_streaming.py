import json
from datetime import date, datetime

from tenorline.operators.contracts import listed_once
from tenorline.session import scratch_dir
from tenorline.sinks.parquet_tables import write_table
from tenorline.sources.tables import read_table
from tenorline.streaming.ingest import LANDED_CONTRACTS, enriched_quotes, first_listings, hourly_last_quote, insert_ignore_into, landed_stream, to_files

SCHEMA = "id long, dt timestamp, ticker string, close double"
KEY = ("dt", "ticker")


def rows(spark, *items):
    return spark.createDataFrame(list(items), SCHEMA)


def test_insert_ignore_over_batches_and_replays(spark):
    landed = scratch_dir(spark, "landed")
    table = scratch_dir(spark, "table")
    dt = datetime(2022, 1, 21, 21)
    write_table(rows(spark, (1, dt, "A", 1.0)), table)
    schema = rows(spark).schema

    def run(checkpoint):
        insert_ignore_into(landed_stream(spark, landed, schema), table, KEY, ("id",),
                           checkpoint).awaitTermination()
        return sorted((r["ticker"], r["close"]) for r in read_table(spark, table).collect())

    checkpoint = scratch_dir(spark, "checkpoint")
    rows(spark, (2, dt, "A", 9.0), (3, dt, "B", 2.0)).write.mode("append").json(landed)
    assert run(checkpoint) == [("A", 1.0), ("B", 2.0)]
    rows(spark, (4, dt, "B", 8.0), (5, dt, "C", 3.0)).write.mode("append").json(landed)
    assert run(checkpoint) == [("A", 1.0), ("B", 2.0), ("C", 3.0)]
    # A lost checkpoint replays everything; nothing is added twice.
    assert run(scratch_dir(spark, "checkpoint")) == [("A", 1.0), ("B", 2.0), ("C", 3.0)]


def test_late_samples_are_dropped(spark):
    landed = scratch_dir(spark, "samples")
    out, checkpoint = scratch_dir(spark, "last"), scratch_dir(spark, "checkpoint")
    schema = "n long, sample_ts timestamp, symbol string, bid double"

    def land(*items):
        spark.createDataFrame(list(items), schema).write.mode("append").json(landed)
        stream = landed_stream(spark, landed, spark.createDataFrame([], schema).schema)
        last = hourly_last_quote(stream, ("bid",), ("sample_ts", "n"))
        to_files(last, out, checkpoint).awaitTermination()
        return sorted((r["window_start"].hour, r["symbol"], r["bid"])
                      for r in spark.read.schema(last.schema).parquet(out).collect())

    def at(hour, minute):
        return datetime(2022, 1, 21, hour, minute)

    assert land((1, at(20, 5), "S", 1.0), (2, at(20, 50), "S", None), (3, at(21, 30), "S", 5.0)) == [
        (20, "S", 1.0)]
    assert land((4, at(20, 55), "S", 9.0), (5, at(22, 30), "S", 6.0)) == [
        (20, "S", 1.0), (21, "S", 5.0)]


def test_a_contract_is_given_out_at_its_first_listing(spark):
    landed = scratch_dir(spark, "landed-contracts")
    out, checkpoint = scratch_dir(spark, "listings"), scratch_dir(spark, "checkpoint")

    def land(day, *tickers, exp="2022-03-18"):
        listed = [{"ticker": c, "underlying_ticker": "SPY", "contract_type": "call", "strike_price": 440.0,
                   "expiration_date": exp} for c in tickers]
        spark.createDataFrame([(day, json.dumps({"results": listed}))], "dt date, body string").write.mode("append").json(landed)

    def run(out, checkpoint):
        stream = first_listings(landed_stream(spark, landed, LANDED_CONTRACTS))
        to_files(stream, out, checkpoint).awaitTermination()
        return spark.read.schema(stream.schema).parquet(out)

    def content(df):
        return sorted((r["ticker"], r["listed"].day) for r in df.collect())

    land(date(2022, 1, 5), "A")
    land(date(2022, 1, 3), "A", "B")
    assert content(run(out, checkpoint)) == [("A", 3), ("B", 3)]
    land(date(2022, 1, 10), "A", "B", "C")  # only C is new
    land(date(2022, 1, 11))
    assert content(run(out, checkpoint)) == [("A", 3), ("B", 3), ("C", 10)]
    land(date(2022, 1, 7), "C")  # an earlier day arrives late: C is given out again
    given = run(out, checkpoint)
    assert content(given) == [("A", 3), ("B", 3), ("C", 7), ("C", 10)]
    assert content(listed_once(given)) == [("A", 3), ("B", 3), ("C", 7)]
    # A lost checkpoint replays everything and comes to the same contracts.
    again = run(scratch_dir(spark, "listings"), scratch_dir(spark, "checkpoint"))
    assert content(listed_once(again)) == [("A", 3), ("B", 3), ("C", 7)]


def test_expired_contracts_leave_the_state(spark):
    landed, out, checkpoint = (scratch_dir(spark, n) for n in ("landed-contracts", "listings", "checkpoint"))

    def land(day, ticker, exp):
        body = json.dumps({"results": [{"ticker": ticker, "underlying_ticker": "SPY", "contract_type": "call",
                                        "strike_price": 440.0, "expiration_date": exp}]})
        spark.createDataFrame([(day, body)], "dt date, body string").write.mode("append").json(landed)
        stream = first_listings(landed_stream(spark, landed, LANDED_CONTRACTS), delay="1 day")
        query = to_files(stream, out, checkpoint)
        query.awaitTermination()
        return max(op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"][-1:])

    assert land(date(2022, 1, 3), "A", "2022-01-05") == 1
    assert land(date(2022, 2, 3), "B", "2022-03-18") == 2
    land(date(2022, 2, 4), "C", "2022-03-18")
    stream = first_listings(landed_stream(spark, landed, LANDED_CONTRACTS), delay="1 day")
    query = to_files(stream, out, checkpoint)
    query.awaitTermination()
    assert sorted(r["ticker"] for r in spark.read.schema(stream.schema).parquet(out).collect()) == ["A", "B", "C"]
    progress = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert not progress or progress[-1] == 2


def test_quotes_wait_for_their_spot(spark):
    landed, prices = scratch_dir(spark, "quotes"), scratch_dir(spark, "spots")
    out, checkpoint = scratch_dir(spark, "enriched"), scratch_dir(spark, "checkpoint")
    first, later = datetime(2022, 1, 21, 21), datetime(2022, 2, 18, 21)
    quoted = "dt timestamp, ticker string, underlying_ticker string, option_type string, strike double, exp_date date, close double, iv double"
    priced = "dt timestamp, ticker string, close double"

    def quote(ticker, underlying, dt=first):
        return (dt, ticker, underlying, "call", 100.0, date(2022, 3, 18), 5.0, 9.9)

    def land(quotes, spots):
        spark.createDataFrame(quotes, quoted).write.mode("append").json(landed)
        spark.createDataFrame(spots, priced).write.mode("append").json(prices)
        stream = enriched_quotes(landed_stream(spark, landed, spark.createDataFrame([], quoted).schema),
                                 landed_stream(spark, prices, spark.createDataFrame([], priced).schema), "10 days")
        to_files(stream, out, checkpoint).awaitTermination()
        rows = spark.read.schema(stream.schema).parquet(out).collect()
        return sorted((r["ticker"], r["spot"], r["iv"] is not None) for r in rows)

    # A null price has not landed; the second price of an instant changes nothing.
    assert land([quote("A1", "A"), quote("B1", "B"), quote("C1", "C")],
                [(first, "C", 101.0), (first, "C", 55.0), (first, "A", None)]) == [("C1", 101.0, True)]
    assert land([quote("C2", "C")], [(first, "A", 102.0)]) == [("A1", 102.0, True), ("C1", 101.0, True), ("C2", 101.0, True)]
    # B's price never lands: once the watermark has passed, its quote is given out without one.
    done = [("A1", 102.0, True), ("B1", None, False), ("C1", 101.0, True), ("C2", 101.0, True), ("D1", 103.0, True)]
    assert land([quote("D1", "D", later)], [(later, "D", 103.0)]) == done
    # A price later than the delay changes nothing, and neither does a run without new files.
    assert land([], [(first, "B", 99.0)]) == done
