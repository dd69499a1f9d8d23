"""Two real quotes with known spread and volatilities."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tenorline.functions.black_scholes import implied_vol, year_fraction
from tenorline.operators.structures import friday_monday
from tenorline.schema import OPTION_QUOTES, conform
from tenorline.sources.tables import read_csv

# Two real quotes as they were recorded.
CSV = """,id,dt,ticker,close,exp_date,dte,strike,underlying_ticker,iv,option_type,fetched
0,1571,2022-01-21 21:00:00+00:00,O:SPY220128C00460000,0.4,2022-01-28,7,460.0,SPY,0.1928,call,True
1,1589,2022-01-21 21:00:00+00:00,O:SPY220131C00460000,0.58,2022-01-31,10,460.0,SPY,0.1759,call,True
"""


@pytest.fixture(scope="module")
def quotes(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("csv") / "fm.csv"
    path.write_text(CSV)
    wanted = CSV.splitlines()[0].split(",")[1:]
    from pyspark.sql import types as T
    by_name = {f.name: f for f in OPTION_QUOTES.fields}
    schema = T.StructType([by_name[n] for n in wanted])
    return read_csv(spark, str(path), schema, index_column=True)


def test_csv_types(quotes):
    row = quotes.orderBy("id").first()
    assert row["dt"] == datetime(2022, 1, 21, 21) and row["exp_date"] == date(2022, 1, 28)
    assert row["fetched"] is True and str(row["strike"]) == "460.00"


@pytest.mark.parametrize("unique", [False, True])
def test_one_spread(quotes, unique):
    rows = friday_monday(quotes, unique_grain=unique).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row["id_f"], row["id_b"], row["desc"]) == (1571, 1589, "3d_calendar_spy")
    assert row["dt"] == datetime(2022, 1, 21, 21)


def test_volatilities(quotes):
    solved = quotes.select("iv", F.round(implied_vol(
        F.col("close"), F.lit(437.98), F.col("strike"), year_fraction(F.col("dte")),
        F.col("option_type")), 4).alias("solved"))
    for row in solved.collect():
        assert float(row["iv"]) == row["solved"]


def test_conform_fills_and_rounds(quotes):
    rows = conform(quotes.withColumn("delta", F.lit(0.485)), OPTION_QUOTES)
    assert rows.schema.names == OPTION_QUOTES.names
    row = rows.first()
    assert str(row["delta"]) == "0.49" and row["gamma"] is None
