"""Small hand-made quote frames."""

from datetime import date, datetime, timedelta

SCHEMA = ("id long, dt timestamp, ticker string, underlying_ticker string, option_type string, "
          "strike double, dte int, exp_date date, close double, iv double, delta double, "
          "theta double")


def quote(id, dte, strike=460.0, side="call", underlying="SPY", day=date(2022, 1, 21), **other):
    exp = day + timedelta(days=dte) if dte is not None else None
    row = {
        "id": id, "dt": datetime(day.year, day.month, day.day, 21), "ticker": f"T{id}",
        "underlying_ticker": underlying, "option_type": side, "strike": strike, "dte": dte,
        "exp_date": exp, "close": 1.0, "iv": 0.2, "delta": 0.5, "theta": -1.0,
    }
    row.update(other)
    return row


def frame(spark, rows):
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], SCHEMA)
