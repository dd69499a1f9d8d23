"""Back-minus-front differences over a frame with ``_f`` and ``_b`` columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def back_minus_front(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Adds ``{name}_diff = {name}_b - {name}_f`` for each name."""
    return df.withColumns({f"{n}_diff": F.col(f"{n}_b") - F.col(f"{n}_f") for n in names})


def quote_diffs(df: DataFrame) -> DataFrame:
    """Volatility, delta and theta differences of a spread."""
    return back_minus_front(df, ("iv", "delta", "theta"))


def mid_and_width(df: DataFrame) -> DataFrame:
    """Per leg the mid price and the bid-ask width, and their differences."""
    out = df
    for leg in ("f", "b"):
        ask, bid = F.col(f"ask_{leg}"), F.col(f"bid_{leg}")
        out = out.withColumns({f"mid_{leg}": (ask + bid) / 2, f"width_{leg}": ask - bid})
    return back_minus_front(out, ("mid", "width"))
