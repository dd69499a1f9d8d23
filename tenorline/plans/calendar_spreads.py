"""Calendar spreads of every session."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tenorline.functions.trading_days import is_session
from tenorline.operators.merge import new_rows
from tenorline.operators.structures import chain_spreads, doubled_grains
from tenorline.schema import SPREAD_KEY
from tenorline.sources.tables import day_of

GAPS = (3, 7, 4)


def all_day_spreads(quotes: DataFrame, gaps=GAPS, *, strict: bool = False) -> DataFrame:
    """All gaps over all sessions in one shuffle; no loop over days.

    The quote table's key does not make the grain unique: two roots of one underlying may
    share strike, side and expiry. Pairs that such a grain takes part in are set aside, and
    ``set_aside`` lists the grains; with ``strict`` they raise.
    """
    return chain_spreads(quotes.filter(is_session(day_of(quotes))), gaps, strict=strict)


def set_aside(quotes: DataFrame) -> DataFrame:
    """The doubled grains of all sessions, each with the number of its quotes."""
    return doubled_grains(quotes.filter(is_session(day_of(quotes))))


def spreads_to_store(quotes: DataFrame, stored: DataFrame, gaps=GAPS) -> DataFrame:
    """Spreads not stored yet."""
    return new_rows(stored, all_day_spreads(quotes, gaps), SPREAD_KEY, ("id_f", "id_b"))
