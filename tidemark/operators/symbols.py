"""One ticker, several spellings: who was a member when, and what each source calls it."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import col, in_window

# Tickers another source lists under a different name, and tickers it does not serve.
TICKER_OVERRIDES = {"stock": {"BNY": "BK"}, "option": {"BNY": "BK"}, "yahoo": {}}
UNAVAILABLE = {
    "stock": ("ECHO", "MRSH", "VMRK"),
    "option": ("ECHO", "MRSH", "VMRK", "NVR"),
    "yahoo": (),
}
# What the dot of a share class becomes.
DOT = {"stock": ".", "option": "", "yahoo": "-"}


def spelled(
    ticker: str | Column, asset: str, overrides: Mapping[str, Mapping[str, str]] | None = None
) -> Column:
    """`ticker` the way `asset` ("stock", "option" or "yahoo") spells it, as one expression."""
    renamed = col(ticker)
    table = (TICKER_OVERRIDES if overrides is None else overrides).get(asset, {})
    if table:
        pairs = [F.lit(x) for pair in table.items() for x in pair]
        renamed = F.coalesce(F.create_map(*pairs)[col(ticker)], col(ticker))
    return F.replace(renamed, F.lit("."), F.lit(DOT[asset]))


def universe_tickers(
    universe: DataFrame, start: date | None = None, end: date | None = None
) -> DataFrame:
    """Tickers that were members at some point of the window."""
    return in_window(universe, start, end).select("ticker").distinct()


def universe_symbols(
    universe: DataFrame,
    asset: str,
    start: date | None = None,
    end: date | None = None,
    unavailable: Iterable[str] | None = None,
    overrides: Mapping[str, Mapping[str, str]] | None = None,
) -> DataFrame:
    """`(symbol)`: members over the window as `asset` spells them.

    Names the source does not serve leave under their own ticker, before it is respelled.
    """
    gone = list(UNAVAILABLE[asset] if unavailable is None else unavailable)
    tickers = universe_tickers(universe, start, end)
    if gone:
        tickers = tickers.where(~F.col("ticker").isin(gone))
    return tickers.select(spelled("ticker", asset, overrides).alias("symbol")).distinct()


def symbol_map(
    universe: DataFrame,
    start: date | None = None,
    end: date | None = None,
    overrides: Mapping[str, Mapping[str, str]] | None = None,
) -> DataFrame:
    """Every ticker of the window in all spellings; nothing is left out."""
    return universe_tickers(universe, start, end).select(
        "ticker", *[spelled("ticker", a, overrides).alias(f"{a}_symbol") for a in DOT]
    )
