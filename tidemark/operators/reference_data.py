"""Small vendor tables made tidy: actions, earnings, rates, yields, indices, sectors, prices."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import dtype_of, market_clock
from tidemark.functions.groups import first_row, least_row
from tidemark.operators.symbols import spelled

# The exchange's hours as fractions of a day's hours.
MARKET_OPEN_HOUR = 9.5
MARKET_CLOSE_HOUR = 16.0
# Yield indices and their tenors.
YIELD_TENORS = {"^IRX": "13w", "^FVX": "5y", "^TNX": "10y", "^TYX": "30y"}


def tidy_prices(
    wide: DataFrame, fields: Mapping[str, str], tickers: Sequence[str], date: str = "Date"
) -> DataFrame:
    """A wide multi-header price download as `(yahoo_symbol, date, yahoo_close, ...)`.

    The landed columns are named `<field>|<ticker>`; `fields` maps a field to its output name.
    Rows without a close leave.
    """
    there, none = set(wide.columns), F.lit(None).cast("double")
    if not tickers:
        empty = [none.alias(out) for out in fields.values()]
        return wide.select(F.lit("").alias("yahoo_symbol"), F.to_date(date).alias("date"), *empty).where(F.lit(False))
    # one array per field, generated by position: the names travel once, not with each row
    lists = {out: F.array(*[F.col(f"`{f}|{t}`").cast("double") if f"{f}|{t}" in there else none for t in tickers]) for f, out in fields.items()}
    first, *others = fields.values()
    held = wide.select(F.to_date(date).alias("date"), *[c.alias(f"_{out}") for out, c in lists.items()])
    tall = held.select("date", F.posexplode(f"_{first}").alias("_at", first), *[f"_{out}" for out in others])
    return tall.select(
        F.get(F.lit(list(tickers)), F.col("_at")).alias("yahoo_symbol"),
        "date",
        first,
        *[F.get(f"_{out}", F.col("_at")).alias(out) for out in others],
    ).where(F.col("yahoo_close").isNotNull())


def build_actions(quotes: DataFrame, names: DataFrame) -> DataFrame:
    """`(symbol, date, action, value)`: positive splits and dividends as rows."""
    named = quotes.join(
        names.select(F.col("option_symbol").alias("symbol"), "yahoo_symbol"), "yahoo_symbol", "inner"
    )
    return (
        named.select("symbol", "date", "split", "dividend")
        .unpivot(["symbol", "date"], ["split", "dividend"], "action", "value")
        .where(F.col("value") > 0)
    )


def classify_session(df: DataFrame, stamp: str = "announced_at") -> DataFrame:
    """Add `date` and `session`: after the close (`amc`), before the open (`bmo`), else `unknown`."""
    clock = market_clock(stamp, dtype_of(df, stamp))
    hour = F.hour(clock) + F.minute(clock) / F.lit(60.0)
    return df.withColumns(
        {
            "date": F.to_date(clock),
            "session": F.when(hour >= MARKET_CLOSE_HOUR, F.lit("amc"))
            .when(hour < MARKET_OPEN_HOUR, F.lit("bmo"))
            .otherwise(F.lit("unknown")),
        }
    )


def earnings_table(announcements: DataFrame) -> DataFrame:
    """One announcement per (symbol, date), the earliest of the day."""
    rows = classify_session(announcements).select(
        "symbol",
        "date",
        "session",
        "announced_at",
        *[F.col(c).cast("double").alias(c) for c in ("eps_estimate", "reported_eps", "surprise_pct")],
    )
    return least_row(rows, ["symbol", "date"], [F.col("announced_at")])


def _percent(df: DataFrame, keys: list[str], value: str, source: str) -> DataFrame:
    rate = (F.col(source).cast("double") / F.lit(100.0)).alias(value)
    rows = df.select(*keys, rate)
    known = rows.where(F.col(f"`{value}`").isNotNull() & ~F.isnan(f"`{value}`"))
    return first_row(known, keys, [])


def tidy_rates(raw: DataFrame) -> DataFrame:
    """`(date, symbol, rate)` as decimals, one row per key."""
    dated = raw.select(F.to_date("created").alias("date"), "symbol", "rate")
    rows = dated.select("date", "symbol", (F.col("rate").cast("double") / F.lit(100.0)).alias("rate"))
    return first_row(rows, ["date", "symbol"], [])


def tidy_yields(raw: DataFrame, tenors: Mapping[str, str] = YIELD_TENORS) -> DataFrame:
    """`(date, tenor, yield)` as decimals; null and NaN quotes leave."""
    pairs = [F.lit(x) for pair in tenors.items() for x in pair]
    named = raw.select(
        F.to_date("date").alias("date"), F.create_map(*pairs)[F.col("ticker")].alias("tenor"), "close"
    ).where(F.col("tenor").isNotNull())
    return _percent(named, ["date", "tenor"], "yield", "close")


def tidy_indices(raw: DataFrame) -> DataFrame:
    """`(date, symbol, open, high, low, close)`, one row per key."""
    rows = raw.select(
        F.to_date(market_clock("created", dtype_of(raw, "created"))).alias("date"),
        "symbol",
        "open",
        "high",
        "low",
        "close",
    )
    return first_row(rows, ["date", "symbol"], [])


def sector_snapshot(
    constituents: DataFrame,
    overrides: Mapping[str, Mapping[str, str]] | None = None,
    columns: tuple[str, str, str] = ("Symbol", "GICS Sector", "GICS Sub-Industry"),
) -> DataFrame:
    """`(ticker, symbol, sector, sub_industry)` of today's members."""
    ticker, sector, sub = [F.col(f"`{c}`") for c in columns]
    return (
        constituents.select(
            ticker.alias("ticker"), sector.alias("sector"), sub.alias("sub_industry")
        )
        .where(F.col("ticker").isNotNull())
        .select("ticker", _option_spelling(overrides).alias("symbol"), "sector", "sub_industry")
    )


def _option_spelling(overrides: Mapping[str, Mapping[str, str]] | None) -> Column:
    return spelled("ticker", "option", overrides)
