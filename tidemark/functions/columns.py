"""Small column expressions: guards, clocks, clips and logs."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import MARKET_ZONE

SESSIONS_PER_YEAR = 252
DAYS_PER_YEAR = 365.0


def col(c: str | Column) -> Column:
    """A column from its name; dots in a name are not struct access."""
    return F.col(f"`{c}`") if isinstance(c, str) else c


def winsorize(value: Column, limit: float) -> Column:
    """Clip to [-limit, limit]. NaN stays NaN, where least/greatest would turn it into a limit."""
    clipped = F.least(F.greatest(value, F.lit(-limit)), F.lit(limit))
    return F.when(F.isnan(value), value).otherwise(clipped)


def ratio(top: Column, bottom: Column) -> Column:
    """Division that gives null on a zero divisor."""
    return F.try_divide(top, bottom)


def finite(value: str | Column) -> Column:
    """True for a non-null value that is neither NaN nor infinite."""
    c = col(value)
    return (
        c.isNotNull() & ~F.isnan(c) & (c != F.lit(float("inf"))) & (c != F.lit(float("-inf")))
    )


def nan_to_null(value: str | Column) -> Column:
    c = col(value)
    return F.when(~F.isnan(c), c)


def days_between(later: str | Column, earlier: str | Column) -> Column:
    return F.datediff(col(later), col(earlier))


def moneyness(strike: str | Column, spot: str | Column) -> Column:
    """|K / S - 1|; null when the spot is zero."""
    return F.abs(ratio(col(strike), col(spot)) - F.lit(1.0))


def market_clock(stamp: str | Column, dtype: str, zone: str = MARKET_ZONE) -> Column:
    """Wall-clock time on the exchange.

    `dtype` is the Spark type name of `stamp`. A zoned instant is moved to `zone`
    whatever the session's own zone is; a stamp without zone is market time already.
    """
    c = col(stamp)
    if dtype == "timestamp":
        return F.convert_timezone(None, F.lit(zone), c.cast("timestamp_ntz"))
    return c


def market_date(stamp: str | Column, dtype: str, zone: str = MARKET_ZONE) -> Column:
    return F.to_date(market_clock(stamp, dtype, zone))


def in_window(
    df: DataFrame, start: date | None = None, end: date | None = None, column: str = "date"
) -> DataFrame:
    """Rows dated in the inclusive window; either bound may be open. Of another `column`, its values."""
    if start is not None:
        df = df.where(F.col(column) >= F.lit(start))
    if end is not None:
        df = df.where(F.col(column) <= F.lit(end))
    return df


def dtype_of(df, name: str) -> str:
    return dict(df.dtypes)[name]
