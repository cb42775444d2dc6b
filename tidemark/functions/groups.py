"""Grouped picks and per-date statistics that stay distributed when a group is hot."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import col


def broadcast_daily(df: DataFrame, date: str = "date") -> DataFrame:
    """Broadcast a frame that holds one row of plain scalars per calendar date.

    Its size is bounded by the calendar (some 250 rows a year), not by the data. Callers
    pass the result of a `groupBy(date)`; anything not keyed by a DATE is refused.
    """
    if not isinstance(df.schema[date].dataType, T.DateType):
        raise TypeError(f"{date} is not a DATE column, so its row count has no bound")
    wide = [f.name for f in df.schema if isinstance(f.dataType, (T.MapType, T.StructType))]
    if wide:
        raise TypeError(f"columns {wide} have no size bound")
    return F.broadcast(df)


def attach_daily(df: DataFrame, *stats: Column, date: str = "date", how: str = "left") -> DataFrame:
    """Add per-date aggregates to every row.

    The aggregates are combined map-side and joined back by broadcast, so a date that
    holds a large share of the rows is never gathered in one task, as a window
    partitioned by the date would.
    """
    daily = df.groupBy(date).agg(*stats)
    return df.join(broadcast_daily(daily, date), date, how)


@dataclass(frozen=True)
class Whole:
    """An order key as a whole number from 0 to 2**bits - 2, smaller ones first. Null counts as below 0, other
    numbers outside as the nearest end."""

    column: Column
    bits: int

    def packed(self) -> Column:
        held = F.least(F.greatest(self.column.cast("bigint"), F.lit(0)), F.lit((1 << self.bits) - 2))
        return F.coalesce(F.when(self.column.isNotNull(), held + 1), F.lit(0)).cast("bigint")


#: Days from the first of year 1 to 1970.
_YEAR_1 = 719_162


def by_day(c: str | Column) -> Whole:
    return Whole(F.unix_date(col(c)) + _YEAR_1, 22)


def by_price(c: str | Column) -> Whole:
    """Prices from 0 to 8 million in steps of 2**-20, finer than any tick."""
    return Whole(F.floor(col(c) * F.lit(float(1 << 20))), 43)


def by_fraction(c: Column) -> Whole:
    """Doubles from 0 to 1 that come of a subtraction from or by a number of at least 0.5: multiples of 2**-54, exactly."""
    return Whole(c * F.lit(float(1 << 54)), 55)


def by_count(c: str | Column, bits: int = 32) -> Whole:
    return Whole(col(c), bits)


def by_letter(c: str | Column) -> Whole:
    """The first character, of ASCII."""
    return Whole(F.ascii(col(c)), 8)


def by_stamp(c: str | Column, dtype: str) -> Whole:
    """Microseconds of a stamp with or without a zone, from year 1 on; `dtype` is its Spark type."""
    if dtype == "timestamp":
        return Whole(F.unix_micros(col(c)) + F.lit(1 << 56), 59)
    days = (F.unix_date(F.to_date(col(c))) + _YEAR_1).cast("bigint")
    return Whole(days * 86_400_000_000 + by_clock(c).column, 59)


def by_clock(c: str | Column) -> Whole:
    """Microseconds into the day of a stamp without a zone, for groups that are of one day."""
    second = F.date_part(F.lit("SECONDS"), col(c)) * 1_000_000
    return Whole((F.hour(col(c)) * 3600 + F.minute(col(c)) * 60).cast("bigint") * 1_000_000 + second.cast("bigint"), 37)


def last(key: Whole) -> Whole:
    """The same key, larger numbers first and null last."""
    top = F.lit((1 << key.bits) - 1)
    return Whole(top - key.packed() - 1, key.bits)


#: Bits of a signed long, and of a 38-digit decimal, that an order can take; least bits for the tie-break.
_LONG, _DECIMAL, _TIE = 62, 126, 24


def order_number(order: Sequence[Whole], values: Sequence[str]) -> Column:
    """All keys of an order, one behind the other, in one number of fixed width: a long where they fit, else a decimal.

    The bits left are a hash of the values, so rows that agree in every key still give one answer whatever
    the row order is.
    """
    bits = sum(k.bits for k in order)
    room = _LONG if bits + _TIE <= _LONG else _DECIMAL
    if bits > room:
        raise ValueError(f"an order of {bits} bits is too wide")
    tie = min(room - bits, 60)
    pieces = [(k.packed(), k.bits) for k in order]
    if values and tie:
        hashed = F.xxhash64(*[col(v) for v in values]).bitwiseAND(F.lit((1 << tie) - 1))
        pieces.append((hashed, tie))
    number = None
    for piece, width in pieces:
        if room == _LONG:
            number = piece if number is None else F.shiftleft(number, width) + piece
        else:
            wide = piece.cast("decimal(20,0)")
            number = wide if number is None else (number * F.lit(Decimal(1 << width))).cast("decimal(38,0)") + wide
            number = number.cast("decimal(38,0)")
    return F.lit(0) if number is None else number


def first_row(
    df: DataFrame, keys: Sequence[str], order: Sequence[Whole], keep: Sequence[str] | None = None
) -> DataFrame:
    """One row per key: the first in `order`, by an arg-min that is combined map-side.

    The order is a number of fixed width (`order_number`), so with kept columns of fixed width (numbers,
    dates, stamps) the aggregate is hashed and nothing is sorted. All of them are of the same row. Without an
    order, any one row is taken, and the least value where a single column is kept.
    """
    values = list(keep) if keep is not None else [c for c in df.columns if c not in keys]
    if not order and len(values) == 1:
        return df.groupBy(*[col(k) for k in keys]).agg(F.min(col(values[0])).alias(values[0]))
    at = df.select(*[col(c) for c in {*keys, *values}], order_number(order, values).alias("_order"))
    return at.groupBy(*[col(k) for k in keys]).agg(*[F.min_by(col(v), "_order").alias(v) for v in values])


def least_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = (), keep: Sequence[str] | None = None) -> DataFrame:
    """As `first_row`, for orders and columns of any type: the values decide ties, least first.

    The minimum of a struct is not a fixed-width number, so Spark aggregates it by sorting: for small tables.
    """
    values = list(keep) if keep is not None else [c for c in df.columns if c not in keys]
    packed = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], F.struct(
        *[col(v) for v in values]
    ).alias("v"))
    best = df.groupBy(*[col(k) for k in keys]).agg(F.min(packed).alias("best"))
    return best.select(
        *[col(k) for k in keys], *[F.col("best.v").getField(v).alias(v) for v in values]
    )
