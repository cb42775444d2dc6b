"""What vendors land, brought into the one form the store keeps.

Three kinds of rows come in: option quotes with greeks, open interest and daily stock bars. Going out, an
option row has vega for one vol point of one share and theta for one calendar day; `iv` is
a fraction, null where it cannot be trusted; `right` is one letter; the date is the exchange's, from the
stamp of the spot; symbols follow the option roots. Vendor columns without a place of their own come after.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import DAYS_PER_YEAR, dtype_of, market_date, ratio
from tidemark.functions.groups import by_count, by_stamp, first_row, last
from tidemark.operators.pricing import vol_point_move
from tidemark.sources.tables import CONTRACT_KEYS, OPTION_EXTRAS, STOCK_EXTRAS

IV_ERROR_TOLERANCE = 1.0
PER_UNIT, PER_POINT = 0.01, 1.0


def as_date(df: DataFrame, name: str) -> Column:
    """An ISO string or a date column as DATE."""
    return F.to_date(name, "yyyy-MM-dd") if dtype_of(df, name) == "string" else F.col(name)


def valid_iv() -> Column:
    """The vendor's implied vol where its inversion is to be trusted, else null."""
    good = (F.abs("iv_error") <= IV_ERROR_TOLERANCE) & (F.col("implied_vol") > 0)
    return F.when(good, F.col("implied_vol")).cast("double")


def short_right() -> Column:
    return F.when(F.col("right") == "CALL", F.lit("C")).otherwise(F.lit("P"))


def vega_scale(raw: DataFrame, by: list[str] | None = None, rate: float = 0.04) -> DataFrame:
    """Does each group quote vega per 1.00 of implied vol, or per vol point?

    Every clean row of a group is repriced one vol point higher and votes for the scale that
    explains the price change. Gives `(keys, sampled, share, scale, status)`: scale 0.01 or 1.0
    on a two-thirds majority (`ok`), else null with status `too_few` or `ambiguous`. The
    votes are averaged map-side, so nothing is ranked or sorted.
    """
    keys = by if by is not None else ["symbol", "year"]
    day = market_date("underlying_timestamp", dtype_of(raw, "underlying_timestamp"))
    dated = raw.withColumns({"date": day, "expires": as_date(raw, "expiration")})
    if "year" in keys and "year" not in raw.columns:
        dated = dated.withColumn("year", F.year("date"))
    dated = dated.withColumn("dte", F.datediff("expires", "date"))
    clean = dated.where(
        (F.col("bid") > 0)
        & (F.abs("iv_error") <= 0.01)
        & F.col("implied_vol").between(0.05, 2.0)
        & F.col("dte").between(10, 365)
        & F.abs("delta").between(0.2, 0.8)
        & (F.col("vega") > 0)
    )
    moved = vol_point_move(
        clean,
        "underlying_price",
        "strike",
        F.col("dte") / F.lit(DAYS_PER_YEAR),
        rate,
        "implied_vol",
        F.col("right") == "CALL",
    ).select(*keys, "vega", "move")
    per_unit = F.abs(F.col("move") - F.col("vega") * F.lit(0.01)) < F.abs(
        F.col("move") - F.col("vega")
    )
    votes = moved.groupBy(*keys).agg(
        F.count("*").alias("sampled"), F.avg(per_unit.cast("double")).alias("share")
    )
    # every group answers, also one without a clean row
    asked = dated.select(*keys).distinct()
    share, enough = F.col("share"), F.coalesce("sampled", F.lit(0)) >= 20
    return asked.join(votes, keys, "left").select(
        *keys,
        F.coalesce("sampled", F.lit(0)).cast("long").alias("sampled"),
        "share",
        F.when(enough & (share >= 2 / 3), F.lit(PER_UNIT))
        .when(enough & (share <= 1 / 3), F.lit(PER_POINT))
        .alias("scale"),
        F.when(~enough, F.lit("too_few"))
        .when((share < 2 / 3) & (share > 1 / 3), F.lit("ambiguous"))
        .otherwise(F.lit("ok"))
        .alias("status"),
    )


def canonical_chain(
    raw: DataFrame,
    scale: float | Column | DataFrame = PER_UNIT,
    fallback: float | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Vendor greeks rows in canonical columns, extras and the columns named by `keep` after them.

    `scale` is a number, a column of `raw`, or the frame `vega_scale` gives, joined on its keys.
    A group it could not decide takes `fallback`, or loses its vega where none is given.
    """
    if isinstance(scale, DataFrame):
        keys = [c for c in ("symbol", "year") if c in scale.columns]
        day = market_date("underlying_timestamp", dtype_of(raw, "underlying_timestamp"))
        if "year" in keys and "year" not in raw.columns:
            raw = raw.withColumn("year", F.year(day))
        raw = raw.join(scale.select(*keys, F.col("scale").alias("_scale")), keys, "left")
        factor = F.coalesce("_scale", F.lit(fallback).cast("double"))
    else:
        factor = scale if isinstance(scale, Column) else F.lit(scale)
    real = lambda c: F.col(c).cast("double").alias(c)
    return raw.select(
        market_date("underlying_timestamp", dtype_of(raw, "underlying_timestamp")).alias("date"),
        F.col("symbol").cast("string").alias("symbol"),
        as_date(raw, "expiration").alias("expiration"),
        real("strike"),
        short_right().alias("right"),
        real("bid"),
        real("ask"),
        ((F.col("bid") + F.col("ask")) / F.lit(2.0)).alias("mid"),
        valid_iv().alias("iv"),
        real("delta"),
        real("gamma"),
        real("theta"),
        (F.col("vega") * factor).cast("double").alias("vega"),
        F.col("underlying_price").cast("double").alias("underlying"),
        F.col("volume").cast("long").alias("volume"),
        *[F.col(f"`{c}`") for c in OPTION_EXTRAS if c in raw.columns],
        *keep,
    )


def canonical_open_interest(
    raw: DataFrame, arrival: str | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """`(date, symbol, expiration, strike, right, oi)`, one row per contract-day.

    The row that arrived last wins: by `arrival` where the landing data number their rows,
    else by the stamp; the larger position breaks a tie. Rows that differ in a column named
    by `keep` are told apart.
    """
    late = F.col(arrival) if arrival is not None else F.col("timestamp")
    rows = raw.select(
        market_date("timestamp", dtype_of(raw, "timestamp")).alias("date"),
        F.col("symbol").cast("string").alias("symbol"),
        as_date(raw, "expiration").alias("expiration"),
        F.col("strike").cast("double").alias("strike"),
        short_right().alias("right"),
        F.col("open_interest").cast("long").alias("oi"),
        late.alias("_late"),
        *keep,
    )
    keys = [*CONTRACT_KEYS, *keep]
    arrived = by_stamp("_late", dtype_of(rows, "_late")) if arrival is None else by_count("_late", 62)
    best = first_row(rows, keys, [last(arrived), last(by_count("oi", 62))], keep=["oi"])
    return best.select(*CONTRACT_KEYS, "oi", *keep)


def canonical_stock(raw: DataFrame) -> DataFrame:
    """Stock EOD rows with a `date` and the option-root symbol; every row is kept.

    A delisted name ends on a row with a zero close: filter `close > 0` before a return.
    """
    real = lambda c: F.col(c).cast("double").alias(c)
    return raw.select(
        market_date("created", dtype_of(raw, "created")).alias("date"),
        F.regexp_replace(F.col("symbol").cast("string"), r"\.", "").alias("symbol"),
        *[real(c) for c in ("open", "high", "low", "close")],
        F.col("volume").cast("long").alias("volume"),
        *[F.col(f"`{c}`") for c in STOCK_EXTRAS if c in raw.columns],
    )


def vega_residuals(chain: DataFrame, rate: float = 0.04) -> DataFrame:
    """Each live row's price move for one vol point beside the vega it quotes."""
    tau = F.datediff("expiration", "date") / F.lit(DAYS_PER_YEAR)
    live = chain.where((F.col("iv") > 0) & (tau > 0))
    moved = vol_point_move(
        live, "underlying", "strike", tau, rate, "iv", F.col("right") == "C"
    )
    return moved.select(
        *CONTRACT_KEYS,
        "vega",
        "move",
        ratio(F.col("move"), F.col("vega")).alias("move_per_vega"),
    )

