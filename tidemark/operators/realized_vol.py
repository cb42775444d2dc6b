"""Spot panels, split-adjusted returns and close-to-close realized volatility."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import SESSIONS_PER_YEAR, ratio
from tidemark.functions.frames import Stat, Trailing, leading, previous, rolled, spread
from tidemark.functions.groups import by_day, by_letter, by_price, first_row


@dataclass(frozen=True)
class RealizedVolConfig:
    windows: tuple[int, ...] = (1, 5, 22)
    forward_window: int = 60
    min_price: float = 1.0


def spot_panel(chain: DataFrame, actions: DataFrame | None = None) -> DataFrame:
    """`(date, symbol, close, split_ratio)` off the spot stamped on every contract row.

    The contract rows of a symbol-day agree on the spot; where they do not, the first
    contract in key order decides. Days without a split have ratio 1.
    """
    spot = first_row(
        chain.where(F.col("underlying") > 0).select(
            "date", "symbol", F.col("underlying").alias("close"), "expiration", "strike", "right"
        ),
        ["date", "symbol"],
        [by_day("expiration"), by_price("strike"), by_letter("right")],
        keep=["close"],
    )
    if actions is None:
        return spot.withColumn("split_ratio", F.lit(1.0))
    return with_splits(spot, actions)


def with_splits(spot: DataFrame, actions: DataFrame) -> DataFrame:
    """Left-join one split ratio per symbol-day."""
    splits = (
        actions.where(F.col("action") == "split")
        .groupBy("date", "symbol")
        .agg(F.min("value").alias("split_ratio"))
    )
    return spot.join(splits, ["date", "symbol"], "left").withColumn(
        "split_ratio", F.coalesce("split_ratio", F.lit(1.0))
    )


def split_adjusted_return() -> Column:
    """ln(close x split ratio / previous close)."""
    return F.ln(ratio(F.col("close") * F.col("split_ratio"), previous("close")))


def realized_vol(
    closes: DataFrame, config: RealizedVolConfig = RealizedVolConfig()
) -> DataFrame:
    """`(date, symbol, rv_<n>..., rv_fwd)` as annualised vols.

    Prices under `min_price` leave before the lag, so a return bridges the gap.
    `rv_fwd` covers the next `forward_window` rows and is null until they all exist.
    """
    kept = closes.where(F.col("close") >= config.min_price)
    squared = spread(kept, "symbol").select(
        "date", "symbol", F.pow(split_adjusted_return(), F.lit(2.0)).alias("squared")
    )
    annual = lambda c: F.sqrt(c * F.lit(SESSIONS_PER_YEAR))
    out = squared
    for n in config.windows:
        out = out.withColumn("_1", F.col("squared")) if n == 1 else rolled(out, Trailing(n), **{f"_{n}": Stat("mean", "squared")})
    out = rolled(out, leading(config.forward_window), _ahead=Stat("mean", "squared"))
    return out.select(
        "date",
        "symbol",
        *[annual(F.col(f"_{n}")).alias(f"rv_{n}") for n in config.windows],
        annual(F.col("_ahead")).alias("rv_fwd"),
    )


def market_return(spot: DataFrame) -> DataFrame:
    """`(date, market_return)` of one market root; its spot carries no splits."""
    by_date = Window.partitionBy("symbol").orderBy("date")
    return spot.select(
        "date",
        F.ln(ratio(F.col("close"), F.lag("close").over(by_date))).alias("market_return"),
    )
