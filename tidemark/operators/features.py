"""Per-name features from the spot series: return, market beta, residual vol, gap share."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import SESSIONS_PER_YEAR
from tidemark.functions.frames import Stat, Trailing, previous, rolled, spread
from tidemark.operators.realized_vol import split_adjusted_return


@dataclass(frozen=True)
class FeatureConfig:
    beta_window: int = 250
    idio_window: int = 60
    gap_window: int = 250
    gap_sigma_window: int = 60
    gap_threshold: float = 3.0


def stock_features(
    closes: DataFrame, market: DataFrame, config: FeatureConfig = FeatureConfig()
) -> DataFrame:
    """`(date, symbol, ret, beta, idio_vol, gap_freq)`.

    `market` holds one row per date. The return is taken before the join on the market,
    the windows run on the joined rows; every stage keeps the partitioning by symbol, so
    the whole chain of windows costs one shuffle.
    """
    returns = spread(closes, "symbol").select(
        "date", "symbol", split_adjusted_return().alias("ret")
    )
    joined = returns.join(market, "date", "inner")
    with_beta = rolled(joined, Trailing(config.beta_window), beta=Stat("beta", "ret", "market_return"))
    scaled = rolled(with_beta, Trailing(config.gap_sigma_window), sigma=Stat("std", "ret"))
    parts = scaled.select(
        "date",
        "symbol",
        "ret",
        "beta",
        (F.col("ret") - F.col("beta") * F.col("market_return")).alias("residual"),
        "sigma",
    )
    gap = F.abs("ret") > F.lit(config.gap_threshold) * previous("sigma")
    flagged = parts.withColumn("gap", gap.cast("double"))
    own = rolled(flagged, Trailing(config.idio_window), daily_vol=Stat("std", "residual"))
    return rolled(own, Trailing(config.gap_window), gap_freq=Stat("mean", "gap")).select(
        "date",
        "symbol",
        "ret",
        "beta",
        (F.col("daily_vol") * F.lit(SESSIONS_PER_YEAR**0.5)).alias("idio_vol"),
        "gap_freq",
    )
