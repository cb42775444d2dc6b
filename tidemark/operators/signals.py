"""Cross-sectional richness scores: variance premium, own-history z-score, momentum."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import ratio, winsorize
from tidemark.functions.frames import Stat, Trailing, rolled, spread
from tidemark.functions.groups import attach_daily, broadcast_daily
from tidemark.functions.least_squares import fit, gram_columns
from tidemark.operators.risk import one_sector
from tidemark.session import Keep, as_planned

MARKET_ROOT = "SPX"


@dataclass(frozen=True)
class SignalConfig:
    tenor: int = 60
    smoothing_days: int = 5
    controls: tuple[str, ...] = ("idio_vol",)
    winsor: float = 3.0
    min_names: int = 50
    zscore_window: int = 250
    zscore_min_periods: int = 120
    momentum_window: int = 126
    momentum_skip: int = 21


def daily_zscore(df: DataFrame, value: str, out: str, min_names: int = 0) -> DataFrame:
    """Add the z-score of `value` across each date's rows; thin dates leave."""
    stats = attach_daily(
        df,
        F.avg(value).alias("_mean"),
        F.stddev_samp(value).alias("_std"),
        F.count("*").alias("_names"),
    )
    return (
        stats.where(F.col("_names") >= min_names)
        .withColumn(out, ratio(F.col(value) - F.col("_mean"), F.col("_std")))
        .drop("_mean", "_std", "_names")
    )


def variance_premium(surface: DataFrame, forecast: DataFrame, tenor: int = 60) -> DataFrame:
    """`(date, symbol, vrp)`: ln implied vol minus ln forecast vol."""
    iv = f"iv{tenor}"
    return (
        surface.select("date", "symbol", iv)
        .join(forecast.select("date", "symbol", "rv_fcst"), ["symbol", "date"], "inner")
        .where((F.col(iv) > 0) & (F.col("rv_fcst") > 0))
        .select("date", "symbol", (F.ln(iv) - F.ln("rv_fcst")).alias("vrp"))
    )


def residualize_daily(
    df: DataFrame, y: str, x: Sequence[str], min_names: int = 50
) -> DataFrame:
    """`(date, symbol, residual)` of an OLS with intercept per date.

    Sums of products are combined map-side and solved once per date; rows with a null
    leave first, and a date with fewer than `min_names` rows gives nothing.
    """
    x = list(x)
    clean = df.dropna(subset=[y, *x])
    grams = gram_columns(x, y)
    k = len(x) + 1
    fits = (
        clean.groupBy("date")
        .agg(*[g.alias(name) for name, g in grams.items()])
        .where(F.col("g_0_0") >= min_names)
        .select("date", fit(list(grams), k).alias("b"))
        .select("date", *[F.col("b")[i].alias(f"_b{i}") for i in range(k)])
    )
    fitted = F.col("_b0")
    for i, name in enumerate(x, start=1):
        fitted = fitted + F.col(f"_b{i}") * F.col(name)
    return clean.join(broadcast_daily(fits), "date", "inner").select(
        "date", "symbol", (F.col(y) - fitted).alias("residual")
    )


def vrp_frame(
    surface: DataFrame,
    forecast: DataFrame,
    features: DataFrame,
    sectors: DataFrame,
    config: SignalConfig = SignalConfig(),
    keep: Keep = as_planned,
) -> DataFrame:
    """The premium of each name beside what it is regressed on.

    The market's own premium stands for the market, the day's mean where it is missing.
    Names without a sector share one median.
    """
    vrp = variance_premium(surface, forecast, config.tenor)
    is_market = F.col("symbol") == MARKET_ROOT
    market = vrp.where(is_market).groupBy("date").agg(F.min("vrp").alias("market_vrp"))
    names = keep(
        vrp.where(~is_market)
        .join(features.select("date", "symbol", "beta", *config.controls), ["date", "symbol"], "left")
        .join(one_sector(sectors), "symbol", "left")
        .join(broadcast_daily(market), "date", "left")
    )
    # a group holds one row per name; equal values are counted map-side
    medians = names.groupBy(F.col("date").alias("_date"), F.col("sector").alias("_sector")).agg(
        F.median("vrp").alias("sector_median")
    )
    frame = (
        attach_daily(names, F.avg("vrp").alias("mean_vrp"))
        .join(
            medians,
            (F.col("date") == F.col("_date")) & F.col("sector").eqNullSafe(F.col("_sector")),
            "left",
        )
        .select(
            "date",
            "symbol",
            "vrp",
            (F.col("beta") * F.coalesce("market_vrp", "mean_vrp")).alias("market"),
            "sector_median",
            *config.controls,
        )
    )
    return keep(frame)


def vrp_signal(
    surface: DataFrame,
    forecast: DataFrame,
    features: DataFrame,
    sectors: DataFrame,
    config: SignalConfig = SignalConfig(),
    keep: Keep = as_planned,
) -> DataFrame:
    """`(date, symbol, score)`: the variance premium net of beta, sector and controls."""
    residuals = residualize_daily(
        vrp_frame(surface, forecast, features, sectors, config, keep),
        "vrp",
        ["market", "sector_median", *config.controls],
        config.min_names,
    )
    smooth = keep(
        residuals.select(
            "date",
            "symbol",
            Trailing(config.smoothing_days, 1).mean("residual").alias("smooth"),
        )
    )
    return daily_zscore(smooth, "smooth", "z").select(
        "date", "symbol", winsorize(F.col("z"), config.winsor).alias("score")
    )


def iv_zscore_signal(surface: DataFrame, config: SignalConfig = SignalConfig()) -> DataFrame:
    """Each name's log implied vol against its own trailing mean and std, today included."""
    iv = f"iv{config.tenor}"
    trail = Trailing(config.zscore_window, config.zscore_min_periods)
    return (
        surface.where((F.col("symbol") != MARKET_ROOT) & (F.col(iv) > 0))
        .select("date", "symbol", F.ln(iv).alias("level"))
        .transform(spread, "symbol")
        .transform(rolled, trail, mean=Stat("mean", "level"), std=Stat("std", "level"))
        .where(F.col("std") > 0)
        .select(
            "date",
            "symbol",
            winsorize((F.col("level") - F.col("mean")) / F.col("std"), config.winsor).alias("score"),
        )
    )


def momentum_signal(
    reference: DataFrame, config: SignalConfig = SignalConfig(), keep: Keep = as_planned
) -> DataFrame:
    """Past P&L over a window ending `momentum_skip` rows ago, z-scored by date, negated."""
    trail = Trailing(
        config.momentum_window, config.momentum_window // 2, skip=config.momentum_skip
    )
    past = keep(
        reference.where(F.col("symbol") != MARKET_ROOT)
        .transform(spread, "symbol")
        .transform(rolled, trail, past=Stat("sum", "pnl_per_vega"))
        .select("date", "symbol", "past")
        .where(F.col("past").isNotNull())
    )
    return daily_zscore(past, "past", "z", config.min_names).select(
        "date", "symbol", winsorize(-F.col("z"), config.winsor).alias("score")
    )


def combine_signals(pieces: dict[str, DataFrame]) -> DataFrame:
    """`(date, symbol, signal, score)` of several scores."""
    named = [
        df.select("date", "symbol", F.lit(name).alias("signal"), "score")
        for name, df in pieces.items()
    ]
    out = named[0]
    for df in named[1:]:
        out = out.unionByName(df)
    return out


def signal_summary(signals: DataFrame) -> DataFrame:
    """Rows and date span per signal."""
    return signals.groupBy("signal").agg(
        F.count("*").alias("rows"), F.min("date").alias("first"), F.max("date").alias("last")
    )
