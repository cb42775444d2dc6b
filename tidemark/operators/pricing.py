"""Black-Scholes prices and greeks of a whole chain as columns.

`sigma` and `rate` are decimals and `tau` is in years; vega is per 1.00 of sigma, theta
per calendar day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import DAYS_PER_YEAR
from tidemark.functions.normal import normal_pdf, upper_tail

FLOOR = 1e-12


def with_greeks(
    df: DataFrame,
    spot: Column,
    strike: Column,
    tau: Column,
    rate: Column,
    sigma: Column,
    is_call: Column,
    prefix: str = "bs_",
) -> DataFrame:
    """Add price, delta, gamma, vega and theta as `<prefix>price` and so on.

    The intermediate values are columns of their own, stage after stage, so each is
    worked out once per row and the generated code stays small.
    """
    c = lambda name: F.col(f"_{name}")
    stages = [
        {
            "_spot": spot,
            "_strike": strike,
            "_tau": tau,
            "_rate": rate,
            "_sigma": sigma,
            "_call": is_call,
        },
        {
            "_years": F.greatest(c("tau"), F.lit(FLOOR)),
            "_vol": F.greatest(c("sigma"), F.lit(FLOOR)),
            # the price discounts over the raw maturity, the floored one guards d1 and d2
            "_owed": c("strike") * F.exp(-c("rate") * c("tau")),
        },
        {"_root": F.sqrt(c("years"))},
        {
            "_d1": (
                F.ln(c("spot") / c("strike"))
                + (c("rate") + F.lit(0.5) * c("vol") * c("vol")) * c("years")
            )
            / (c("vol") * c("root"))
        },
        {"_d2": c("d1") - c("vol") * c("root"), "_density": normal_pdf(c("d1"))},
        {"_s1": F.abs(c("d1")), "_s2": F.abs(c("d2"))},
        {"_t1": upper_tail(c("s1")), "_t2": upper_tail(c("s2"))},
        {
            "_n1": F.when(c("d1") > 0, F.lit(1.0) - c("t1")).otherwise(c("t1")),
            "_n2": F.when(c("d2") > 0, F.lit(1.0) - c("t2")).otherwise(c("t2")),
            "_m1": F.when(c("d1") > 0, c("t1")).otherwise(F.lit(1.0) - c("t1")),
            "_m2": F.when(c("d2") > 0, c("t2")).otherwise(F.lit(1.0) - c("t2")),
            "_late": c("strike") * F.exp(-c("rate") * c("years")),
            "_decay": -c("spot") * c("density") * c("sigma") / (F.lit(2.0) * c("root")),
        },
    ]
    out = df
    for stage in stages:
        out = out.withColumns(stage)
    return out.select(
        *df.columns,
        F.when(c("call"), c("spot") * c("n1") - c("owed") * c("n2"))
        .otherwise(c("owed") * c("m2") - c("spot") * c("m1"))
        .alias(f"{prefix}price"),
        F.when(c("call"), c("n1")).otherwise(c("n1") - F.lit(1.0)).alias(f"{prefix}delta"),
        (c("density") / (c("spot") * c("sigma") * c("root"))).alias(f"{prefix}gamma"),
        (c("spot") * c("density") * c("root")).alias(f"{prefix}vega"),
        (
            F.when(c("call"), c("decay") - c("rate") * c("late") * c("n2")).otherwise(
                c("decay") + c("rate") * c("late") * c("m2")
            )
            / F.lit(DAYS_PER_YEAR)
        ).alias(f"{prefix}theta"),
    )


def reprice_chain(chain: DataFrame, rate: float = 0.0) -> DataFrame:
    """Add `bs_price`, `bs_delta`, `bs_gamma`, `bs_vega`, `bs_theta` at each row's own `iv`.

    Rows whose implied vol is null keep nulls.
    """
    priced = with_greeks(
        chain,
        spot=F.col("underlying"),
        strike=F.col("strike"),
        tau=F.datediff("expiration", "date") / F.lit(DAYS_PER_YEAR),
        rate=F.lit(rate),
        sigma=F.when(F.col("iv") > 0, F.col("iv")),
        is_call=F.col("right") == "C",
    )
    greeks = [c for c in priced.columns if c.startswith("bs_")]
    return priced.select(
        *chain.columns, *[F.when(F.col("iv") > 0, F.col(g)).alias(g) for g in greeks]
    )


def vol_point_move(
    df: DataFrame, spot: str, strike: str, tau: Column, rate: float, sigma: str, is_call: Column
) -> DataFrame:
    """Add `move`: how far the price goes when `sigma` rises by one vol point."""
    common = (F.col(spot), F.col(strike), tau, F.lit(rate))
    low = with_greeks(df, *common, F.col(sigma), is_call, "_low_")
    keep = low.select(*df.columns, "_low_price")
    high = with_greeks(keep, *common, F.col(sigma) + F.lit(0.01), is_call, "_high_")
    return high.select(*df.columns, (F.col("_high_price") - F.col("_low_price")).alias("move"))
