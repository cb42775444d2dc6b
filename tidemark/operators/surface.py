"""Constant-maturity at-the-money implied vol per symbol-day."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import col, days_between, finite
from tidemark.functions.groups import by_fraction, by_price, first_row


@dataclass(frozen=True)
class SurfaceConfig:
    tenors: tuple[int, ...] = (30, 60, 90)
    min_dte: int = 7
    max_dte: int = 400
    delta_band: tuple[float, float] = (0.25, 0.75)


def atm_pillars(chain: DataFrame, config: SurfaceConfig = SurfaceConfig()) -> DataFrame:
    """`(date, symbol, expiration, dte, atm_iv)`: the call and put nearest |delta| = 0.5, averaged.

    Equal distances go to the lower strike; an expiration needs both rights.
    """
    usable = (
        chain.where(
            F.col("iv").isNotNull()
            & (F.col("bid") > 0)
            & (F.col("ask") > F.col("bid"))
            & F.abs("delta").between(*config.delta_band)
        )
        .select("date", "symbol", "expiration", "right", "strike", "delta", "iv")
        .withColumn("dte", days_between("expiration", "date"))
        .where(F.col("dte").between(config.min_dte, config.max_dte))
    )
    nearest = first_row(
        usable,
        ["date", "symbol", "expiration", "right"],
        [by_fraction(F.abs(F.abs("delta") - F.lit(0.5))), by_price("strike")],
        keep=["iv"],
    ).withColumn("dte", days_between("expiration", "date"))
    # one row per right is left, so counting rows counts distinct rights
    return (
        nearest.groupBy("date", "symbol", "expiration")
        .agg(F.avg("iv").alias("atm_iv"), F.min("dte").alias("dte"), F.count("*").alias("rights"))
        .where(F.col("rights") == 2)
        .select("date", "symbol", "expiration", "dte", "atm_iv")
    )


def _vol_at(tenor: int, extrapolate: bool) -> Column:
    """iv at `tenor` days from the bracketing pillars of one group, as an aggregate."""
    days = F.when(F.col("_good"), F.col("_days"))
    # a maturity is there once, so the day alone picks its vol; numbers keep the aggregate hashed
    before, after = F.when(days <= tenor, days), F.when(days >= tenor, days)
    t_below, t_above = F.max(before), F.min(after)
    iv_below, iv_above = F.max_by("_iv", before), F.min_by("_iv", after)
    tv_below = F.pow(iv_below, F.lit(2.0)) * t_below
    tv_above = F.pow(iv_above, F.lit(2.0)) * t_above
    span = t_above - t_below
    blend = F.when(span == 0, tv_below).otherwise(
        tv_below + (tv_above - tv_below) * F.try_divide(F.lit(float(tenor)) - t_below, span)
    )
    inside = F.sqrt(F.greatest(blend, F.lit(0.0)) / F.lit(float(tenor)))
    bracketed = t_below.isNotNull() & t_above.isNotNull()
    # a lone pillar on the tenor is returned as it stands
    exact = F.when((F.count(days) == 1) & bracketed, iv_below)
    value = F.when(bracketed, F.coalesce(exact, inside))
    if not extrapolate:
        return value
    return F.coalesce(value, iv_below, iv_above)


def tenor_columns(
    pillars: DataFrame,
    group_by: Sequence[str],
    tenors: Sequence[int],
    dte: str = "dte",
    iv: str = "atm_iv",
    extrapolate: bool = False,
) -> DataFrame:
    """One row per group with `iv<tenor>` columns, linear in total variance iv^2 t.

    Pillars that are not positive and finite are left out, repeated maturities are
    averaged, and a tenor outside the pillars is null unless `extrapolate` holds the
    nearest one flat. A group of unusable pillars still gives its row of nulls.
    """
    keys = list(group_by)
    usable = finite(iv) & (col(iv) > 0) & (col(dte) > 0)
    averaged = (
        pillars.select(
            *keys,
            F.when(usable, col(dte).cast("double")).alias("_days"),
            F.when(usable, col(iv)).alias("_iv"),
        )
        .groupBy(*keys, "_days")
        .agg(F.avg("_iv").alias("_iv"))
        .withColumn("_good", F.col("_days").isNotNull())
    )
    return averaged.groupBy(*keys).agg(*[_vol_at(t, extrapolate).alias(f"iv{t}") for t in tenors])


def surface_panel(chain: DataFrame, config: SurfaceConfig = SurfaceConfig()) -> DataFrame:
    """`(date, symbol, iv<tenor>...)` of every symbol in `chain`, market roots included."""
    return tenor_columns(atm_pillars(chain, config), ["date", "symbol"], config.tenors)
