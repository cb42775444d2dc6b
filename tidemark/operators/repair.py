"""Repair sessions whose end-of-day quotes came back empty, from a late intraday bar."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import days_between, dtype_of, market_clock, market_date, moneyness
from tidemark.functions.groups import by_clock, first_row, last
from tidemark.operators.canonical import as_date, short_right, valid_iv
from tidemark.sources.tables import CONTRACT_KEYS

# Columns a repaired row takes from the bar, and those its empty quotes spoiled.
REPLACED = (
    "bid",
    "ask",
    "iv",
    "delta",
    "theta",
    "vega",
    "underlying",
    "implied_vol",
    "iv_error",
    "rho",
    "epsilon",
    "lambda",
    "underlying_timestamp",
)
NULLED = (
    "gamma",
    "vanna",
    "charm",
    "vomma",
    "veta",
    "vera",
    "speed",
    "zomma",
    "color",
    "ultima",
    "d1",
    "d2",
    "dual_delta",
    "dual_gamma",
)


@dataclass(frozen=True)
class RepairConfig:
    threshold: float = 0.5
    max_moneyness: float = 0.02
    min_dte: int = 7
    max_dte: int = 60


def unquoted_sessions(chain: DataFrame, config: RepairConfig = RepairConfig()) -> DataFrame:
    """`(symbol, date, quoted)` where too few near-the-money contracts carry an ask."""
    near = chain.where(
        (F.col("underlying") > 0)
        & (moneyness("strike", "underlying") <= config.max_moneyness)
        & days_between("expiration", "date").between(config.min_dte, config.max_dte)
    )
    return (
        near.groupBy("symbol", "date")
        .agg(F.avg((F.col("ask") > 0).cast("double")).alias("quoted"))
        .where(F.col("quoted") < config.threshold)
    )


def repair_tasks(
    chain: DataFrame, sessions: DataFrame, done: DataFrame | None = None
) -> DataFrame:
    """`(symbol, date, expiration)` to ask a bar for; those in `done` are left out."""
    tasks = (
        chain.join(sessions.select("symbol", "date"), ["symbol", "date"], "left_semi")
        .select("symbol", "date", "expiration")
        .distinct()
    )
    if done is None:
        return tasks
    return tasks.join(done, ["symbol", "date", "expiration"], "left_anti")


def last_bars(bars: DataFrame) -> DataFrame:
    """The latest bar of each contract-day."""
    keyed = bars.withColumn("_day", market_date("timestamp", dtype_of(bars, "timestamp")))
    keys = ["symbol", "_day", "expiration", "strike", "right"]
    values = [c for c in bars.columns if c not in keys]
    latest = last(by_clock(market_clock("timestamp", dtype_of(bars, "timestamp"))))
    best = first_row(keyed, keys, [latest], keep=values)
    return best.select(*[F.col(f"`{c}`") for c in bars.columns])


def build_patch(bars: DataFrame, vega_scale: float | Column = 0.01) -> DataFrame:
    """Bars with an ask in canonical columns `<name>_new`, keyed by contract-day."""
    real = lambda c: F.col(f"`{c}`").cast("double").alias(f"{c}_new")
    factor = vega_scale if isinstance(vega_scale, Column) else F.lit(vega_scale)
    return bars.where(F.col("ask") > 0).select(
        market_date("timestamp", dtype_of(bars, "timestamp")).alias("date"),
        "symbol",
        as_date(bars, "expiration").alias("expiration"),
        F.col("strike").cast("double").alias("strike"),
        short_right().alias("right"),
        real("bid"),
        real("ask"),
        valid_iv().alias("iv_new"),
        real("delta"),
        real("theta"),
        (F.col("vega") * factor).cast("double").alias("vega_new"),
        F.col("underlying_price").cast("double").alias("underlying_new"),
        real("implied_vol"),
        real("iv_error"),
        real("rho"),
        real("epsilon"),
        real("lambda"),
        F.col("underlying_timestamp").alias("underlying_timestamp_new"),
    )


def apply_patch(chain: DataFrame, patch: DataFrame) -> DataFrame:
    """`chain` with patched rows replaced; `mid` is taken anew on every row.

    `patch` holds a contract-day once, as `build_patch` of `last_bars` gives it. Only the sessions it
    names are joined with it; the others, nearly all of a chain, stay where they are.
    """
    sessions = patch.select("symbol", "date").distinct()
    middle = ((F.col("bid") + F.col("ask")) / F.lit(2.0)).alias("mid")
    untouched = chain.join(sessions, ["symbol", "date"], "left_anti").select(
        *[middle if c == "mid" else F.col(f"`{c}`") for c in chain.columns]
    )
    named = chain.join(sessions, ["symbol", "date"], "left_semi")
    joined = named.join(patch, list(CONTRACT_KEYS), "left")
    patched = F.col("ask_new").isNotNull()
    bid = F.when(patched, F.col("bid_new")).otherwise(F.col("bid"))
    ask = F.when(patched, F.col("ask_new")).otherwise(F.col("ask"))

    def repaired(name: str) -> Column:
        old = F.col(f"`{name}`")
        if name == "mid":
            return ((bid + ask) / F.lit(2.0)).alias(name)
        if name in REPLACED:
            return F.when(patched, F.col(f"`{name}_new`")).otherwise(old).alias(name)
        if name in NULLED:
            return F.when(~patched, old).alias(name)
        return old

    return untouched.unionByName(joined.select(*[repaired(c) for c in chain.columns]))
