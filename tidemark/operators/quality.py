"""Does a stored option root belong to the company its ticker names?"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.groups import least_row
from tidemark.functions.columns import ratio


@dataclass(frozen=True)
class SymbologyConfig:
    ok_difference: float = 0.001
    wrong_difference: float = 0.005
    min_overlap_days: int = 20
    action_gap: float = 0.05
    max_abs_return: float = 0.3


def stored_spots(chain: DataFrame) -> DataFrame:
    """`(symbol, date, theta_spot)`: the median spot on each symbol-day's contract rows.

    The rows of a symbol-day share a handful of distinct spots, which is what the exact
    median holds in memory.
    """
    return (
        chain.where(F.col("underlying") > 0)
        .groupBy("symbol", "date")
        .agg(F.median("underlying").alias("theta_spot"))
    )


def symbology_check(
    spots: DataFrame,
    quotes: DataFrame,
    names: DataFrame,
    config: SymbologyConfig = SymbologyConfig(),
) -> DataFrame:
    """One verdict per (year, symbol): `ok`, `suspect`, `wrong_instrument`, `thin_overlap`.

    `quotes` is `(yahoo_symbol, date, yahoo_close)`, `names` the symbol map. Log returns of the
    two series are compared over the days both have, within the year. Too few common days
    come before any other verdict.
    """
    mapping = least_row(names.select("option_symbol", "yahoo_symbol"), ["option_symbol"])
    named = spots.join(
        mapping.withColumnRenamed("option_symbol", "symbol"), "symbol", "inner"
    ).withColumn("year", F.year("date"))
    vendor = (
        quotes.where(F.col("yahoo_close") > 0)
        .select("yahoo_symbol", "date", "yahoo_close")
        .join(mapping, "yahoo_symbol", "inner")
        .select(F.col("option_symbol").alias("symbol"), "date", "yahoo_close")
    )
    by_day = Window.partitionBy("symbol", "year").orderBy("date")
    change = lambda c: F.ln(c) - F.lag(F.ln(c)).over(by_day)
    returns = (
        named.join(vendor, ["symbol", "date"], "inner")
        .select(
            "symbol",
            "year",
            change("theta_spot").alias("theta_return"),
            change("yahoo_close").alias("yahoo_return"),
        )
        .where(
            (F.abs("theta_return") < config.max_abs_return)
            & (F.abs("yahoo_return") < config.max_abs_return)
        )
        .withColumn("return_gap", F.abs(F.col("theta_return") - F.col("yahoo_return")))
    )
    # correlation from its parts: the built-in one divides by a zero deviation
    correlation = F.coalesce(
        ratio(
            F.covar_samp("theta_return", "yahoo_return"),
            F.stddev_samp("theta_return") * F.stddev_samp("yahoo_return"),
        ),
        F.lit(float("nan")),
    )
    compared = returns.groupBy("year", "symbol").agg(
        F.count("*").alias("overlap_days"),
        correlation.alias("return_correlation"),
        F.median("return_gap").alias("median_return_difference"),
        F.count_if(F.col("return_gap") > config.action_gap).alias("action_gap_days"),
    )
    overlap, gap = F.col("overlap_days"), F.col("median_return_difference")
    return (
        named.groupBy("year", "symbol")
        .agg(F.count("*").alias("theta_days"))
        .join(compared, ["year", "symbol"], "left")
        .withColumn("overlap_days", F.coalesce("overlap_days", F.lit(0).cast("long")))
        .withColumn(
            "status",
            F.when(overlap < config.min_overlap_days, F.lit("thin_overlap"))
            .when(gap <= config.ok_difference, F.lit("ok"))
            .when(gap >= config.wrong_difference, F.lit("wrong_instrument"))
            .otherwise(F.lit("suspect")),
        )
    )


def status_counts(checks: DataFrame) -> DataFrame:
    """Symbol-years per (year, status)."""
    return checks.groupBy("year", "status").agg(F.count("*").alias("symbols"))
