"""Pooled log-HAR forecast of forward realized vol, refit monthly on what was known."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import finite
from tidemark.functions.groups import broadcast_daily
from tidemark.functions.least_squares import fit, gram_columns
from tidemark.session import Keep, as_planned


@dataclass(frozen=True)
class HARConfig:
    windows: tuple[int, ...] = (1, 5, 22)
    forward_window: int = 60
    min_fit_rows: int = 1000

    @property
    def features(self) -> list[str]:
        return [f"rv_{w}" for w in self.windows]


def refit_dates(sessions: DataFrame) -> DataFrame:
    """The first session of each month."""
    return sessions.groupBy(F.trunc("date", "MM").alias("month")).agg(F.min("date").alias("date")).select("date")


def har_rows(panel: DataFrame, config: HARConfig = HARConfig(), *keep: str) -> DataFrame:
    """Usable rows with log features `x_*` and the target `y`, null until it is known."""
    usable = None
    for f in config.features:
        ok = (F.col(f) > 0) & finite(f)
        usable = ok if usable is None else usable & ok
    return panel.where(usable).select(
        "date",
        "symbol",
        "in_fit",
        *keep,
        *[F.ln(f).alias(f"x_{f}") for f in config.features],
        F.when(F.col("rv_fwd") > 0, F.ln(F.pow("rv_fwd", F.lit(2.0)))).alias("y"),
    )


def _grams(config: HARConfig) -> dict[str, Column]:
    train = F.col("in_fit") & F.col("y").isNotNull()
    return gram_columns([f"x_{f}" for f in config.features], "y", train)


def with_closing(panel: DataFrame, config: HARConfig = HARConfig()) -> DataFrame:
    """`panel` with `closes`: the date on which a row's forward window was full, null until it is."""
    ahead = Window.partitionBy("symbol").orderBy("date")
    return panel.withColumn("closes", F.lead("date", config.forward_window).over(ahead))


def har_increments(panel: DataFrame, config: HARConfig = HARConfig(), after: date | None = None) -> DataFrame:
    """`(date, closes, g_*)`: the sums of products of each session's rows, by the date their target became known on.

    `panel` carries `in_fit`. Sums of targets known up to `after` are stored already and left out; what is known
    of a row on a date does not change later, so the sums of all instalments together are those of one pass. A session
    without any known target gives a row without sums (`closes` is null) in each instalment.
    """
    rows = har_rows(with_closing(panel, config), config, "closes")
    if after is not None:
        rows = rows.where(F.col("closes").isNull() | (F.col("closes") > F.lit(after)))
    return rows.groupBy("date", "closes").agg(*[g.alias(name) for name, g in _grams(config).items()])


def har_coefficients(rows: DataFrame, config: HARConfig = HARConfig()) -> DataFrame:
    """`(date, rows, const, residual_var, b_rv_*)`: one fit per refit date with enough rows.

    A refit trains on the rows whose forward window closed `forward_window` sessions
    earlier. Products are summed per session, then accumulated over sessions; from there
    on the data are one row per session, whatever the number of names.
    """
    return fits_from_sums(rows.groupBy("date").agg(*[g.alias(name) for name, g in _grams(config).items()]), config)


def fits_from_sums(sums: DataFrame, config: HARConfig = HARConfig()) -> DataFrame:
    """The fits from sums of products (`har_increments`, all instalments stored so far), whatever rows they stand in."""
    x = [f"x_{f}" for f in config.features]
    grams = _grams(config)
    daily = sums.groupBy("date").agg(*[F.sum(name).alias(name) for name in grams])
    sessions = Window.orderBy("date")  # one row per session
    known = sessions.rowsBetween(Window.unboundedPreceding, -config.forward_window)
    opens = F.lag("date").over(sessions)
    known_sums = daily.select(
        "date",
        (opens.isNull() | (F.trunc(opens, "MM") != F.trunc("date", "MM"))).alias("refit"),
        *[F.sum(name).over(known).alias(name) for name in grams],
    )
    k = len(x) + 1
    fits = known_sums.where(
        F.col("refit") & (F.col("g_0_0") >= config.min_fit_rows)
    ).select("date", F.col("g_0_0").cast("long").alias("rows"), fit(list(grams), k).alias("b"))
    return fits.select(
        "date",
        "rows",
        F.col("b")[0].alias("const"),
        (F.col("b")[k] / F.col("rows")).alias("residual_var"),
        *[F.col("b")[i + 1].alias(f"b_{f}") for i, f in enumerate(config.features)],
    )


def latest_fit(coefficients: DataFrame) -> DataFrame:
    """The most recent row of the coefficient history."""
    return coefficients.orderBy(F.desc("date")).limit(1)


def har_forecast(
    panel: DataFrame, apply: DataFrame | None = None, config: HARConfig = HARConfig(), keep: Keep = as_planned
) -> tuple[DataFrame, DataFrame]:
    """`(date, symbol, rv_fcst)` for every usable row, and the coefficient history.

    `apply` rows are scored but never fitted. A day is scored with the latest fit on
    or before it, the lognormal correction included; days before the first fit have no row.
    """
    columns = ["date", "symbol", *config.features, "rv_fwd"]
    both = panel.select(*columns, F.lit(True).alias("in_fit"))
    if apply is not None:
        both = both.unionByName(apply.select(*columns, F.lit(False).alias("in_fit")))
    rows = har_rows(both, config)
    coefficients = keep(har_coefficients(rows, config))
    names = ["const", "residual_var", *[f"b_{f}" for f in config.features]]
    back = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)  # one row per session
    current = (
        rows.select("date")
        .distinct()
        .join(broadcast_daily(coefficients.select("date", *names)), "date", "left")
        .select("date", *[F.last(n, ignorenulls=True).over(back).alias(n) for n in names])
        .where(F.col("const").isNotNull())
    )
    log_variance = F.col("const")
    for f in config.features:
        log_variance = log_variance + F.col(f"b_{f}") * F.col(f"x_{f}")
    scored = rows.join(broadcast_daily(current), "date", "inner").select(
        "date",
        "symbol",
        F.sqrt(F.exp(log_variance + F.col("residual_var") / 2)).alias("rv_fcst"),
    )
    return scored, coefficients
