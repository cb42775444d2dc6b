"""Exchange sessions and year windows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.symbols import in_window


def weekday_sessions(bounds: DataFrame, closures: DataFrame | None = None) -> DataFrame:
    """`(date)`: weekdays of the window minus full closures; early closes stay.

    `bounds` holds one row `(start, end)`; `closures` is `(date, type)` with ISO or DATE dates.
    """
    days = bounds.select(F.explode(F.sequence("start", "end")).alias("date")).where(
        F.weekday("date") < 5
    )
    if closures is None:
        return days
    shut = closures.where(F.col("type") == "full_close").select(F.to_date("date").alias("date"))
    return days.join(shut, "date", "left_anti")


def window_bounds(spark: SparkSession, start: date, end: date) -> DataFrame:
    """The one-row `(start, end)` frame of a literal window."""
    return spark.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end"))


def trading_sessions(
    calendar: DataFrame, start: date | None = None, end: date | None = None
) -> DataFrame:
    """Sessions in the inclusive window, from the stored calendar."""
    return in_window(calendar, start, end).select("date").distinct()


def year_windows(bounds: DataFrame) -> DataFrame:
    """`(year, start, end)`: the part of the window that falls in each of its years."""
    years = bounds.select(
        "start", "end", F.explode(F.sequence(F.year("start"), F.year("end"))).alias("year")
    )
    return years.select(
        "year",
        F.greatest("start", F.make_date("year", F.lit(1), F.lit(1))).alias("start"),
        F.least("end", F.make_date("year", F.lit(12), F.lit(31))).alias("end"),
    )


def years_in(start: date, end: date) -> list[int]:
    return list(range(start.year, end.year + 1))
