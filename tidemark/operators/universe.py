"""Point-in-time index membership from today's list and the log of changes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.groups import broadcast_daily
from tidemark.operators.straddle import number_sessions
from tidemark.operators.symbols import spelled
from tidemark.session import Keep, as_planned

# How the change log writes dates, and the part of a cell that is a ticker.
LOG_DATE = "MMMM d, yyyy"
TICKER_PATTERN = r"^\s*([A-Za-z0-9.\-]+)"


def clean_constituents(current: DataFrame, column: str = "Symbol") -> DataFrame:
    """`(ticker)` of today's members; blank rows leave."""
    return current.select(F.col(f"`{column}`").alias("ticker")).where(F.col("ticker").isNotNull())


def clean_changes(log: DataFrame) -> DataFrame:
    """`(effective_date, ticker, security, reason, action)` from the landed change log.

    The log is wide: `effective_date`, `added_ticker`, `added_security`, `removed_ticker`,
    `removed_security`, `reason`. A date that does not parse or a cell without a ticker drops
    its row; trailing markup after a ticker is cut off.
    """
    side = lambda name: F.struct(
        F.lit(name.capitalize()).alias("action"),
        F.col(f"{name}_ticker").cast("string").alias("ticker"),
        F.col(f"{name}_security").alias("security"),
    )
    tall = log.select(
        "effective_date", "reason", F.explode(F.array(side("added"), side("removed"))).alias("side")
    )
    ticker = F.regexp_extract("side.ticker", TICKER_PATTERN, 1)
    return tall.select(
        F.to_date(F.try_to_timestamp("effective_date", F.lit(LOG_DATE))).alias("effective_date"),
        F.when(ticker != "", ticker).alias("ticker"),
        "side.security",
        "reason",
        "side.action",
    ).where(F.col("ticker").isNotNull() & F.col("effective_date").isNotNull())


def membership_spans(
    current: DataFrame, changes: DataFrame, numbered: DataFrame
) -> DataFrame:
    """`(ticker, first_pos, end_pos)`: session ordinals [first_pos, end_pos) of each membership.

    Going back in time, membership on a session is the inverse of the ticker's next change,
    or today's state when none follows. A change counts if it postdates the last session
    or falls on a session. On one day an addition is undone before a removal, so a day
    with both leaves the ticker a member before it.
    """
    last_day = numbered.agg(F.max("date")).scalar()
    last_pos = numbered.agg(F.max("pos")).scalar()
    kept = (
        changes.select("ticker", F.col("effective_date").alias("date"), "action")
        .join(broadcast_daily(numbered.select("date", "pos")), "date", "left")
        .where(F.col("pos").isNotNull() | (F.col("date") > last_day))
        .groupBy("ticker", F.coalesce("pos", last_pos + 1).alias("until"), "date")
        .agg(F.max("action").alias("action"))  # "Removed" sorts after "Added"
    )
    by_ticker = Window.partitionBy("ticker").orderBy("date")
    before_change = kept.select(
        "ticker",
        F.coalesce(F.lag("until").over(by_ticker), F.lit(1)).alias("first_pos"),
        F.col("until").alias("end_pos"),
        "action",
    ).where(F.col("action") == "Removed")
    last_change = kept.groupBy("ticker").agg(F.max("until").alias("first_pos"))
    since = (
        current.select("ticker")
        .distinct()
        .join(last_change, "ticker", "left")
        .select(
            "ticker",
            F.coalesce("first_pos", F.lit(1)).alias("first_pos"),
            (last_pos + 1).alias("end_pos"),
        )
    )
    spans = before_change.drop("action").unionByName(since)
    return spans.where(F.col("first_pos") < F.col("end_pos"))


def build_universe(
    current: DataFrame,
    changes: DataFrame,
    sessions: DataFrame,
    overrides: Mapping[str, Mapping[str, str]] | None = None,
    keep: Keep = as_planned,
) -> DataFrame:
    """`(date, ticker, symbol)`: the members of every session.

    Spans of membership are found per ticker and laid out over their own sessions, so
    nothing larger than the result is built.
    """
    numbered = keep(number_sessions(sessions))
    days = membership_spans(current, changes, numbered).select(
        "ticker", F.explode(F.sequence("first_pos", F.col("end_pos") - 1)).alias("pos")
    )
    return days.join(F.broadcast(numbered.select("pos", "date")), "pos").select(  # one row per date
        "date", "ticker", spelled("ticker", "option", overrides).alias("symbol")
    )
