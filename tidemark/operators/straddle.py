"""Rolled, delta-hedged at-the-money straddles: one path per symbol, as joins and windows.

A path looks sequential, but nothing in it depends on the path so far except which unit
is held. Whether a unit would be rolled or closed on a session follows from its own marks
alone, because a unit is always marked on the day it is entered. So every unit's exits
are found first, each possible entry gets the next exit and the next entry after it, the
chain of entries is followed per symbol, and the money columns are windows over the
sessions held.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import days_between, moneyness, ratio
from tidemark.functions.groups import (
    broadcast_daily,
    by_count,
    by_day,
    by_fraction,
    by_price,
    first_row,
)
from tidemark.session import Keep, as_planned

CONTRACT_MULTIPLIER = 100

# The monthly series expires on the third Friday of its month, or on the
# Thursday before it when that Friday is a holiday (weekday() counts from Monday = 0).
MONTHLY_WEEKDAYS = (3, 4)
MONTHLY_DAYS = (15, 21)

UNIT = ["symbol", "expiration", "strike"]


@dataclass(frozen=True)
class StraddleConfig:
    target_dte: int = 60
    roll_dte: int = 20
    min_dte: int = 25
    max_dte: int = 120
    max_moneyness: float = 0.10
    restrike_moneyness: float = 0.15
    max_stale_days: int = 5
    hedge_cost_per_share: float = 0.005
    chain_max_dte: int = 130
    chain_max_moneyness: float = 0.30


def near_money(chain: DataFrame, config: StraddleConfig = StraddleConfig()) -> DataFrame:
    """Contract rows close enough in maturity and strike to matter to a path."""
    return chain.where(
        (days_between("expiration", "date") <= config.chain_max_dte)
        & (moneyness("strike", "underlying") <= config.chain_max_moneyness)
    )


def unit_days(chain: DataFrame) -> DataFrame:
    """One row per (date, symbol, expiration, strike) with all a path reads of its two legs.

    Every later step works from this frame, so the chain is scanned and shuffled once.
    `legs` counts markable rows and the sums run over them, a null adding nothing;
    `both_quoted` tells whether call and put have a live market. A spot is that of the
    first row in contract order, the call before the put.
    """
    markable = (F.col("ask") > 0) & (F.col("bid") >= 0) & (F.col("ask") >= F.col("bid"))
    quoted = (F.col("bid") > 0) & (F.col("ask") > F.col("bid"))
    right = F.ascii("right")  # a number keeps the aggregate hash-based
    total = lambda c: F.coalesce(F.sum(F.when(markable, F.col(c))), F.lit(0.0)).alias(c)
    return chain.groupBy("date", *UNIT).agg(
        *[total(c) for c in ("mid", "bid", "ask", "delta", "vega", "theta")],
        F.count(F.when(markable, 1)).alias("legs"),
        F.coalesce(
            F.min(F.when(quoted, right)) != F.max(F.when(quoted, right)), F.lit(False)
        ).alias("both_quoted"),
        F.min_by("underlying", F.when(markable, right)).alias("mark_spot"),
        F.min_by("underlying", F.when(quoted, right)).alias("quote_spot"),
        F.min_by("underlying", right).alias("first_spot"),
    )


def _picks(units: DataFrame, config: StraddleConfig) -> DataFrame:
    dte = days_between("expiration", "date")
    pairs = units.where(
        F.col("both_quoted")
        & dte.between(config.min_dte, config.max_dte)
        & F.dayofmonth("expiration").between(*MONTHLY_DAYS)
        & F.weekday("expiration").isin(*MONTHLY_WEEKDAYS)
        & (moneyness("strike", "quote_spot") <= config.max_moneyness)
    )
    return first_row(
        pairs,
        ["date", "symbol"],
        [
            # the distance from the target, and of two alike the longer maturity
            by_count(2 * F.abs(dte - config.target_dte) + (dte < config.target_dte).cast("int"), 24),
            by_fraction(moneyness("strike", "quote_spot")),
            by_price("strike"),
        ],
        keep=["expiration", "strike"],
    )


def _marks(units: DataFrame) -> DataFrame:
    return units.where(F.col("legs") >= 2).select(
        "date", *UNIT, "mid", "bid", "ask", "delta", "vega", "theta",
        F.col("mark_spot").alias("underlying"),
    )


def select_units(chain: DataFrame, config: StraddleConfig = StraddleConfig()) -> DataFrame:
    """`(date, symbol, expiration, strike)` a path would enter on each symbol-day.

    Monthly expirations with both rights quoted near the money; nearest the target
    maturity first, then the longer series, the strike nearest spot, the lower strike.
    """
    return _picks(unit_days(chain), config)


def mark_units(chain: DataFrame) -> DataFrame:
    """Both legs of every straddle summed per symbol-day; fewer than two usable rows, no mark."""
    return _marks(unit_days(chain))


def half_spread_dollars(ask: Column, bid: Column) -> Column:
    return F.lit(0.5) * (ask - bid) * F.lit(CONTRACT_MULTIPLIER)


def number_sessions(sessions: DataFrame) -> DataFrame:
    """`(date, pos, last_pos)`: the ordinal of each session and of the final one.

    One row per calendar date, so a single ordering task is enough.
    """
    return sessions.select("date").distinct().select(
        "date",
        F.row_number().over(Window.orderBy("date")).alias("pos"),
        F.count("*").over(Window.partitionBy()).cast("int").alias("last_pos"),
    )


def days_to_sessions(numbered: DataFrame) -> DataFrame:
    """`(day, pos)`: every calendar day up to the last session, with the first session on or after it."""
    spans = numbered.withColumn("before", F.lag("date").over(Window.orderBy("date")))
    return spans.select(
        F.explode(
            F.sequence(F.coalesce(F.date_add("before", 1), F.col("date")), F.col("date"))
        ).alias("day"),
        "pos",
    )


def unit_exits(
    marks: DataFrame, numbered: DataFrame, config: StraddleConfig = StraddleConfig()
) -> DataFrame:
    """Each mark with the first session after it on which its unit would be given up.

    Adds the session's ordinal `pos`, and `exit_pos` and `exit_kind` (`roll` or
    `forced_close`), null when the unit lasts to the final session. A marked session rolls at `roll_dte` or on drift. An unmarked one
    closes when more than `max_stale_days` sessions have passed since the last mark, or
    at expiration; both follow from the gap to the next mark, so no grid of unit x session
    is built.
    """
    expiry = days_to_sessions(numbered).select(
        F.col("day").alias("expiration"), F.col("pos").alias("expiry_pos")
    )
    held = marks.join(broadcast_daily(numbered), "date", "inner").join(
        broadcast_daily(expiry, "expiration"), "expiration", "left"
    )
    # backwards in time, so that "what comes next" is a growing frame
    in_unit = Window.partitionBy(*UNIT).orderBy(F.desc("pos"))
    next_mark = F.lag("pos").over(in_unit)
    due = F.least(
        F.col("pos") + F.lit(config.max_stale_days + 1),
        F.when(F.col("expiry_pos").isNotNull(), F.greatest("expiry_pos", F.col("pos") + 1)),
    )
    rolls = (days_between("expiration", "date") <= config.roll_dte) | (
        moneyness("strike", "underlying") > config.restrike_moneyness
    )
    events = held.withColumn(
        "starves",
        F.when((due <= F.col("last_pos")) & (next_mark.isNull() | (due < next_mark)), due),
    ).withColumn(
        "event",
        F.when(
            rolls, F.struct(F.col("pos").alias("at"), F.lit("roll").alias("kind"))
        ).when(
            F.col("starves").isNotNull(),
            F.struct(F.col("starves").alias("at"), F.lit("forced_close").alias("kind")),
        ),
    )
    later = F.last("event", ignorenulls=True).over(
        in_unit.rowsBetween(Window.unboundedPreceding, -1)
    )
    return events.withColumn("later", later).select(
        "pos",
        "last_pos",
        *marks.columns,
        F.coalesce("starves", "later.at").alias("exit_pos"),
        F.when(F.col("starves").isNotNull(), F.lit("forced_close"))
        .otherwise(F.col("later.kind"))
        .alias("exit_kind"),
    )


def _next_entries(entries: DataFrame) -> DataFrame:
    """Each entry with the position of the entry that would follow its exit.

    A roll may re-enter on the exit session itself, a forced close only later. The next
    entry at or after a position comes from one ordered pass over entries and exits
    together, not from pairing them.
    """
    wanted = F.col("exit_pos") + F.when(F.col("exit_kind") == "forced_close", 1).otherwise(0)
    asks = entries.where(F.col("exit_pos").isNotNull()).select(
        "symbol", wanted.alias("at"), F.col("pos").alias("asker"), F.lit(None).cast("int").alias("offer")
    )
    offers = entries.select(
        "symbol", F.col("pos").alias("at"), F.lit(None).cast("int").alias("asker"), F.col("pos").alias("offer")
    )
    ahead = (
        Window.partitionBy("symbol")
        .orderBy(F.desc("at"))
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    answered = (
        asks.unionByName(offers)
        .withColumn("next_pos", F.min("offer").over(ahead))
        .where(F.col("asker").isNotNull())
        .select("symbol", F.col("asker").alias("pos"), "next_pos")
    )
    return entries.join(answered, ["symbol", "pos"], "left")


def _follow(entries: DataFrame) -> DataFrame:
    """`(symbol, pos)` of the entries a path visits, starting at each symbol's first.

    The links of one symbol (at most one per session) are folded in session order inside
    a single expression.
    """
    links = entries.groupBy("symbol").agg(
        F.sort_array(F.collect_list(F.struct("pos", "next_pos"))).alias("links")
    )
    start = F.struct(
        F.col("links")[0]["pos"].alias("target"),
        F.array().cast("array<int>").alias("seen"),
    )

    def step(state: Column, link: Column) -> Column:
        hit = link["pos"] == state["target"]
        return F.struct(
            F.when(hit, link["next_pos"]).otherwise(state["target"]).alias("target"),
            F.when(hit, F.array_append(state["seen"], link["pos"]))
            .otherwise(state["seen"])
            .alias("seen"),
        )

    return links.select(
        "symbol", F.explode(F.aggregate("links", start, step)["seen"]).alias("pos")
    )


def reference_path(
    chain: DataFrame, sessions: DataFrame, config: StraddleConfig = StraddleConfig(), keep: Keep = as_planned
) -> DataFrame:
    """Daily P&L and cost per dollar of inception vega for one unit per symbol.

    `chain` is canonical and unfiltered; `sessions` holds the dates of the path. One job
    covers all symbols.
    """
    numbered = keep(number_sessions(sessions))
    units = keep(
        unit_days(near_money(chain, config)).join(
            broadcast_daily(numbered.select("date")), "date", "left_semi"
        )
    )
    picks = keep(_picks(units, config))
    # only a unit picked on some day can be held
    wanted = picks.select(*UNIT).distinct()
    marks = keep(
        unit_exits(_marks(units).join(wanted, UNIT, "left_semi"), numbered, config)
    )
    day_spot = first_row(
        units.select("date", "symbol", "expiration", "strike", F.col("first_spot").alias("day_spot")),
        ["date", "symbol"],
        [by_day("expiration"), by_price("strike")],
        keep=["day_spot"],
    )
    entries = keep(
        _next_entries(
            picks.join(marks, ["date", *UNIT]).select(
                "symbol", "pos", "last_pos", "expiration", "strike", "vega", "exit_pos", "exit_kind"
            )
        )
    )
    held = (
        entries.join(_follow(entries), ["symbol", "pos"], "left_semi")
        .select(
            "symbol",
            F.col("pos").alias("entry_pos"),
            "expiration",
            "strike",
            (F.col("vega") * F.lit(CONTRACT_MULTIPLIER)).alias("held_vega"),
            "exit_pos",
            "exit_kind",
            "next_pos",
            F.explode(F.sequence(F.col("pos"), F.coalesce("exit_pos", "last_pos"))).alias("pos"),
        )
        .join(F.broadcast(numbered.select("date", "pos")), "pos", "inner")  # one row per date
    )
    marked = held.join(
        marks.select(
            "pos",
            *UNIT,
            "mid",
            "bid",
            "ask",
            "delta",
            F.col("vega").alias("mark_vega"),
            "theta",
            F.col("underlying").alias("mark_spot"),
        ),
        ["pos", *UNIT],
        "left",
    ).join(day_spot, ["date", "symbol"], "left")
    return normalize_path(_path_rows(marked, config))


def _path_rows(marked: DataFrame, config: StraddleConfig) -> DataFrame:
    """One row per symbol-session from the held days; a roll day merges its two units."""
    unit = Window.partitionBy("symbol", "entry_pos").orderBy("pos")
    before = unit.rowsBetween(Window.unboundedPreceding, -1)
    so_far = unit.rowsBetween(Window.unboundedPreceding, 0)
    is_marked = F.col("mid").isNotNull()
    spot_seen = F.when(is_marked, F.col("mark_spot")).otherwise(F.col("day_spot"))
    shares = F.when(is_marked, -F.col("delta") * F.lit(CONTRACT_MULTIPLIER))
    days = marked.withColumn("spot_seen", spot_seen).select(
        "*",
        shares.alias("target_shares"),
        F.last("mid", True).over(before).alias("last_mid"),
        F.last("spot_seen", True).over(before).alias("last_spot"),
        F.last(shares, True).over(before).alias("held_shares"),
        F.last("spot_seen", True).over(so_far).alias("spot"),
    )
    entering = F.col("pos") == F.col("entry_pos")
    leaving = (F.col("pos") == F.coalesce("exit_pos", F.lit(-1))) & ~entering
    forced = leaving & (F.col("exit_kind") == "forced_close")
    rolled = leaving & (F.col("exit_kind") == "roll")
    reentered = rolled & (F.coalesce("next_pos", F.lit(-1)) == F.col("pos"))
    failed = rolled & ~reentered
    fee = F.lit(config.hedge_cost_per_share)
    spread = half_spread_dollars(F.col("ask"), F.col("bid"))
    kept = is_marked & ~leaving
    zero = F.lit(0.0)
    legs = days.select(
        "symbol",
        "date",
        entering.alias("entering"),
        F.when(~entering & is_marked, (F.col("mid") - F.col("last_mid")) * CONTRACT_MULTIPLIER)
        .otherwise(zero)
        .alias("option_pnl"),
        F.when(
            ~entering,
            F.col("held_shares") * (F.coalesce("spot", "last_spot") - F.col("last_spot")),
        )
        .otherwise(zero)
        .alias("hedge_pnl"),
        F.when(entering | rolled, spread).otherwise(zero).alias("option_cost"),
        # on a roll the new unit's row settles the hedge carried over from the old one
        F.when(forced | failed, F.abs("held_shares") * fee)
        .when(kept & ~entering, F.abs(F.col("target_shares") - F.col("held_shares")) * fee)
        .otherwise(zero)
        .alias("hedge_cost"),
        F.when(entering, F.col("target_shares")).alias("opening_shares"),
        F.when(reentered, F.col("held_shares")).alias("carried_shares"),
        F.when(leaving, zero)
        .when(is_marked, F.col("mark_vega") * CONTRACT_MULTIPLIER)
        .otherwise(F.col("held_vega"))
        .alias("dollar_vega"),
        F.when(kept, F.col("theta") * CONTRACT_MULTIPLIER).otherwise(zero).alias("dollar_theta"),
        F.when(kept, spread).otherwise(zero).alias("exit_cost"),
        F.when(rolled, F.lit(None)).otherwise(F.coalesce("mid", "last_mid")).alias("mid"),
        F.when(rolled, F.lit(None)).otherwise(F.coalesce("spot", "last_spot")).alias("underlying"),
        F.when(rolled, F.lit(None))
        .otherwise(days_between("expiration", "date").cast("long"))
        .alias("dte"),
        F.when(~leaving, F.col("held_vega")).alias("inception_vega"),
        F.when(forced, F.lit("forced_close"))
        .when(failed, F.lit("roll_failed_closed"))
        .when(reentered, F.lit("roll"))
        .otherwise(F.lit(""))
        .alias("event"),
    )
    once = lambda c: F.max(c).alias(c)  # at most one row of a session carries it
    opening = F.coalesce(F.max("opening_shares"), zero)
    settled = F.when(
        F.max("opening_shares").isNotNull(),
        F.abs(opening - F.coalesce(F.max("carried_shares"), zero)) * fee,
    ).otherwise(zero)
    event = F.max("event")
    return legs.groupBy("symbol", "date").agg(
        *[
            F.sum(c).alias(c)
            for c in (
                "option_pnl", "hedge_pnl", "option_cost", "dollar_vega", "dollar_theta", "exit_cost"
            )
        ],
        (F.sum("hedge_cost") + settled).alias("hedge_cost"),
        *[once(c) for c in ("mid", "underlying", "dte", "inception_vega")],
        F.when((event == "") & F.max("entering"), F.lit("open")).otherwise(event).alias("event"),
    )


def normalize_path(records: DataFrame) -> DataFrame:
    """Scale P&L and cost by the inception vega of the unit held into each day."""
    entry = F.lag("inception_vega").over(Window.partitionBy("symbol").orderBy("date"))
    scaled = records.withColumn("entry_vega", entry)
    per = lambda top, vega: F.when(F.col(vega) > 0, ratio(top, F.col(vega)))
    return scaled.select(
        "date",
        "symbol",
        per(F.col("option_pnl") + F.col("hedge_pnl"), "entry_vega").alias("pnl_per_vega"),
        per(F.col("option_cost") + F.col("hedge_cost"), "entry_vega").alias("cost_per_vega"),
        per(F.col("exit_cost"), "inception_vega").alias("exit_cost_per_vega"),
        "dollar_vega",
        "entry_vega",
        "dollar_theta",
        "mid",
        "underlying",
        "dte",
        "event",
    )
