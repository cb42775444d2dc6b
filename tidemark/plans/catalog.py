"""The registered queries: every operator on panels built from the benchmark tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import canonical, calendar, quality, reference_data, repair, risk, signals
from tidemark.operators import straddle, surface, symbols, universe
from tidemark.operators.features import stock_features
from tidemark.operators.forecast import (
    HARConfig,
    fits_from_sums,
    har_coefficients,
    har_forecast,
    har_increments,
    har_rows,
    latest_fit,
    refit_dates,
)
from tidemark.operators.pricing import reprice_chain
from tidemark.operators.realized_vol import market_return, realized_vol, spot_panel
from tidemark.plans import jobs
from tidemark.plans.views import FIELDS, MARKET, Views, land_files
from tidemark.session import materialize, scratch_dir
from tidemark.sources.buckets import read_bucketed, write_bucketed
from tidemark.sources.landing import relaxed_union
from tidemark.sources.store import Store

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SPEC = risk.FactorSpec()
HAR = HARConfig()
# the benchmark tables list 25 names a day, fewer than the default floor
SIGNALS = signals.SignalConfig(min_names=8)
OVERRIDES = {"option": {"Brand.7": "Brand.77"}, "yahoo": {}, "stock": {}}


def query(build: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Views(spark, sf_dir))
    return build


def rounded(df: DataFrame, digits: int = 6, skip: tuple[str, ...] = ()) -> DataFrame:
    """Doubles to a fixed number of decimals: engines add up floats in different orders."""
    return df.select(
        *[
            F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
            if isinstance(f.dataType, T.DoubleType) and f.name not in skip
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def with_clocks(df: DataFrame, *stamps: str) -> DataFrame:
    """Stamps as text, so that they compare alike whatever zone a session has."""
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in stamps})


# --- realized vol and features ---------------------------------------------------------------


def _rv(v: Views) -> tuple[DataFrame, DataFrame]:
    return realized_vol(v.closes), realized_vol(v.market_closes)


@query
def realized_vol_panel(v: Views) -> DataFrame:
    names, market = _rv(v)
    return rounded(names.unionByName(market))


QUERIES["realized_vol"] = QUERIES.pop("realized_vol_panel")


@query
def stock_feature_panel(v: Views) -> DataFrame:
    return rounded(_features(v))


QUERIES["stock_features"] = QUERIES.pop("stock_feature_panel")


@query
def spot_from_chain(v: Views) -> DataFrame:
    return spot_panel(v.chain, v.actions)


@query
def market_move(v: Views) -> DataFrame:
    return rounded(market_return(v.market), 9)


QUERIES["market_return"] = QUERIES.pop("market_move")

# --- surface ---------------------------------------------------------------------------------


@query
def atm_pillars(v: Views) -> DataFrame:
    return rounded(surface.atm_pillars(v.chain), 9)


def _surface(v: Views) -> DataFrame:
    return surface.surface_panel(v.chain)


QUERIES["surface"] = lambda spark, sf: rounded(_surface(Views(spark, sf)), 9)


@query
def surface_extrapolated(v: Views) -> DataFrame:
    pillars = surface.atm_pillars(v.chain)
    return rounded(surface.tenor_columns(pillars, ["date", "symbol"], (10, 180), extrapolate=True), 9)


# --- straddle --------------------------------------------------------------------------------


@query
def near_money_chain(v: Views) -> DataFrame:
    near = straddle.near_money(v.chain)
    return near.select(
        "date", "symbol", "expiration", "strike", "right",
        F.datediff("expiration", "date").alias("dte"), "mid",
    )


@query
def straddle_select(v: Views) -> DataFrame:
    return straddle.select_units(straddle.near_money(v.chain))


@query
def straddle_mark(v: Views) -> DataFrame:
    marks = straddle.mark_units(straddle.near_money(v.chain))
    half = straddle.half_spread_dollars(F.col("ask"), F.col("bid"))
    return rounded(marks.withColumn("half_spread", half), 6, skip=("underlying",))


@query
def straddle_exits(v: Views) -> DataFrame:
    """The next exit of every possible entry."""
    near = materialize(straddle.near_money(v.chain))
    numbered = straddle.number_sessions(v.sessions)
    picks = straddle.select_units(near)
    exits = straddle.unit_exits(straddle.mark_units(near), numbered)
    return exits.join(picks, ["date", *straddle.UNIT], "left_semi").select(
        "symbol", "date", "expiration", "strike", "pos",
        F.col("exit_pos").cast("double").alias("exit_pos"), "exit_kind",
    )


@query
def straddle_path(v: Views) -> DataFrame:
    path = straddle.reference_path(v.chain, v.sessions, keep=materialize)
    return rounded(path.withColumn("dte", F.col("dte").cast("double")))


# --- pricing and canonical rows ----------------------------------------------------------------


@query
def repriced(v: Views) -> DataFrame:
    out = reprice_chain(v.chain, rate=0.03)
    return rounded(
        out.select(
            "date", "symbol", "expiration", "strike", "right",
            "bs_price", "bs_delta", "bs_gamma", "bs_vega", "bs_theta",
        )
    )


QUERIES["reprice_chain"] = QUERIES.pop("repriced")


@query
def vega_residuals(v: Views) -> DataFrame:
    return rounded(canonical.vega_residuals(v.chain).drop("move_per_vega"))


@query
def canonical_chain(v: Views) -> DataFrame:
    return with_clocks(canonical.canonical_chain(v.vendor_chain), "timestamp", "underlying_timestamp")


@query
def vega_scale(v: Views) -> DataFrame:
    return rounded(canonical.vega_scale(v.vendor_chain))


@query
def open_interest(v: Views) -> DataFrame:
    return canonical.canonical_open_interest(v.oi_rows, "arrival")


@query
def canonical_stock(v: Views) -> DataFrame:
    return with_clocks(canonical.canonical_stock(v.stock_rows), "created")


# --- names, calendar, universe ------------------------------------------------------------------


@query
def symbol_map(v: Views) -> DataFrame:
    return v.names


@query
def universe_symbols(v: Views) -> DataFrame:
    out = None
    for asset in ("option", "yahoo", "stock"):
        gone = ["Brand.9"] if asset == "option" else []
        names = symbols.universe_symbols(v.universe, asset, unavailable=gone, overrides=OVERRIDES)
        tagged = names.select(F.lit(asset).alias("asset"), "symbol")
        out = tagged if out is None else out.unionByName(tagged)
    return out


@query
def windowed_prices(v: Views) -> DataFrame:
    """Prices dated in a window with both bounds."""
    return symbols.in_window(v.spot, dt.date(1994, 6, 1), dt.date(1996, 5, 31)).select("date", "symbol", "close")


def _calendar(v: Views) -> DataFrame:
    return calendar.weekday_sessions(v.bounds, v.closures)


QUERIES["calendar"] = lambda spark, sf: _calendar(Views(spark, sf))


@query
def year_windows(v: Views) -> DataFrame:
    return calendar.year_windows(v.bounds)


@query
def constituent_changes(v: Views) -> DataFrame:
    changes = universe.clean_changes(v.change_log)
    return changes.groupBy("effective_date", "ticker", "action", "security", "reason").agg(
        F.count("*").alias("n")
    )


@query
def current_constituents(v: Views) -> DataFrame:
    return universe.clean_constituents(v.current)


QUERIES["universe"] = lambda spark, sf: _universe(Views(spark, sf))


def _universe(v: Views) -> DataFrame:
    return universe.build_universe(
        universe.clean_constituents(v.current),
        universe.clean_changes(v.change_log),
        _calendar(v),
        keep=materialize,
    )


# --- reference data ------------------------------------------------------------------------------


@query
def earnings(v: Views) -> DataFrame:
    return reference_data.earnings_table(v.announcements)


@query
def session_classes(v: Views) -> DataFrame:
    return reference_data.classify_session(v.announcements).groupBy("session").agg(F.count("*").alias("n"))


@query
def corporate_actions(v: Views) -> DataFrame:
    return v.actions.select("symbol", "date", "action", "value")


@query
def tidy_prices(v: Views) -> DataFrame:
    wide = v.wide_prices
    tickers = sorted({c.split("|")[1] for c in wide.columns if "|" in c})
    return reference_data.tidy_prices(wide, FIELDS, tickers)


@query
def rates(v: Views) -> DataFrame:
    return reference_data.tidy_rates(v.rate_rows)


@query
def yields(v: Views) -> DataFrame:
    return reference_data.tidy_yields(v.yield_rows)


@query
def indices(v: Views) -> DataFrame:
    return reference_data.tidy_indices(v.index_rows)


@query
def sectors(v: Views) -> DataFrame:
    return reference_data.sector_snapshot(v.constituents)


# --- quality and repair --------------------------------------------------------------------------


def _checks(v: Views) -> DataFrame:
    spots = v.spot.select("symbol", "date", F.col("close").alias("theta_spot"))
    checks = quality.symbology_check(spots, v.quotes, v.names)
    return checks.withColumn("action_gap_days", F.col("action_gap_days").cast("double"))


QUERIES["symbology_check"] = lambda spark, sf: rounded(_checks(Views(spark, sf)))
QUERIES["symbology_status"] = lambda spark, sf: quality.status_counts(_checks(Views(spark, sf)))


@query
def stored_spots(v: Views) -> DataFrame:
    return quality.stored_spots(v.chain)


@query
def unquoted_sessions(v: Views) -> DataFrame:
    return repair.unquoted_sessions(v.chain)


@query
def repair_tasks(v: Views) -> DataFrame:
    chain = materialize(v.chain.select("symbol", "date", "expiration", "strike", "underlying", "ask"))
    return repair.repair_tasks(chain, repair.unquoted_sessions(chain))


@query
def repair_patch(v: Views) -> DataFrame:
    patch = repair.build_patch(repair.last_bars(v.bars))
    return patch.select(
        "date", "symbol", "expiration", "strike", "right",
        "bid_new", "ask_new", "iv_new", "vega_new", "underlying_new", "underlying_timestamp_new",
    )


@query
def repaired_chain(v: Views) -> DataFrame:
    patch = repair.build_patch(repair.last_bars(v.bars))
    fixed = repair.apply_patch(v.chain, patch)
    return fixed.select(
        "date", "symbol", "expiration", "strike", "right", "bid", "ask", "mid", "iv", "gamma", "vega"
    )


# --- risk model ------------------------------------------------------------------------------------


def _factors(v: Views) -> DataFrame:
    return risk.factor_returns(v.returns, v.market_returns, v.supplier_sectors, SPEC)


QUERIES["sector_means"] = lambda spark, sf: rounded(
    risk.sector_means(Views(spark, sf).returns, Views(spark, sf).supplier_sectors)
)
QUERIES["factor_returns"] = lambda spark, sf: rounded(_factors(Views(spark, sf)))


def _loadings(v: Views) -> tuple[DataFrame, DataFrame]:
    return risk.rolling_loadings(v.returns, materialize(_factors(v)), v.supplier_sectors, SPEC, materialize)


QUERIES["factor_loadings"] = lambda spark, sf: rounded(_loadings(Views(spark, sf))[0])
QUERIES["idio_vol"] = lambda spark, sf: rounded(_loadings(Views(spark, sf))[1])


@query
def dense_factors(v: Views) -> DataFrame:
    return rounded(risk.dense_factors(_factors(v)))


@query
def sample_covariances(v: Views) -> DataFrame:
    spec = risk.FactorSpec(SPEC.window, SPEC.min_observations, shrinkage=False)
    return rounded(risk.rolling_covariances(materialize(_factors(v)), spec))


@query
def factor_covariances(v: Views) -> DataFrame:
    return rounded(risk.rolling_covariances(materialize(_factors(v)), SPEC))


# --- forecast ----------------------------------------------------------------------------------------


@query
def month_starts(v: Views) -> DataFrame:
    return refit_dates(_calendar(v))


QUERIES["refit_dates"] = QUERIES.pop("month_starts")


@query
def coefficients(v: Views) -> DataFrame:
    names, market = _rv(v)
    both = names.withColumn("in_fit", F.lit(True)).unionByName(
        market.withColumn("in_fit", F.lit(False))
    )
    return rounded(har_coefficients(har_rows(both, HAR), HAR), 5)


QUERIES["har_coefficients"] = QUERIES.pop("coefficients")


@query
def last_fit(v: Views) -> DataFrame:
    names, market = _rv(v)
    both = names.withColumn("in_fit", F.lit(True)).unionByName(
        market.withColumn("in_fit", F.lit(False))
    )
    return rounded(latest_fit(har_coefficients(har_rows(both, HAR), HAR)), 5)


QUERIES["latest_fit"] = QUERIES.pop("last_fit")


def _forecast(v: Views) -> DataFrame:
    names, market = _rv(v)
    return har_forecast(materialize(names), materialize(market), HAR, materialize)[0]


QUERIES["har_forecast"] = lambda spark, sf: rounded(_forecast(Views(spark, sf)))

# --- signals -------------------------------------------------------------------------------------------


def _vrp(v: Views) -> DataFrame:
    return signals.variance_premium(_surface(v), _forecast(v))


QUERIES["variance_premium"] = lambda spark, sf: rounded(_vrp(Views(spark, sf)))


@query
def sector_medians(v: Views) -> DataFrame:
    """The median premium of each (date, sector), names without a sector together."""
    vrp = _vrp(v).where(F.col("symbol") != MARKET).join(v.brand_sectors, "symbol", "left")
    return rounded(vrp.groupBy("date", "sector").agg(F.median("vrp").alias("sector_median")))


def _features(v: Views) -> DataFrame:
    return stock_features(v.closes, market_return(v.market_closes))


@query
def vrp_residuals(v: Views) -> DataFrame:
    frame = signals.vrp_frame(_surface(v), _forecast(v), _features(v), v.brand_sectors, SIGNALS, materialize)
    x = ["market", "sector_median", *SIGNALS.controls]
    return rounded(signals.residualize_daily(frame, "vrp", x, SIGNALS.min_names))


def _signal_pieces(v: Views) -> dict[str, DataFrame]:
    panel = materialize(_surface(v))
    return {
        "vrp": signals.vrp_signal(panel, _forecast(v), _features(v), v.brand_sectors, SIGNALS, materialize),
        "iv_zscore": signals.iv_zscore_signal(panel, SIGNALS),
        "momentum": signals.momentum_signal(v.returns, SIGNALS, materialize),
    }


@query
def signal_vrp(v: Views) -> DataFrame:
    score = signals.vrp_signal(_surface(v), _forecast(v), _features(v), v.brand_sectors, SIGNALS, materialize)
    return rounded(score)


@query
def signal_iv_zscore(v: Views) -> DataFrame:
    return rounded(signals.iv_zscore_signal(_surface(v), SIGNALS))


@query
def signal_momentum(v: Views) -> DataFrame:
    return rounded(signals.momentum_signal(v.returns, SIGNALS, materialize))


QUERIES["signals"] = lambda spark, sf: rounded(
    signals.combine_signals(_signal_pieces(Views(spark, sf))), 5
)
QUERIES["signal_summary"] = lambda spark, sf: signals.signal_summary(
    signals.combine_signals(_signal_pieces(Views(spark, sf)))
)

# --- the store -----------------------------------------------------------------------------------------


def _scratch_store(v: Views) -> Store:
    return Store(v.spark, f"{scratch_dir(v.spark)}/tidemark-store-{uuid.uuid4().hex}")


@query
def store_round_trip(v: Views) -> DataFrame:
    """Write a year-partitioned table, replace all its partitions, read every year back."""
    store = _scratch_store(v)
    store.write("underlying", v.spot.withColumn("close", F.lit(0.0)))
    store.write("underlying", v.spot)
    return store.scan("underlying").select(
        "date", "symbol", "close", "year", F.col("volume").cast("double").alias("volume")
    )


@query
def store_accumulate(v: Views) -> DataFrame:
    """Rewrite two symbols of an unpartitioned table from itself; the others stay."""
    store = _scratch_store(v)
    store.write("rates", reference_data.tidy_rates(v.rate_rows))
    again = ["1-URGENT", "2-HIGH"]
    doubled = store.read("rates").where(F.col("symbol").isin(again)).withColumn("rate", F.col("rate") * 2)
    store.accumulate("rates", doubled, "symbol", again)
    return store.read("rates")


@query
def store_pending(v: Views) -> DataFrame:
    """Years of a wanted window that the stored prices do not cover."""
    store = _scratch_store(v)
    store.write("underlying", v.spot)
    wider = v.bounds.select(
        F.add_months("start", -12).alias("start"), F.add_months("end", 24).alias("end")
    )
    return store.pending("underlying", calendar.year_windows(wider).select("year"))


WINDOW = (dt.date(1994, 6, 1), dt.date(1996, 5, 31))


@query
def stored_window(v: Views) -> DataFrame:
    """Prices of seven stored years, of which a window of two years opens three."""
    store = _scratch_store(v)
    store.write("underlying", v.spot)
    return store.scan("underlying", start=WINDOW[0], end=WINDOW[1]).select("date", "symbol", "close", "year")


@query
def bucketed_premium(v: Views) -> DataFrame:
    """The variance premium of two panels stored by the same buckets of their keys."""
    left, right = bucketed_panels(v)
    return rounded(signals.variance_premium(left, right))


def bucketed_panels(v: Views, buckets: int = 16) -> tuple[DataFrame, DataFrame]:
    root = f"{scratch_dir(v.spark)}/tidemark-panels-{uuid.uuid4().hex}"
    stored = []
    for name, panel in (("surface", _surface(v)), ("forecast", _forecast(v))):
        write_bucketed(panel, f"{root}/{name}", buckets=buckets)
        stored.append(read_bucketed(v.spark, f"{root}/{name}", buckets=buckets))
    return stored[0], stored[1]


@query
def ingested_chain(v: Views) -> DataFrame:
    """Landed chain files, one per symbol and year, taken into the store and read back whole: all columns by symbol-day.

    From 1996 on the files have one column more, and of each symbol the first session of a year landed with the year before.
    """
    source = f"{scratch_dir(v.spark)}/tidemark-landed-{uuid.uuid4().hex}"
    day = F.to_date("timestamp")
    dated = v.vendor_chain.withColumn("_day", day)
    firsts = dated.groupBy("symbol", F.year("_day").alias("year")).agg(F.min("_day").alias("_first"))
    both = dated.withColumn("year", F.year("_day")).join(firsts, ["symbol", "year"])
    early = (F.col("_day") == F.col("_first")).cast("int")
    landed = both.withColumn("year", F.col("year") - early).drop("_day", "_first")
    land_files(landed.where("year < 1996"), source, "option_greeks")
    land_files(landed.where("year >= 1996").withColumn("vanna", F.col("strike") / 2), source, "option_greeks")
    store = _scratch_store(v)
    jobs.migrate_chains(store, source, "option_greeks", "option_greeks")
    rows = with_clocks(store.scan("option_greeks"), "timestamp", "underlying_timestamp")
    days = ["symbol", "year", "date"]
    values = [f for f in rows.schema if f.name not in days]
    numbers = [f.name for f in values if isinstance(f.dataType, (T.DoubleType, T.LongType))]
    others = [f.name for f in values if f.name not in numbers]
    return rows.groupBy(*days).agg(
        F.count("*").alias("n"),
        *[F.round(F.sum(F.col(c).cast("double")), 3).alias(c) for c in numbers],
        *[F.count(c).alias(f"n_{c}") for c in ("iv", "vanna")],
        *[F.min(c).alias(f"first_{c}") for c in others],
        *[F.max(c).alias(f"last_{c}") for c in others],
    )


@query
def pending_paths(v: Views) -> DataFrame:
    """Straddle paths of a store that holds those of some symbols already: the job adds the others alone."""
    store = _scratch_store(v)
    chain = v.chain.withColumn("year", F.year("date"))
    store.write("option_greeks", chain.where(F.col("symbol") != MARKET))
    store.write("index_greeks", chain.where(F.col("symbol") == MARKET))
    store.write("universe", v.universe.withColumn("symbol", F.replace("ticker", F.lit("."), F.lit(""))))
    store.write("calendar", v.sessions)
    days = v.sessions.agg(F.min("date"), F.max("date")).first()
    done = straddle.reference_path(v.chain.where(F.col("symbol").endswith("1")), v.sessions, keep=materialize)
    # what is stored stays as it is
    store.write("reference_returns", done.withColumn("entry_vega", -F.col("entry_vega")))
    jobs.run_reference_returns(store, days[0], days[1])
    path = store.scan("reference_returns").drop("year")
    return rounded(path.withColumn("dte", F.col("dte").cast("double")))


@query
def har_instalments(v: Views) -> DataFrame:
    """The fits from sums of products stored in two instalments, the second on what became known since the first."""
    path = f"{scratch_dir(v.spark)}/tidemark-sums-{uuid.uuid4().hex}"
    until = dt.date(1996, 6, 28)
    for end, after in ((until, None), (None, until)):
        names = realized_vol(symbols.in_window(v.closes, end=end)).withColumn("in_fit", F.lit(True))
        market = realized_vol(symbols.in_window(v.market_closes, end=end)).withColumn("in_fit", F.lit(False))
        har_increments(names.unionByName(market), HAR, after).write.mode("append").parquet(path)
    return rounded(fits_from_sums(v.spark.read.parquet(path), HAR), 5)


@query
def migrated_tables(v: Views) -> DataFrame:
    """Old files of two layouts taken into their tables: members from two files of unlike columns, and rates."""
    source = f"{scratch_dir(v.spark)}/tidemark-old-{uuid.uuid4().hex}"
    members = v.universe.where("date < DATE'1996-01-01'")
    members.withColumn("note", F.lit("old")).write.parquet(f"{source}/universe_history.parquet")
    v.universe.where("date >= DATE'1996-01-01'").write.parquet(f"{source}/universe.parquet")
    reference_data.tidy_rates(v.rate_rows).write.parquet(f"{source}/rates.parquet")
    store = _scratch_store(v)
    fed = jobs.migrate_tables(store, source)
    pieces = {"universe": F.col("symbol"), "calendar": F.lit(""), "rates": F.col("symbol")}
    assert fed == list(pieces)
    out = None
    for name, symbol in pieces.items():
        kept = store.read(name).select(F.lit(name).alias("table"), symbol.alias("symbol"), F.year("date").alias("year"))
        counted = kept.groupBy("table", "symbol", "year").agg(F.count("*").alias("n"))
        out = counted if out is None else out.unionByName(counted)
    return out


@query
def session_window(v: Views) -> DataFrame:
    """Sessions of the stored calendar in a window, and whether the store has partitions of their years."""
    store = _scratch_store(v)
    store.write("calendar", _calendar(v))
    store.write("underlying", v.spot.where("date < DATE'1995-01-01'"))
    stored = [y for y in calendar.years_in(*WINDOW) if store.partition_exists("underlying", year=y)]
    return calendar.trading_sessions(store.read("calendar"), *WINDOW).select(
        "date", F.year("date").isin(stored).alias("has_prices")
    )


@query
def write_order(v: Views) -> DataFrame:
    """The place of each stored row in its file, by the primary key the writer sorts by."""
    store = _scratch_store(v)
    store.write("rates", reference_data.tidy_rates(v.rate_rows).coalesce(1))
    rows = store.read("rates").select("date", "symbol", F.col("_metadata.row_index").alias("place"), F.col("_metadata.file_path").alias("_file"))
    return rows.withColumn("place", F.col("place") - F.min("place").over(Window.partitionBy("_file"))).drop("_file")


@query
def price_union(v: Views) -> DataFrame:
    """Two sources of unlike columns stacked by name."""
    trades = v.spot.withColumn("source", F.lit("trades"))
    market = v.market.select("symbol", "close", F.lit("market").alias("source"))
    return rounded(
        relaxed_union([trades, market])
        .groupBy("symbol", "source")
        .agg(F.count("*").alias("days"), F.sum("close").alias("total")),
        2,
    )


def queries() -> dict[str, Query]:
    return dict(QUERIES)
