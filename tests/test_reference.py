"""Names, calendar, membership, vendor tables, data checks and quote repair."""

import datetime as dt
import random

import numpy as np
import pandas as pd
from conftest import business_days, flat_chain, market_stamps, vendor_rows
from pyspark.sql import functions as F

from tidemark.operators import calendar, quality, reference_data, repair, symbols, universe
from tidemark.operators.straddle import number_sessions


def test_tickers_are_spelled_per_source(spark):
    df = spark.createDataFrame([("BRK.B",), ("BNY",), ("ECHO",), ("NVR",)], "ticker string")
    dated = df.withColumn("date", F.lit(dt.date(2024, 1, 2)))
    got = {r.ticker: r for r in symbols.symbol_map(dated).collect()}
    assert len(got) == 4
    b = got["BRK.B"]
    assert (b.stock_symbol, b.option_symbol, b.yahoo_symbol) == ("BRK.B", "BRKB", "BRK-B")
    assert (got["BNY"].stock_symbol, got["BNY"].option_symbol, got["BNY"].yahoo_symbol) == ("BK", "BK", "BNY")
    names = lambda asset: {r.symbol for r in symbols.universe_symbols(dated, asset).collect()}
    assert names("option") == {"BRKB", "BK"}
    assert names("stock") == {"BRK.B", "BK", "NVR"}
    assert names("yahoo") == {"BRK-B", "BNY", "ECHO", "NVR"}
    assert symbols.universe_symbols(dated, "yahoo", dt.date(2024, 2, 1), dt.date(2024, 3, 1)).count() == 0


def test_sessions_are_weekdays_without_full_closures(spark):
    bounds = calendar.window_bounds(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 14))
    shut = spark.createDataFrame(
        [("2024-01-01", "full_close"), ("2024-01-03", "early_close")], "date string, type string"
    )
    got = sorted(r.date for r in calendar.weekday_sessions(bounds, shut).collect())
    want = [d for d in business_days(dt.date(2024, 1, 1), 10) if d != dt.date(2024, 1, 1)]
    assert got == want
    years = calendar.year_windows(
        calendar.window_bounds(spark, dt.date(2023, 6, 1), dt.date(2025, 2, 1))
    ).orderBy("year").collect()
    assert [(r.year, r.start, r.end) for r in years] == [
        (2023, dt.date(2023, 6, 1), dt.date(2023, 12, 31)),
        (2024, dt.date(2024, 1, 1), dt.date(2024, 12, 31)),
        (2025, dt.date(2025, 1, 1), dt.date(2025, 2, 1)),
    ]
    assert calendar.years_in(dt.date(2023, 6, 1), dt.date(2025, 2, 1)) == [2023, 2024, 2025]
    cal = calendar.weekday_sessions(bounds)
    assert calendar.trading_sessions(cal, dt.date(2024, 1, 2), dt.date(2024, 1, 4)).count() == 3


def test_change_log_is_cleaned(spark):
    rows = [
        ("March 18, 2024", "SMCI", "Super", "WHR", "Whirl", "cap"),
        ("October 31, 2011", None, None, "ITT |", "ITT", "spin"),
        ("not a date", "AAA", "a", None, None, "x"),
        ("May 1, 2020", " BRK.B", "b", "", "", "y"),
    ]
    log = spark.createDataFrame(
        rows, "effective_date string, added_ticker string, added_security string,"
        " removed_ticker string, removed_security string, reason string"
    )
    got = {(r.effective_date, r.ticker, r.action) for r in universe.clean_changes(log).collect()}
    assert got == {
        (dt.date(2024, 3, 18), "SMCI", "Added"),
        (dt.date(2024, 3, 18), "WHR", "Removed"),
        (dt.date(2011, 10, 31), "ITT", "Removed"),
        (dt.date(2020, 5, 1), "BRK.B", "Added"),
    }
    members = spark.createDataFrame([("A",), (None,)], "Symbol string")
    assert [r.ticker for r in universe.clean_constituents(members).collect()] == ["A"]


def undo_walk(current, changes, sessions):
    members, by_day, out = set(current), {}, set()
    for action in ("Added", "Removed"):
        for day, ticker, a in changes:
            if a == action:
                by_day.setdefault(day, []).append((ticker, a))

    def undo(day):
        for ticker, a in by_day.get(day, []):
            members.discard(ticker) if a == "Added" else members.add(ticker)

    for day in sorted((d for d in by_day if d > max(sessions)), reverse=True):
        undo(day)
    for day in sorted(sessions, reverse=True):
        out |= {(day, t) for t in members}
        undo(day)
    return out


def test_membership_equals_walking_the_log_backwards(spark):
    for seed in range(4):
        rnd = random.Random(seed)
        days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(40)]
        sessions = [d for d in days[5:32] if d.weekday() < 5]
        tickers = [f"T.{i}" for i in range(7)]
        current = [t for t in tickers if rnd.random() < 0.5]
        changes = [(rnd.choice(days), rnd.choice(tickers), rnd.choice(["Added", "Removed"])) for _ in range(45)]
        got = universe.build_universe(
            spark.createDataFrame([(t,) for t in current], "ticker string"),
            spark.createDataFrame(changes, "effective_date date, ticker string, action string"),
            spark.createDataFrame([(d,) for d in sessions], "date date"),
        ).collect()
        assert len(got) == len({(r.date, r.ticker) for r in got})
        assert {(r.date, r.ticker) for r in got} == undo_walk(current, changes, sessions)
        assert all(r.symbol == r.ticker.replace(".", "") for r in got)


def test_session_numbers_are_dense(spark):
    days = business_days(dt.date(2024, 1, 2), 5)
    got = number_sessions(spark.createDataFrame([(d,) for d in days + days], "date date")).orderBy("pos").collect()
    assert [(r.date, r.pos, r.last_pos) for r in got] == [(d, i + 1, 5) for i, d in enumerate(days)]


def test_announcements_are_classified_and_kept_once_a_day(spark):
    at = lambda h, m, d=1: dt.datetime(2024, 5, d, h, m)
    rows = [("A", at(16, 0)), ("A", at(16, 30)), ("B", at(9, 29)), ("C", at(9, 30)), ("D", at(15, 59))]
    df = spark.createDataFrame(
        [(s, t, 1.0, 1.1, 0.1) for s, t in rows],
        "symbol string, announced_at timestamp_ntz, eps_estimate double, reported_eps double, surprise_pct double",
    )
    got = {(r.symbol, r.session, r.announced_at) for r in reference_data.earnings_table(df).collect()}
    assert got == {("A", "amc", at(16, 0)), ("B", "bmo", at(9, 29)), ("C", "unknown", at(9, 30)),
                   ("D", "unknown", at(15, 59))}
    zoned = df.withColumn("announced_at", F.to_timestamp(F.lit("2024-05-01T20:30:00Z")))
    assert {r.session for r in reference_data.classify_session(zoned).collect()} == {"amc"}


def test_wide_prices_become_actions(spark):
    rows = [("2024-01-02", 10.0, None, 0.5, 0.0, 0.0, 2.0), ("2024-01-03", 11.0, 5.0, 0.0, 0.0, 0.0, 0.0)]
    names = ["Date", "Close|A-B", "Close|C", "Dividends|A-B", "Dividends|C", "Stock Splits|A-B", "Stock Splits|C"]
    wide = spark.createDataFrame(rows, names)
    fields = {"Close": "yahoo_close", "Dividends": "dividend", "Stock Splits": "split"}
    quotes = reference_data.tidy_prices(wide, fields, ["A-B", "C"])
    assert quotes.count() == 3
    mapping = spark.createDataFrame([("AB", "A-B"), ("C", "C")], "option_symbol string, yahoo_symbol string")
    got = {(r.symbol, r.date, r.action, r.value) for r in reference_data.build_actions(quotes, mapping).collect()}
    assert got == {("AB", dt.date(2024, 1, 2), "dividend", 0.5)}


def test_rates_yields_indices_and_sectors(spark):
    rates = spark.createDataFrame([("2024-01-02", "SOFR", 5.31)] * 2, "created string, symbol string, rate double")
    assert [(r.symbol, round(r.rate, 6)) for r in reference_data.tidy_rates(rates).collect()] == [("SOFR", 0.0531)]
    quotes = spark.createDataFrame(
        [("2024-01-02", "^TNX", 4.0), ("2024-01-02", "^IRX", float("nan")), ("2024-01-02", "^FVX", None)],
        "date string, ticker string, close double",
    )
    assert [(r.tenor, r["yield"]) for r in reference_data.tidy_yields(quotes).collect()] == [("10y", 0.04)]
    bar = (dt.datetime(2024, 1, 2, 17, 15), "SPX", 1.0, 2.0, 0.5, 1.5)
    bars = spark.createDataFrame(
        [bar, bar], "created timestamp_ntz, symbol string, open double, high double, low double, close double"
    )
    assert reference_data.tidy_indices(bars).count() == 1
    listed = spark.createDataFrame(
        [("BRK.B", "Fin", "Ins"), (None, "x", "y")], ["Symbol", "GICS Sector", "GICS Sub-Industry"]
    )
    r = reference_data.sector_snapshot(listed).collect()
    assert [(x.ticker, x.symbol, x.sector, x.sub_industry) for x in r] == [("BRK.B", "BRKB", "Fin", "Ins")]


def test_symbology_gives_all_four_verdicts(spark):
    rng = np.random.default_rng(0)
    days = business_days(dt.date(2024, 1, 2), 60)
    names, spots, quotes = [], [], []
    for s, noise, n in (("OK", 0.0, 60), ("BAD", 0.02, 60), ("MEH", 0.003, 60), ("THIN", 0.0, 10), ("NONE", 0.0, 0)):
        level = 100 * np.exp(np.cumsum(rng.normal(0, 0.01, 60)))
        other = level * np.exp(rng.normal(0, noise, 60)) if noise else level * 0.5
        names.append((s, f"Y-{s}"))
        spots += [(s, d, float(x)) for d, x in zip(days, level, strict=True)]
        quotes += [(f"Y-{s}", d, float(x)) for d, x in zip(days[:n], other[:n], strict=True)]
    flat = [("FLAT", d, 5.0) for d in days]
    checks = quality.symbology_check(
        spark.createDataFrame(spots + flat, "symbol string, date date, theta_spot double"),
        spark.createDataFrame(quotes + [("Y-FLAT", d, 7.0) for d in days], "yahoo_symbol string, date date, yahoo_close double"),
        spark.createDataFrame(names + [("FLAT", "Y-FLAT")], "option_symbol string, yahoo_symbol string"),
    )
    got = {r.symbol: r for r in checks.collect()}
    assert {s: r.status for s, r in got.items()} == {
        "OK": "ok", "BAD": "wrong_instrument", "MEH": "suspect", "THIN": "thin_overlap",
        "NONE": "thin_overlap", "FLAT": "ok",
    }
    assert got["NONE"].overlap_days == 0 and got["OK"].theta_days == 60
    assert abs(got["OK"].return_correlation - 1) < 1e-9 and np.isnan(got["FLAT"].return_correlation)
    assert {(r.status, r.symbols) for r in quality.status_counts(checks).collect()} == {
        ("ok", 2), ("wrong_instrument", 1), ("suspect", 1), ("thin_overlap", 2)
    }


def test_spots_are_medians_of_positive_prices(spark):
    day = dt.date(2024, 1, 2)
    df = spark.createDataFrame([("A", day, x) for x in (0.0, 1.0, 2.0, 9.0)], "symbol string, date date, underlying double")
    assert quality.stored_spots(df).first().theta_spot == 2.0


def test_unquoted_sessions_are_found_and_patched_from_the_last_bar(spark):
    days = business_days(dt.date(2024, 1, 2), 4)
    good = flat_chain(days)
    empty = good["date"].isin(days[1:3])
    chain = good.assign(vanna=0.7)
    chain.loc[empty, ["bid", "ask", "mid"]] = 0.0
    raw = vendor_rows(good[empty])
    late = raw.assign(bid=raw["bid"] + 0.01, ask=raw["ask"] + 0.01, timestamp=raw["timestamp"] - pd.Timedelta(minutes=1))
    early = raw.assign(bid=99.0, ask=99.0, timestamp=raw["timestamp"] - pd.Timedelta(minutes=30))
    late.loc[late["strike"] == 80.0, "ask"] = 0.0
    bars = market_stamps(spark.createDataFrame(pd.concat([early, late])), "timestamp", "underlying_timestamp")
    stored = spark.createDataFrame(chain)
    sessions = repair.unquoted_sessions(stored)
    assert sorted(r.date for r in sessions.collect()) == days[1:3]
    tasks = repair.repair_tasks(stored, sessions)
    assert tasks.count() == 2 * good["expiration"].nunique()
    assert repair.repair_tasks(stored, sessions, tasks.where(F.col("date") == days[1])).count() == good["expiration"].nunique()
    fixed = repair.apply_patch(stored, repair.build_patch(repair.last_bars(bars)))
    assert fixed.columns == stored.columns and fixed.count() == len(chain)
    got = fixed.toPandas().merge(good, on=["date", "expiration", "strike", "right"], suffixes=("", "_good"))
    patched = got[got["date"].isin(days[1:3]) & (got["strike"] != 80.0)]
    np.testing.assert_allclose(patched["bid"], patched["bid_good"] + 0.01)
    np.testing.assert_allclose(patched["mid"], (patched["bid"] + patched["ask"]) / 2)
    np.testing.assert_allclose(patched["vega"], patched["vega_good"], rtol=1e-12)
    assert patched["gamma"].isna().all() and patched["vanna"].isna().all()
    rest = got.drop(patched.index)
    assert rest["gamma"].notna().all() and (rest["vanna"] == 0.7).all()
    assert (rest.loc[rest["date"].isin(days[1:3]), "ask"] == 0.0).all()
