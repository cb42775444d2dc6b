"""What the plans of panels must look like: hashed picks, pruned partitions, joins that move nothing."""

import datetime as dt
import re
import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import forecast, reference_data, risk, signals, straddle, universe
from tidemark.operators.forecast import HARConfig, fits_from_sums, har_coefficients, har_increments, har_rows
from tidemark.plans import catalog, jobs
from tidemark.plans.views import Views
from tidemark.sources.buckets import read_bucketed, write_bucketed
from tidemark.sources.landing import layouts, read_landed, relaxed_union
from tidemark.session import materialize, release, release_scratch, written_so_far
from tidemark.sources.store import Store

from conftest import business_days, flat_chain

SF = "/root/testdata/sf0.001"

tables = pytest.mark.skipif(not Path(SF).is_dir(), reason="no benchmark tables here")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@tables
@pytest.mark.parametrize("name", ["surface", "straddle_select", "open_interest", "repair_patch", "spot_from_chain", "rates", "indices"])
def test_picks_are_hashed(spark, name):
    plan = plan_of(catalog.queries()[name](spark, SF))
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def panel_rows(spark, columns, years=(2019, 2020, 2021, 2022)):
    days = [d for y in years for d in business_days(dt.date(y, 3, 2), 4)]
    names = [c.split()[0] for c in columns.split(",")]
    rows = [tuple({"date": d, "symbol": s}.get(n, 1.5) for n in names) for d in days for s in ("A", "B", "SPX")]
    return spark.createDataFrame(rows, columns)


PANELS = {
    "reference_returns": "date date, symbol string, pnl_per_vega double, dollar_vega double",
    "realized_vol": "date date, symbol string, rv_1 double, rv_5 double, rv_22 double, rv_fwd double",
    "surface": "date date, symbol string, iv30 double, iv60 double, iv90 double",
    "forecast": "date date, symbol string, rv_fcst double",
    "stock_features": "date date, symbol string, ret double, beta double, idio_vol double, gap_freq double",
}


def test_dates_become_partition_filters(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "store"))
    for name, columns in PANELS.items():
        store.write(name, panel_rows(spark, columns))
    store.write("sectors", spark.createDataFrame([("A", "A", "Fin")], "ticker string, symbol string, sector string"))
    start, end = dt.date(2020, 3, 3), dt.date(2021, 3, 3)
    scan, seen = Store.scan, {}

    def noted(self, name, *args, **kwargs):
        df = scan(self, name, *args, **kwargs)
        seen[name] = df
        return df

    monkeypatch.setattr(Store, "scan", noted)
    jobs.run_factor_model(store, start, end)
    jobs.run_forecast(store, start, end)
    jobs.run_signals(store, start, end)
    assert set(PANELS) <= set(seen)
    for name in PANELS:
        filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan_of(seen[name]))[1]
        assert "year" in filters and "2020" in filters and "2021" in filters
        got = seen[name].agg(F.min("date"), F.max("date"), F.count("*")).first()
        assert tuple(got) == (dt.date(2020, 3, 3), dt.date(2021, 3, 3), 15)
        assert {Path(f).parts[-2 - (name == "reference_returns")] for f in seen[name].inputFiles()} >= {"year=2020"}
    assert scan(store, "surface", start=dt.date(2022, 1, 1)).count() == 12 and scan(store, "surface", end=dt.date(2019, 12, 31)).count() == 12
    with pytest.raises(FileNotFoundError):
        scan(store, "surface", start=dt.date(2030, 1, 1))


def test_bucketed_panels_are_joined_where_they_lie(spark, tmp_path):
    rows = [(f"S{i % 7}", dt.date(2020, 1, 1) + dt.timedelta(days=i // 7), float(i)) for i in range(700)]
    left = spark.createDataFrame(rows, "symbol string, date date, x double")
    right = left.where("x % 3 = 0").select("symbol", "date", (F.col("x") * 2).alias("y"))
    write_bucketed(left, str(tmp_path / "l"), buckets=5)
    write_bucketed(right, str(tmp_path / "r"), buckets=5)
    frames = [read_bucketed(spark, str(tmp_path / n), buckets=5) for n in "lr"]
    joined = frames[0].join(frames[1].hint("merge"), ["symbol", "date"])
    assert "Exchange" not in plan_of(joined) and "SortMergeJoin" in plan_of(joined)
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, left.join(right, ["symbol", "date"]).collect()))
    # a session that did not write them finds the layout too
    for table in spark.catalog.listTables():
        if table.name.startswith("tidemark_"):
            spark.sql(f"DROP TABLE {table.name}")
    again = [read_bucketed(spark, str(tmp_path / n), buckets=5) for n in "lr"]
    assert "Exchange" not in plan_of(again[0].join(again[1].hint("merge"), ["symbol", "date"]))
    write_bucketed(left.where("x < 7"), str(tmp_path / "l"), buckets=5)
    assert read_bucketed(spark, str(tmp_path / "l"), buckets=5).count() == 7


@tables
def test_panel_joins_of_the_query_move_nothing(spark):
    left, right = catalog.bucketed_panels(Views(spark, SF), 4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert "Exchange" not in plan_of(catalog.signals.variance_premium(left, right))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_pending_symbols_alone_are_opened(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    days = business_days(dt.date(2024, 1, 2), 3)
    rows = [(d, s, dt.date(2024, 3, 15), 100.0, "C", 1.0) for d in days for s in ("A", "B", "C")]
    chain = spark.createDataFrame(rows, "date date, symbol string, expiration date, strike double, right string, bid double")
    store.write("option_greeks", chain)
    store.write("universe", chain.select("date", F.col("symbol").alias("ticker"), "symbol").distinct())
    store.write("reference_returns", chain.where("symbol = 'B'").select("date", "symbol").distinct())
    todo = jobs.symbols_to_do(store, "option_greeks", "reference_returns", [2024])
    assert {r.symbol for r in todo.collect()} == {"A", "C"}
    pending = jobs.pending_chains(store, days[0], days[-1])
    assert "dynamicpruning" in plan_of(pending)
    assert {r.symbol for r in pending.select("symbol").distinct().collect()} == {"A", "C"}
    store.write("reference_returns", chain.select("date", "symbol").distinct())
    assert jobs.pending_chains(store, days[0], days[-1]).count() == 0


def test_a_wide_download_of_thousands_of_tickers_is_planned_in_seconds(spark):
    n = 5000
    tickers = [f"T{i}" for i in range(n)]
    fields = {"Close": "yahoo_close", "Dividends": "dividend", "Stock Splits": "split"}
    schema = T.StructType([T.StructField("Date", T.DateType()), *[T.StructField(f"{f}|{t}", T.DoubleType()) for f in ("Close", "Dividends") for t in tickers]])
    row = (dt.date(2024, 1, 2), *[float(i) if i % 2 else None for i in range(n)], *[0.5] * n)
    began = time.time()
    tall = reference_data.tidy_prices(spark.createDataFrame([row], schema), fields, tickers)
    plan_of(tall)
    assert time.time() - began < 60
    got = tall.collect()
    assert {(r.yahoo_symbol, r.yahoo_close, r.dividend, r.split) for r in got} == {(f"T{i}", float(i), 0.5, None) for i in range(1, n, 2)}
    assert reference_data.tidy_prices(spark.createDataFrame([(dt.date(2024, 1, 2),)], "Date date"), fields, []).count() == 0


def test_many_files_of_few_layouts_make_few_branches(spark, tmp_path):
    paths = []
    for i in range(60):
        frame = spark.range(1).select(F.lit(i).alias("k"), *([F.lit("n").alias("note")] if i % 3 == 0 else [F.lit(2**40).alias("size")]))
        frame.coalesce(1).write.parquet(str(tmp_path / f"{i}.parquet"))
        paths.append(str(tmp_path / f"{i}.parquet"))
    found = layouts(spark, paths)
    assert [len(p) for _, p in found] == [20, 40] and found[0][0].names == ["k", "note"]
    df = read_landed(spark, paths)
    assert plan_of(df).count("FileScan") == 2 and dict(df.dtypes) == {"k": "int", "note": "string", "size": "bigint"}
    assert {r.k for r in df.collect()} == set(range(60))


def test_unlike_types_are_refused_and_nulls_take_any(spark):
    day = spark.createDataFrame([(dt.date(2024, 1, 2), 1)], "d date, k int")
    stamp = spark.createDataFrame([(dt.datetime(2024, 1, 2), 2)], "d timestamp, k int")
    with pytest.raises(TypeError, match="column d is date in one place and timestamp"):
        relaxed_union([day, stamp])
    with pytest.raises(TypeError):
        relaxed_union([day, day.withColumn("k", F.lit("x"))])
    got = relaxed_union([day, day.withColumn("d", F.lit(None))])
    assert dict(got.dtypes)["d"] == "date" and got.where("d is null").count() == 1
    with pytest.raises(ValueError, match="nothing"):
        relaxed_union([])


def test_sums_of_products_in_instalments_are_those_of_one_pass(spark):
    rng = np.random.default_rng(3)
    days = business_days(dt.date(2022, 1, 3), 150)
    rows = []
    for s in "ABCD":
        vols = np.exp(rng.normal(-1.5, 0.3, (150, 4)))
        for i, d in enumerate(days):
            if s == "D" and i > 90:
                continue
            rows.append((d, s, *map(float, vols[i, :3]), float(vols[i, 3])))
    config = HARConfig(forward_window=5, min_fit_rows=60)
    whole = spark.createDataFrame(rows, "date date, symbol string, rv_1 double, rv_5 double, rv_22 double, rv_fwd double").withColumn("in_fit", F.lit(True))
    closes = F.lead("date", 5).over(Window.partitionBy("symbol").orderBy("date"))
    whole = whole.withColumn("rv_fwd", F.when(closes.isNotNull(), F.col("rv_fwd")))

    def until(end):
        part = whole.where(F.col("date") <= F.lit(end))
        return part.withColumn("rv_fwd", F.when(closes.isNotNull(), F.col("rv_fwd")))

    stored = har_increments(until(days[70]), config)
    for end, after in ((days[101], days[70]), (days[-1], days[101])):
        stored = stored.unionByName(har_increments(until(end), config, after))
    got = fits_from_sums(stored, config).toPandas().sort_values("date")
    want = har_coefficients(har_rows(whole, config), config).toPandas().sort_values("date")
    assert len(want) > 3 and list(got["date"]) == list(want["date"]) and list(got["rows"]) == list(want["rows"])
    for c in ("const", "residual_var", "b_rv_1", "b_rv_5", "b_rv_22"):
        np.testing.assert_allclose(got[c], want[c], rtol=1e-8, atol=1e-10)


def test_factor_pairs_come_off_one_list_per_date(spark):
    rows = [(dt.date(2024, 1, d), f, float(d * i)) for d in (1, 2, 3) for i, f in enumerate("abc", 1) if (d, f) != (2, "b")]
    rows += [(dt.date(2024, 1, 3), "a", 10.0)]
    factors = spark.createDataFrame(rows, "date date, factor string, ret double")
    pairs = risk.factor_pairs(factors)
    assert "SortMergeJoin" not in plan_of(pairs)
    got = {(r.date.day, r.factor_1, r.factor_2): (r.ret_1, r.ret_2) for r in pairs.collect()}
    value = lambda d, f: 0.0 if (d, f) == (2, "b") else d * ("abc".index(f) + 1) + (10.0 if (d, f) == (3, "a") else 0.0)
    assert got == {(d, f, g): (value(d, f), value(d, g)) for d in (1, 2, 3) for f in "abc" for g in "abc" if f <= g}
    assert risk.factor_pairs(factors.limit(0)).count() == 0


def test_operators_run_nothing_while_a_plan_is_built(spark):
    day = dt.date(2024, 1, 2)
    frame = lambda ddl: spark.createDataFrame([], ddl)
    chain = spark.createDataFrame(flat_chain([day]))
    sessions = spark.createDataFrame([(day,)], "date date")
    panels = {name: frame(columns) for name, columns in PANELS.items()}
    sectors = frame("symbol string, sector string")
    changes = frame("effective_date date, ticker string, action string, security string, reason string")
    spark.sparkContext.setJobGroup("planning", "no job is to run")
    before = written_so_far()
    straddle.reference_path(chain, sessions)
    universe.build_universe(frame("ticker string"), changes, sessions)
    risk.rolling_loadings(panels["reference_returns"], frame("date date, factor string, ret double"), sectors)
    risk.rolling_covariances(frame("date date, factor string, ret double"))
    forecast.har_forecast(panels["realized_vol"], panels["realized_vol"])
    signals.vrp_signal(panels["surface"], panels["forecast"], panels["stock_features"], sectors)
    signals.momentum_signal(panels["reference_returns"])
    signals.iv_zscore_signal(panels["surface"])
    assert written_so_far() == before
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    spark.sparkContext.setJobGroup("", "")


def test_intermediates_are_released_one_by_one_or_together(spark):
    first, second, third = (materialize(spark.range(n)) for n in (1, 2, 3))
    before = written_so_far() - 2
    release(first)
    assert not Path(first._written_at.removeprefix("file:")).exists() and second.count() == 2
    release_scratch(spark, before - 1, but=third)
    assert not Path(second._written_at.removeprefix("file:")).exists() and third.count() == 3
    assert written_so_far() == before
    release(third)
    release(third)
    assert written_so_far() == before - 1
