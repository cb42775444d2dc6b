import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions.columns import finite, ratio, winsorize
from tidemark.functions.frames import Stat, Trailing, leading, log_change, previous, rolled
from tidemark.functions import frames, groups
from tidemark.functions.groups import (
    attach_daily,
    broadcast_daily,
    by_count,
    by_day,
    by_fraction,
    by_letter,
    by_price,
    by_stamp,
    first_row,
    least_row,
)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def panel(spark, seed=0, n=60, names=("A", "B")):
    rng = np.random.default_rng(seed)
    rows = []
    for s in names:
        for i in range(n):
            x = None if rng.random() < 0.15 else float(rng.normal())
            rows.append((s, dt.date(2024, 1, 1) + dt.timedelta(days=i), x, float(rng.normal())))
    pdf = pd.DataFrame(rows, columns=["symbol", "date", "x", "y"])
    return pdf, spark.createDataFrame(rows, "symbol string, date date, x double, y double")


def test_trailing_statistics_match_pandas(spark):
    pdf, df = panel(spark)
    t = Trailing(10, 4)
    got = df.select(
        "symbol",
        "date",
        t.mean("x").alias("mean"),
        t.sum("x").alias("sum"),
        t.std("x").alias("std"),
        t.var("x").alias("var"),
        Trailing(10, 4, skip=3).sum("x").alias("late"),
        leading(5).mean("y").alias("ahead"),
        previous("y").alias("prev"),
    ).toPandas().sort_values(["symbol", "date"])
    g = pdf.sort_values(["symbol", "date"]).groupby("symbol")
    roll = lambda c, how: getattr(g[c].rolling(10, min_periods=4), how)().to_numpy()
    for name, how in (("mean", "mean"), ("sum", "sum"), ("std", "std"), ("var", "var")):
        np.testing.assert_allclose(got[name], roll("x", how), rtol=1e-9, atol=1e-12)
    late = g["x"].apply(lambda s: s.rolling(10, min_periods=4).sum().shift(3)).to_numpy()
    np.testing.assert_allclose(got["late"], late, rtol=1e-9, atol=1e-12)
    ahead = g["y"].apply(lambda s: s.rolling(5).mean().shift(-5)).to_numpy()
    np.testing.assert_allclose(got["ahead"], ahead, rtol=1e-9, atol=1e-12)
    np.testing.assert_allclose(got["prev"], g["y"].shift(1).to_numpy())


def test_trailing_beta_matches_pandas_and_a_flat_market_gives_null(spark):
    pdf, df = panel(spark, 1)
    pdf["x"] = pdf["x"].fillna(0.0)
    df = df.fillna(0.0, ["x"])
    got = df.select(
        "symbol", "date", Trailing(12).beta("x", "y").alias("b"),
        Trailing(12).beta("x", F.lit(1.0)).alias("flat"),
    ).toPandas().sort_values(["symbol", "date"])
    want = []
    for _, s in pdf.sort_values(["symbol", "date"]).groupby("symbol"):
        want.append((s["x"].rolling(12).cov(s["y"]) / s["y"].rolling(12).var()).to_numpy())
    np.testing.assert_allclose(got["b"], np.concatenate(want), rtol=1e-8)
    assert got["flat"].isna().all()


def test_log_change_and_scalar_guards(spark):
    df = spark.createDataFrame(
        [("A", 1, 2.0), ("A", 2, 4.0), ("A", 3, float("nan"))], "symbol string, date int, x double"
    )
    rows = df.select("date", log_change("x").alias("l")).orderBy("date").collect()
    assert rows[0].l is None and abs(rows[1].l - np.log(2)) < 1e-12
    one = df.select(
        winsorize(F.col("x"), 3.0).alias("w"), finite("x").alias("f"), ratio(F.col("x"), F.lit(0.0)).alias("r")
    ).collect()
    assert [r.w for r in one[:2]] == [2.0, 3.0] and np.isnan(one[2].w)
    assert [r.f for r in one] == [True, True, False]
    assert all(r.r is None for r in one)


def test_first_row_does_not_depend_on_row_order(spark):
    rows = [("a", 2.0, 1.0, "x"), ("a", 1.0, 9.0, "y"), ("a", 1.0, 3.0, "z"), ("b", 5.0, 5.0, "w")]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "k string, d double, s double, v string")
        got = least_row(df, ["k"], [F.col("d"), F.col("s")], ["v"]).collect()
        assert {(r.k, r.v) for r in got} == {("a", "z"), ("b", "w")}


def test_packed_orders_pick_the_row_that_sorting_picks(spark):
    drawn = random.Random(7)
    rows = []
    for i in range(900):
        rows.append((
            f"k{drawn.randrange(40)}", drawn.choice([None, 0.0, 0.25, 0.5 - 2**-30, abs(drawn.uniform(0.25, 0.75) - 0.5)]),
            drawn.choice([None, 95.0, 97.5, 100.001, 100.002]), dt.date(1999 + drawn.randrange(3), 2, 28),
            dt.datetime(2024, 1, drawn.randint(1, 3), drawn.randrange(24), 0, 0, drawn.randrange(3)), drawn.choice("CP"), i,
        ))
    df = spark.createDataFrame(rows, "k string, x double, p double, d date, t timestamp_ntz, r string, v int")
    orders = {
        "x p": [by_fraction(F.col("x")), by_price("p")],
        "p r v": [by_price("p"), by_letter("r"), by_count("v", 20)],
        "d t": [by_day("d"), by_stamp("t", "timestamp_ntz")],
        "-t -v": [groups.last(by_stamp("t", "timestamp_ntz")), groups.last(by_count("v", 31))],
        "v": [by_count("v", 20)],
    }
    place = {c: i for i, c in enumerate(df.columns)}
    for spec, order in orders.items():

        def rank(row, names=tuple(spec.split())):
            out = []
            for name in names:
                value = row[place[name.strip("-")]]
                if name[0] == "-":
                    value = None if value is None else -(value if isinstance(value, int) else (value - dt.datetime(1970, 1, 1)).total_seconds())
                    out.append((value is None, value or 0))
                else:
                    out.append((value is not None, value if value is not None else 0))
            return tuple(out)

        least = {}
        for row in rows:
            least.setdefault(row[0], []).append(rank(row))
        fixed = ["x", "p", "d", "t", "v"]
        got = first_row(df, ["k"], order, fixed)
        assert plan_of(got).count("SortAggregate") == 0 and "HashAggregate" in plan_of(got)
        found = {r["k"]: r for r in got.collect()}
        assert {k: min(v) for k, v in least.items()} == {k: rank(rows[r["v"]]) for k, r in found.items()}
        again = {r["k"]: r for r in first_row(df.repartition(7), ["k"], order, fixed).collect()}
        assert again == found and all(tuple(r[c] for c in fixed) == tuple(rows[r["v"]][place[c]] for c in fixed) for r in found.values())
    with pytest.raises(ValueError, match="too wide"):
        groups.order_number([by_count("v", 62)] * 3, [])


def test_daily_statistics_are_broadcast_and_refuse_unbounded_keys(spark):
    pdf, df = panel(spark, 2)
    out = attach_daily(df, F.avg("y").alias("m"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Window" not in plan
    got = out.toPandas()
    want = pdf.groupby("date")["y"].mean()
    np.testing.assert_allclose(got["m"], got["date"].map(want))
    with pytest.raises(TypeError):
        broadcast_daily(df.groupBy("symbol").count(), "symbol")


STATS = {
    "mean": Stat("mean", "x"), "sum": Stat("sum", "x"), "std": Stat("std", "x"), "var": Stat("var", "y"),
    "cov": Stat("cov", "x", "y"), "beta": Stat("beta", "y", "x"), "n": Stat("count", "x"),
}


@pytest.mark.parametrize(("rows", "floor", "skip"), [(25, 5, 0), (30, None, 0), (40, 3, 7), (100, 10, 0), (25, None, -25)])
def test_frames_by_blocks_are_those_added_up_row_by_row(spark, monkeypatch, rows, floor, skip):
    monkeypatch.setattr(frames, "SHORT", 0)
    _, df = panel(spark, 3, 137)
    trail = Trailing(rows, floor, skip=skip)
    got = rolled(df, trail, **STATS).toPandas().sort_values(["symbol", "date"])
    want = df.select("*", *[s.plain(trail).alias(n) for n, s in STATS.items()]).toPandas().sort_values(["symbol", "date"])
    assert list(got.columns) == [*df.columns, *STATS]
    for name in STATS:
        if name == "n" and skip:
            continue
        np.testing.assert_allclose(got[name], want[name], rtol=1e-9, atol=1e-12)
    if skip < 0:
        with pytest.raises(ValueError, match="full"):
            rolled(df, Trailing(rows, 3, skip=skip), **STATS)


def test_an_outlier_counts_while_it_is_in_the_frame_and_no_longer(spark, monkeypatch):
    monkeypatch.setattr(frames, "SHORT", 0)
    rng = np.random.default_rng(1)
    n, window = 400, 50
    x = 5.0 + rng.normal(0, 1e-3, n)
    x[20], x[200] = 1e8, float("inf")
    rows = [("A", dt.date(2020, 1, 1) + dt.timedelta(days=i), float(v), float(-v)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "symbol string, date date, x double, y double")
    got = rolled(df, Trailing(window), **STATS).orderBy("date").toPandas()
    with np.errstate(invalid="ignore"):
        for i in range(window - 1, n):
            part = x[i - window + 1 : i + 1]
            if np.isinf(part).any():
                assert not np.isfinite(got["var"][i])
                continue
            assert got["var"][i] == pytest.approx(part.var(ddof=1), rel=1e-6)
            assert got["std"][i] == pytest.approx(part.std(ddof=1), rel=1e-6)
            assert got["mean"][i] == pytest.approx(part.mean(), rel=1e-12)
            assert got["cov"][i] == pytest.approx(-part.var(ddof=1), rel=1e-6)
            assert got["beta"][i] == pytest.approx(-1.0, rel=1e-6)
    assert got["std"][300] < 2e-3 and got["std"][120] < 2e-3


def test_frames_by_blocks_cost_one_exchange(spark):
    _, df = panel(spark, 4)
    trail = Trailing(90)
    plan = plan_of(rolled(rolled(df.repartition(4, "symbol"), trail, a=Stat("std", "x")), trail, b=Stat("mean", "a")))
    assert plan.count("Exchange") == 1
