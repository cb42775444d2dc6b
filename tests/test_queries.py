"""Registered queries beside their SQL, on the smallest tables."""

from pathlib import Path

import pytest
from oracle_check import compare, duck

import __spark_entry__ as entry
from tidemark.plans import catalog, oracles

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="no benchmark tables here")

# the rest runs through `python tests/oracle_check.py 0.01`
FAST = [
    "realized_vol",
    "stock_features",
    "surface",
    "straddle_path",
    "reprice_chain",
    "canonical_chain",
    "vega_scale",
    "open_interest",
    "universe",
    "universe_symbols",
    "tidy_prices",
    "symbology_check",
    "repaired_chain",
    "factor_loadings",
    "factor_covariances",
    "har_forecast",
    "signal_momentum",
    "store_pending",
]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_its_sql():
    assert set(catalog.queries()) == set(oracles.oracle_sql())
    assert set(catalog.queries()) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["date", "symbol", "rv_1", "rv_5", "rv_22", "rv_fwd"] and df.count() > 0


@pytest.mark.parametrize("name", FAST)
def test_query_agrees_with_its_sql(spark, con, name):
    ok, note = compare(spark, con, name, SF)
    assert ok, note
