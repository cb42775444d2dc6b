"""Panels laid out by key, so that joins of them move nothing.

Every panel meets the others on (symbol, date). Written in the same number of buckets of these keys, sorted inside,
two panels are joined bucket by bucket: the reader knows the layout and plans no exchange.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

PANEL_KEYS = ("symbol", "date")
BUCKETS = 64


def _table(path: str, n: int) -> str:
    return f"tidemark_{hashlib.sha256(f'{path} {n}'.encode()).hexdigest()[:24]}"


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str] = PANEL_KEYS, buckets: int = BUCKETS) -> None:
    """Write `df` to `path` in `buckets` files, one per bucket of the keys' hash, replacing what is there.

    The rows are dealt by the same hash first, so each task writes one bucket; the keys must tell rows apart well
    enough (a symbol-day does), for a bucket is one task of every later join.
    """
    spark, name = df.sparkSession, _table(path, buckets)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    (
        df.repartition(buckets, *keys)
        .write.mode("overwrite")
        .format("parquet")
        .option("path", path)
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .saveAsTable(name)
    )


def read_bucketed(spark: SparkSession, path: str, keys: Sequence[str] = PANEL_KEYS, buckets: int = BUCKETS) -> DataFrame:
    """The panel at `path` with its layout known to the planner, in this session or a later one."""
    name = _table(path, buckets)
    if not spark.catalog.tableExists(name):
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
        by = ", ".join(keys)
        spark.sql(
            f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
    return spark.table(name)


def join_panels(left: DataFrame, right: DataFrame, keys: Sequence[str] = PANEL_KEYS, how: str = "inner") -> DataFrame:
    """Join two bucketed panels bucket by bucket, each side in the order it was written in."""
    return left.join(right.hint("merge"), list(keys), how)
