"""Jump consistent hashing: stable keys to shards without a ring table.

`assign_shards` is a narrow projection (no shuffle): the key and the number of shards decide alone,
and one more shard only takes rows into itself. `with_slots` numbers the rows of each shard.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.names import private

#: Fixed values of the published algorithm: the generator's multiplier and its 31-bit divisor.
MULTIPLIER = 2862933555777941757
SPAN = float(1 << 31)

#: Rows of a shard are numbered in this many buckets, so no task sorts a whole shard.
SLOT_BUCKETS = 1024


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of every unsigned 64-bit key. The number of rounds is below `shards`."""
    if shards < 1:
        raise ValueError("there must be at least one shard")
    state = keys.astype(np.uint64)
    at = np.zeros(len(state), np.int64)
    last = np.zeros(len(state), np.int64)
    live = np.arange(len(state))
    while len(live):
        last[live] = at[live]
        with np.errstate(over="ignore"):
            state[live] = state[live] * np.uint64(MULTIPLIER) + np.uint64(1)
        step = SPAN / ((state[live] >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
        at[live] = ((last[live] + 1) * step).astype(np.int64)
        live = live[at[live] < shards]
    return last.astype(np.int32)


def stable_key(key: Column, data_type: str) -> Column:
    """A 64-bit key: integers as they are, other types by the hash of their text; null is key 0."""
    if data_type in ("tinyint", "smallint", "int", "bigint"):
        return F.coalesce(key.cast("bigint"), F.lit(0).cast("bigint"))
    return F.when(key.isNull(), F.lit(0).cast("bigint")).otherwise(F.xxhash64(key.cast("string")))


def assign_shards(
    df: DataFrame, key: str, shards: int, shard: str = "shard", grown: str | None = None
) -> DataFrame:
    """`df` with the column `shard` (0 to shards - 1), and `grown` for one more shard if named.

    Columns of those names are replaced. Repeated and null keys are rows like any other: equal keys
    meet in one shard, null keys in the shard of key 0. An empty table stays empty.
    """

    @F.pandas_udf("int")
    def shard_of(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy(np.int64).view(np.uint64), shards))

    @F.pandas_udf("int")
    def grown_of(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy(np.int64).view(np.uint64), shards + 1))

    hashed = stable_key(df[key], dict(df.dtypes)[key])
    columns = {shard: shard_of(hashed)} | ({grown: grown_of(hashed)} if grown else {})
    return df.withColumns(columns)


def with_slots(
    df: DataFrame,
    key: str,
    shard: str = "shard",
    slot: str = "slot",
    ties: tuple[str, ...] = (),
    buckets: int = SLOT_BUCKETS,
) -> DataFrame:
    """`df` with a number per shard, 0 upwards without gaps, in the order of (key mod `buckets`, key, ties).

    Each (shard, bucket) is numbered by itself and moved up by the rows of the buckets before it, so
    a task sorts one `buckets`-th of a shard and the table of offsets has shards * `buckets` rows.
    Rows that agree in key and ties get consecutive slots in any order. A column named like `slot` is replaced, all
    others stay; an empty table stays empty. `df` is read twice: pass a
    stored table.
    """
    own, row, moved = private(df, "_cell", "_row", "_before")
    names = [c for c in df.columns if c != slot]
    cell = F.pmod(stable_key(df[key], dict(df.dtypes)[key]), F.lit(buckets)).cast("int")
    dealt = df.withColumn(own, cell)
    before = Window.partitionBy(shard).orderBy(own).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy(shard, own)
        .agg(F.count("*").alias("_n"))
        .select(shard, own, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(moved))
    )
    inside = Window.partitionBy(shard, own).orderBy(*[F.asc_nulls_first(c) for c in (key, *ties)])
    return (
        dealt.withColumn(row, F.row_number().over(inside))
        .join(offsets, [shard, own])
        .select(*[F.col(f"`{c}`") for c in names], (F.col(moved) + F.col(row) - 1).alias(slot))
    )
