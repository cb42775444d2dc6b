"""Session settings the operators are written for, and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

MARKET_ZONE = "America/New_York"

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": MARKET_ZONE,
}


def build_session(
    app: str = "tidemark", master: str | None = None, settings: dict[str, str] | None = None
) -> SparkSession:
    """A session with the settings above; `settings` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; where none is named, a folder of the warehouse, which is shared too."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of rows that go to a Python worker at once.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """From now on at most about `most` bytes of rows make an Arrow batch of this session; results stay what they are.

    An executor holds a batch in Arrow's buffers and once more as the stream it sends, both outside the heap and
    doubled while they grow, for each task: with Spark's own 64 MB that is several hundred MB. A smaller
    size that the session names stays.
    """
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_BATCH)) > most:
        spark.conf.set(_BATCH, f"{most}b")


def materialize(df: DataFrame) -> DataFrame:
    """Write `df` to the shared scratch folder and read it back.

    Used where one frame feeds several branches of a plan. Unlike a cache it survives
    the loss of executors, and unlike an RDD checkpoint it keeps column pruning and
    gives the optimizer a true size, so small results are broadcast and large ones
    are not.
    """
    return _written_back(df, {})


def materialize_long_rows(df: DataFrame, rows_at_once: int) -> DataFrame:
    """`materialize` for rows of some hundred kB: so many make a row group, and a reader holds one row group at a time."""
    return _written_back(df, {"parquet.block.row.count.limit": rows_at_once})


def _written_back(df: DataFrame, options: dict[str, int]) -> DataFrame:
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/tidemark-{uuid.uuid4().hex}"
    _written.append(path)
    df.write.options(**options).parquet(path)
    read = spark.read.schema(df.schema).parquet(path)
    read._written_at = path
    return read


#: What an operator does with a frame that feeds several branches of its plan.
Keep = Callable[[DataFrame], DataFrame]


def as_planned(df: DataFrame) -> DataFrame:
    """The default of operators: nothing is run or written while a plan is built, branches share what Spark lets them.

    Plans pass `materialize` instead, which runs and writes each shared frame once.
    """
    return df


_written: list[str] = []


def written_so_far() -> int:
    """How many intermediates this process has written and not released."""
    return len(_written)


def release_scratch(spark: SparkSession, since: int = 0, but: DataFrame | None = None) -> None:
    """Delete what `materialize` wrote in this process after the first `since`; frames built on it are done with.

    The intermediate `but` itself stays.
    """
    left = [p for p in _written[since:] if p == getattr(but, "_written_at", None)]
    gone = [p for p in _written[since:] if p not in left]
    _written[since:] = left
    for path in gone:
        _delete(spark, path)


def release(*frames: DataFrame) -> None:
    """Delete what `materialize` wrote for these very frames; frames built on them are done with, others stay."""
    for df in frames:
        path = getattr(df, "_written_at", None)
        if path in _written:
            _written.remove(path)
            _delete(df.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
