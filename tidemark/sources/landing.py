"""Readers for landed files: a flat table in several files, and one file per symbol and year."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

# The columns of each landed vendor table.
LANDED: dict[str, str] = {
    "chain": (
        "symbol string, expiration string, strike double, right string, bid double, ask double,"
        " volume long, delta double, gamma double, theta double, vega double, implied_vol double,"
        " iv_error double, underlying_timestamp timestamp, timestamp timestamp,"
        " underlying_price double, rho double, epsilon double, lambda double, vanna double,"
        " charm double, vomma double, veta double, vera double, speed double, zomma double,"
        " color double, ultima double, d1 double, d2 double, dual_delta double, dual_gamma double,"
        " open double, high double, low double, close double, count long, bid_size long,"
        " bid_exchange long, bid_condition long, ask_size long, ask_exchange long,"
        " ask_condition long"
    ),
    "open_interest": (
        "timestamp timestamp, symbol string, expiration string, strike double, right string,"
        " open_interest long"
    ),
    "stock": (
        "created timestamp, last_trade timestamp, symbol string, open double, high double,"
        " low double, close double, volume long, count long, bid double, ask double,"
        " bid_size long, bid_exchange long, bid_condition long, ask_size long, ask_exchange long,"
        " ask_condition long"
    ),
    "index": (
        "created timestamp, symbol string, open double, high double, low double, close double"
    ),
    "rates": "created string, symbol string, rate double",
    "yields": "date string, ticker string, close double",
    "quotes": "yahoo_symbol string, date date, yahoo_close double, dividend double, split double",
    "earnings": (
        "symbol string, announced_at timestamp, eps_estimate double, reported_eps double,"
        " surprise_pct double"
    ),
    "constituents": "`Symbol` string, `GICS Sector` string, `GICS Sub-Industry` string",
    "changes": (
        "effective_date string, added_ticker string, added_security string,"
        " removed_ticker string, removed_security string, reason string"
    ),
    "closures": "date string, type string",
}


def read_vendor(
    spark: SparkSession, kind: str, paths: Sequence[str], fmt: str = "parquet"
) -> DataFrame:
    """Landed files of a vendor table under its own schema; other columns are not read."""
    return read_landed(spark, paths, T.StructType.fromDDL(LANDED[kind]), fmt)


# Fixed value: the year of a chain directory whose name carries none.
SAMPLE_YEAR = 2025


def relaxed_union(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames by column name; absent columns are null, types widen to a common one.

    Integers widen to long and mixed numbers to double; a column that is null throughout takes the other's type.
    Types of unlike families (a date beside a stamp, text beside a number) are refused with a TypeError.
    Frames of one layout are scanned side by side, so a union of many files has a branch per layout.
    """
    seen: dict[str, set[str]] = {}
    for df in frames:
        for name, dtype in df.dtypes:
            seen.setdefault(name, set()).add(dtype)

    def common(name: str) -> str | None:
        types = seen[name] - {"void"}
        if len(types) <= 1:
            return next(iter(types), None)
        whole = {"tinyint", "smallint", "int", "bigint"}
        if types <= whole:
            return "bigint"
        if all(t in whole | {"float", "double"} or t.startswith("decimal") for t in types):
            return "double"
        raise TypeError(f"column {name} is {' in one place and '.join(sorted(types))} in another")

    wide = {name: common(name) for name in seen}
    out: DataFrame | None = None
    for df in frames:
        same = df.select(
            *[
                F.col(f"`{c}`").cast(wide[c]).alias(c) if wide[c] and wide[c] != kind else F.col(f"`{c}`")
                for c, kind in df.dtypes
            ]
        )
        out = same if out is None else out.unionByName(same, allowMissingColumns=True)
    if out is None:
        raise ValueError("nothing to union")
    return out


def read_landed(
    spark: SparkSession,
    paths: Sequence[str],
    schema: T.StructType | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Landed files of one table as one frame. CSV needs a schema; Parquet files may differ."""
    if fmt != "parquet":
        if schema is None:
            raise ValueError(f"{fmt} files need a schema")
        return spark.read.schema(schema).option("header", True).format(fmt).load(list(paths))
    if schema is not None:
        return spark.read.schema(schema).parquet(*paths)
    return relaxed_union([spark.read.schema(layout).parquet(*found) for layout, found in layouts(spark, paths)])


def layouts(spark: SparkSession, paths: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """The paths by their columns and types, in the order in which each layout first appears.

    Footers are read in tasks, one file of each path (a path is a file, or a folder of files written at once).
    """
    jobs = min(len(paths), 64)

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path in batch.column(1).to_pylist():
                files, base = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
                if files.get_file_info(base).type == fs.FileType.Directory:
                    base = min(x.path for x in files.get_file_info(fs.FileSelector(base, recursive=True)) if x.path.endswith(".parquet"))
                with files.open_input_file(base) as file:
                    meta = pq.ParquetFile(file)
                    own = (meta.schema_arrow.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
                    said = own or (meta.metadata.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
                    found.append(said.decode() if said else from_arrow_schema(meta.schema_arrow).json())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["at", "layout"])

    asked = spark.createDataFrame(list(enumerate(paths)), "at int, path string").repartition(jobs)
    rows = asked.mapInArrow(footers, "at int, layout string").groupBy("layout").agg(F.sort_array(F.collect_list("at")).alias("at")).collect()
    found = sorted(rows, key=lambda r: r["at"][0])
    return [(T.StructType.fromJson(json.loads(r["layout"])), [paths[i] for i in r["at"]]) for r in found]


def read_chain_files(
    spark: SparkSession,
    source: str,
    prefix: str,
    schema: T.StructType | None = None,
    arrival: str | None = None,
) -> DataFrame:
    """Every `<source>/<prefix>[_<year>]/<symbol>.parquet` in one scan.

    `symbol` comes from the file's stem and `year` from its directory; one without a year
    is the sample year. Directories that match neither form are left out. Under `schema`, a column
    that a file lacks is null; without one, the first file's columns are read. `arrival`
    names a column for a row's place in its file.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    files = reader.option("pathGlobFilter", "*.parquet").parquet(f"{source}/{prefix}*/")
    path = F.col("_metadata.file_path")
    year = F.regexp_extract(path, rf"/{prefix}_(\d+)/[^/]+$", 1)
    plain = path.rlike(rf"/{prefix}/[^/]+$")
    stem = F.url_decode(F.regexp_extract(path, r"/([^/]+)\.parquet$", 1))
    return (
        files.withColumns(
            {
                "_year": F.when(year != "", F.try_to_number(year, F.lit("9999")).cast("int")).when(
                    plain, F.lit(SAMPLE_YEAR)
                ),
                "_symbol": stem,
                **({arrival: F.col("_metadata.row_index")} if arrival else {}),
            }
        )
        .where(F.col("_year").isNotNull())
        .drop("symbol", "year")
        .withColumnsRenamed({"_year": "year", "_symbol": "symbol"})
    )
