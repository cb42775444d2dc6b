"""Run registered queries beside their SQL and compare: `python tests/oracle_check.py [sf] [name...]`."""

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402

from tidemark import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


SAME = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE"}


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    started = time.time()
    df = entry.queries()[name](spark, sf_dir)
    got = df.toArrow()
    spark_s = time.time() - started
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return True, f"{got.num_rows} rows, no SQL, spark {spark_s:.1f}s"
    started = time.time()
    want = con.sql(sql).to_arrow_table()
    duck_s = time.time() - started
    note = f"{got.num_rows} rows, spark {spark_s:.1f}s duckdb {duck_s:.1f}s"
    if sorted(got.column_names) != sorted(want.column_names):
        return False, f"columns {sorted(got.column_names)} != {sorted(want.column_names)}"
    con.register("got_raw", got)
    con.register("want_raw", want)
    types = dict(con.sql("SELECT column_name, column_type FROM (DESCRIBE want_raw)").fetchall())
    odd = [
        f"{f.name}: {f.dataType.simpleString()} vs {types[f.name]}"
        for f in df.schema
        if SAME.get(f.dataType.simpleString(), types[f.name]) != types[f.name]
    ]
    cols = ", ".join(
        f'"{c}"' if types[c] != "DOUBLE" else f'"{c}" + 0.0::DOUBLE AS "{c}"' for c in sorted(types)
    )
    extra = con.sql(f"SELECT {cols} FROM got_raw EXCEPT ALL SELECT {cols} FROM want_raw").fetchall()
    lost = con.sql(f"SELECT {cols} FROM want_raw EXCEPT ALL SELECT {cols} FROM got_raw").fetchall()
    if odd:
        note += f"; types differ: {odd}"
    if extra or lost:
        note += f"; {len(extra)} only in spark, {len(lost)} only in sql of {want.num_rows}"
        note += f"\n  {sorted(types)}"
        for side, rows in (("spark", extra), ("sql  ", lost)):
            for r in sorted(rows, key=str)[:4]:
                note += f"\n   {side} {tuple(str(x) if hasattr(x, 'year') else x for x in r)}"
    return not (odd or extra or lost), note


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    names = sys.argv[2:] or list(entry.queries())
    spark = build_session(
        master="local[8]",
        settings={
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.session.timeZone": "UTC",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = []
    for name in names:
        try:
            ok, note = compare(spark, con, name, sf_dir)
        except Exception as error:  # noqa: BLE001
            ok, note = False, f"{type(error).__name__}: {str(error)[:300]}"
        print("ok  " if ok else "BAD ", name, note, flush=True)
        if not ok:
            bad.append(name)
    print("bad:", bad)


if __name__ == "__main__":
    main()
