"""Compare registered queries with their SQL twins: ``python tests/oracle_check.py SF_DIR [KEY...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402


def duckdb_frame(sf_dir: str, sql: str) -> pd.DataFrame:
    with duckdb.connect() as connection:
        for path in Path(sf_dir).glob("*.parquet"):
            connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
        return connection.execute(sql).df()


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, rows by value, one representation per kind of value."""
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        column = frame[name]
        if pd.api.types.is_datetime64_any_dtype(column):
            frame[name] = column.astype("datetime64[us]")
        elif pd.api.types.is_integer_dtype(column):
            frame[name] = column.astype("float64" if column.isna().any() else "int64")
        elif column.dtype == object and column.map(type).astype(str).str.contains("date").any():
            frame[name] = pd.to_datetime(column).astype("datetime64[us]")
        elif pd.api.types.is_float_dtype(column):
            frame[name] = column.astype("float64")
    return frame.sort_values(list(frame.columns), na_position="last").reset_index(drop=True)


def compare(spark, sf_dir: str, key: str) -> str | None:
    """None when equal, else what differs."""
    got = canonical(contract.queries()[key](spark, sf_dir).toPandas())
    want = canonical(duckdb_frame(sf_dir, contract.oracle_sql()[key]))
    if list(got.columns) != list(want.columns):
        return f"columns {list(got.columns)} != {list(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for name in got.columns:
        same = (got[name] == want[name]) | (got[name].isna() & want[name].isna())
        if not same.all():
            row = same.idxmin()
            return f"{name}: {(~same).sum()} differ, first {got[name][row]!r} != {want[name][row]!r}"
    return None


def main(sf_dir: str, keys: list[str]) -> int:
    from ticklake.session import build_session

    spark = build_session(
        "oracle-check",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for key in keys or contract.queries():
        start = time.time()
        difference = compare(spark, sf_dir, key)
        bad += difference is not None
        print(f"{key:28s} {time.time() - start:6.2f}s {difference or 'ok'}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
