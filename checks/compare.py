"""Run queries against DuckDB: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import os
import sys
import tempfile
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def session(cores: str = "8") -> SparkSession:
    shared = os.environ.get("STOCKLENS_SHARED") or tempfile.mkdtemp(prefix="stocklens-")  # local runs only
    return (SparkSession.builder.master(f"local[{cores}]").appName("stocklens")
            .config("spark.sql.shuffle.partitions", cores).config("spark.ui.enabled", "false")
            .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC")
            .config("spark.ui.showConsoleProgress", "false").config("spark.checkpoint.dir", shared).getOrCreate())


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _sorted(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    return df.sort_values(list(df.columns), na_position="first").reset_index(drop=True)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str:
    """Empty when both frames hold the same rows, else what differs first."""
    if set(got.columns) != set(want.columns):
        return f"columns: only spark {set(got.columns) - set(want.columns)}, only sql {set(want.columns) - set(got.columns)}"
    if len(got) != len(want):
        return f"rows: spark {len(got)}, sql {len(want)}"
    got, want = _sorted(got), _sorted(want)
    for c in got.columns:
        a, b = got[c], want[c]
        bad = ~((a == b) | (a.isna() & b.isna()))
        if bad.any():
            i = bad[bad].index[0]
            return f"{c}: {int(bad.sum())} rows, first spark {a[i]!r}, sql {b[i]!r} at {got.loc[i].iloc[:12].to_dict()}"
    return ""


def main(argv: list[str]) -> int:
    from checks.oracle import ORACLE
    from checks.queries import QUERIES
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark, con = session(os.environ.get("BENCH_CPUS", "8")), duck(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    failed = []
    for name in names:
        t0 = time.time()
        try:
            got = QUERIES[name](spark, sf_dir).toPandas()
            t1 = time.time()
            want = con.execute(ORACLE[name]).df()
            diff = difference(got, want)
        except Exception as e:  # report and go on with the next query
            t1, diff = time.time(), f"{type(e).__name__}: {str(e)[:1500]}"
            got = ()
        print(f"{'ok  ' if not diff else 'FAIL'} {name} rows={len(got)} spark={t1 - t0:.1f}s sql={time.time() - t1:.1f}s {diff}",
              flush=True)
        if diff:
            failed.append(name)
    print(f"{len(names) - len(failed)} of {len(names)} match; failed: {failed}")
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
