"""Compare registered Spark queries with their DuckDB oracle SQL.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query: rows, schema and value agreement.
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

from lanewatch.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def normalise(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        s = df[c]
        if s.dtype.kind == "f":
            df[c] = s.round(6)
        else:
            df[c] = s.map(lambda v: None if v is None or (isinstance(v, float) and np.isnan(v)) else
                          (str(list(v)) if isinstance(v, (list, np.ndarray)) else str(v)))
    return df.sort_values(list(df.columns), na_position="first").reset_index(drop=True)


def compare(a: pd.DataFrame, b: pd.DataFrame) -> tuple[bool, str]:
    if len(a) != len(b):
        return False, f"rows {len(a)} vs {len(b)}"
    if sorted(a.columns) != sorted(b.columns):
        return False, f"cols {sorted(set(a.columns) ^ set(b.columns))}"
    na, nb = normalise(a), normalise(b)
    bad = []
    for c in na.columns:
        x, y = na[c], nb[c]
        if x.dtype.kind == "f" or y.dtype.kind == "f":
            xv = pd.to_numeric(x, errors="coerce").to_numpy(dtype=float)
            yv = pd.to_numeric(y, errors="coerce").to_numpy(dtype=float)
            ok = np.isclose(xv, yv, atol=1e-6, equal_nan=True)
        else:
            ok = (x.fillna("<NA>").astype(str).to_numpy() == y.fillna("<NA>").astype(str).to_numpy())
        if not ok.all():
            i = int(np.argmin(ok))
            bad.append(f"{c}[{i}]: {x.iloc[i]!r} vs {y.iloc[i]!r} ({int((~ok).sum())} diffs)")
    return (not bad), "; ".join(bad[:4])


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    import __spark_entry__ as E
    from lanewatch.session import get_session
    spark = get_session(os.environ.get("ORACLE_MASTER", "local[8]"), shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    for name in names or list(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            a = sdf.toPandas()
            ts = time.time() - t0
            if name not in sqls:
                print(f"{name:34s} rows={len(a):6d} spark={ts:6.2f}s  (no oracle)")
                continue
            b = con.execute(sqls[name]).df()
            ok, msg = compare(a, b)
            print(f"{name:34s} rows={len(a):6d} spark={ts:6.2f}s  {'OK ' if ok else 'BAD'} {msg}")
        except Exception as e:  # report and continue
            print(f"{name:34s} ERROR {type(e).__name__}: {str(e)[:300]}")


if __name__ == "__main__":
    main()
