"""Run the queries next to their SQL forms: ``python -m catalog.compare DIR [NAME ...]``."""

from __future__ import annotations

import sys
import time

import numpy as np
import pandas as pd


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    """Rows in a fixed order, columns by name, floats and integers as they are."""
    out = pd.DataFrame({c: df[c].to_numpy() for c in sorted(df.columns)})
    return out.sort_values(list(out.columns), na_position="last", kind="stable").reset_index(drop=True)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """None if equal, else what differs first."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = canonical(got), canonical(want)
    for c in a.columns:
        x, y = a[c].to_numpy(), b[c].to_numpy()
        if x.dtype.kind in "fiub" and y.dtype.kind in "fiub":
            bad = ~((x == y) | ((x != x) & (y != y)))
        else:
            bad = np.array([not (p == q or (p is None and q is None)) for p, q in zip(x, y)], dtype=bool)
        if bad.any():
            i = int(np.argmax(bad))
            return f"{c}: {bad.sum()} of {len(bad)} differ, first {x[i]!r} != {y[i]!r}"
    return None


def connect(sf_dir: str):
    import glob
    import os

    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def main(argv: list[str]) -> int:
    from catalog.oracles import ORACLES
    from catalog.queries import QUERIES
    from gridloom.session import local_session

    sf_dir, names = argv[0], argv[1:] or list(QUERIES)
    spark, con = local_session(), connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            got = QUERIES[name](spark, sf_dir).toPandas()
            spent = time.time() - start
            start = time.time()
            message = difference(got, con.execute(ORACLES[name]).df()) if name in ORACLES else "no SQL form"
        except Exception as e:  # report and go on with the next query
            message, got, spent = f"{type(e).__name__}: {str(e)[:1200]}", [], time.time() - start
        failed += message is not None
        print(f"{'ok  ' if message is None else 'FAIL'} {name} rows={len(got)} spark={spent:.1f}s sql={time.time() - start:.1f}s {message or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} equal")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
