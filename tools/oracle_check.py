"""Run registered queries on Spark and their oracle SQL on DuckDB; compare.

Usage: python tools/oracle_check.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import hashlib
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

from opsledger.plans import registry  # noqa: E402
from opsledger.session import local_session  # noqa: E402
from opsledger.sources.tables import DRIVER_TABLES  # noqa: E402


def norm(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if str(df[c].dtype).startswith("datetime"):
            df[c] = df[c].astype("datetime64[us]")
        elif pd.api.types.is_numeric_dtype(df[c]) and not pd.api.types.is_bool_dtype(df[c]):
            df[c] = df[c].astype("float64")
    out = df.astype(str).replace({"NaT": "None", "nan": "None", "<NA>": "None"})
    return out.sort_values(list(out.columns)).reset_index(drop=True)


def digest(df: pd.DataFrame) -> str:
    return hashlib.sha256(pd.util.hash_pandas_object(df, index=False).values.tobytes()).hexdigest()[:12]


def main() -> None:
    args = sys.argv[1:]
    folder = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    pats = [a for a in args if a != folder]
    registry.load_all()
    spark = local_session(8)
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    bad = 0
    for name, fn in registry.QUERIES.items():
        if pats and not any(p in name for p in pats):
            continue
        t0 = time.time()
        sp = fn(spark, folder).toPandas()
        t1 = time.time()
        sql = registry.ORACLE.get(name)
        if sql is None:
            print(f"{name:40s} spark rows={len(sp):7d} ({t1 - t0:.1f}s) no oracle")
            continue
        try:
            dk = con.execute(sql).df()
        except Exception as e:  # noqa: BLE001
            print(f"{name:40s} ORACLE ERROR {e}")
            bad += 1
            continue
        a, b = norm(sp), norm(dk)
        ok = list(a.columns) == list(b.columns) and len(a) == len(b) and a.equals(b)
        if not ok:
            bad += 1
            print(f"{name:40s} MISMATCH spark={len(a)} oracle={len(b)}")
            if list(a.columns) != list(b.columns):
                print("   cols spark-only", set(a.columns) - set(b.columns), "oracle-only", set(b.columns) - set(a.columns))
            elif len(a) == len(b):
                for c in a.columns:
                    diff = (a[c] != b[c])
                    if diff.any():
                        i = diff.idxmax()
                        print(f"   {c}: {diff.sum()} diffs e.g. spark={a[c][i]!r} oracle={b[c][i]!r}")
        else:
            print(f"{name:40s} OK rows={len(a):7d} spark {t1 - t0:.1f}s hash={digest(a)}")
    print("mismatches:", bad)


if __name__ == "__main__":
    main()
