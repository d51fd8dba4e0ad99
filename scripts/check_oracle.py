"""Run the registered queries beside their SQL twins and compare all rows.

usage: check_oracle.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
from tidemark.plans.catalog import ORACLE, QUERIES  # noqa: E402
from tidemark.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def canonical(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]

    def text(v):
        if v is None or (isinstance(v, float) and v != v) or v is pd.NaT:
            return "~"
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            return repr(float(v))
        if hasattr(v, "item"):
            return text(v.item())
        return str(v)

    return sorted(tuple(text(v) for v in row) for row in df.itertuples(index=False, name=None))


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    wanted = [n for n in QUERIES if not args[1:] or any(n.startswith(p) for p in args[1:])]
    spark = local_session("check", "8")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    bad = []
    for name in wanted:
        start = time.time()
        try:
            got = QUERIES[name](spark, sf_dir).toPandas()
        except Exception as exc:  # noqa: BLE001
            print(f"FAIL {name}: {type(exc).__name__} {str(exc)[:1500]}")
            bad.append(name)
            continue
        took = time.time() - start
        if name not in ORACLE:
            print(f"rows {name}: {len(got)} ({took:.1f}s) {list(got.columns)}")
            continue
        try:
            want = con.execute(ORACLE[name]).df()
        except Exception as exc:  # noqa: BLE001
            print(f"SQL  {name}: {str(exc)[:800]}")
            bad.append(name)
            continue
        if sorted(got.columns) != sorted(want.columns):
            print(f"COLS {name}: {sorted(got.columns)} != {sorted(want.columns)}")
            bad.append(name)
            continue
        a, b = canonical(got), canonical(want)
        if a == b:
            note = "" if len(a) else " EMPTY"
            kinds = [c for c in got.columns if str(got[c].dtype) != str(want[c].dtype)]
            print(f"ok   {name}: {len(a)} rows ({took:.1f}s){note}{' dtypes ' + str([(c, str(got[c].dtype), str(want[c].dtype)) for c in kinds]) if kinds else ''}")
        else:
            bad.append(name)
            sa, sb = set(a), set(b)
            print(f"DIFF {name}: {len(a)} vs {len(b)} rows, {sorted(got.columns)}")
            print("   spark only:", sorted(sa - sb)[:3])
            print("   sql only:  ", sorted(sb - sa)[:3])
    print(f"{len(wanted) - len(bad)}/{len(wanted)} fine; bad: {bad}")
    return bool(bad)


if __name__ == "__main__":
    sys.exit(main())
