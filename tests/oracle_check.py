"""Local stand-in for the driver's correctness gate.

Runs ``queries()[name]`` on Spark and ``oracle_sql()[name]`` on DuckDB over
the same parquet tables and compares row count, column names and an
order-insensitive hash of the values (columns sorted by name).

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from tessera.session import build_session  # noqa: E402
from tessera.tables import TABLES, table_path  # noqa: E402


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        if v == 0:
            v = 0.0
        return repr(round(v, 6))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def frame_hash(df: pd.DataFrame) -> str:
    cols = sorted(df.columns)
    rows = sorted("|".join(_norm(r[c]) for c in cols) for r in df[cols].to_dict("records"))
    return hashlib.sha256("\n".join(rows).encode()).hexdigest()


def to_records(df: pd.DataFrame) -> pd.DataFrame:
    out = df.astype(object).where(pd.notna(df), None)
    for c in out.columns:
        out[c] = [x.tolist() if hasattr(x, "tolist") and not isinstance(x, (int, float)) else x
                  for x in out[c]]
    return out


def run(sf_dir: str, names: list[str] | None = None) -> dict:
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    qs, sqls = entry.queries(), entry.oracle_sql()
    results = {}
    for name in names or list(qs):
        rec = {"has_oracle": name in sqls}
        try:
            t0 = time.time()
            sdf = qs[name](spark, sf_dir).toPandas()
            rec["spark_s"] = round(time.time() - t0, 2)
            rec["rows"] = len(sdf)
            if name in sqls:
                odf = con.execute(sqls[name]).df()
                rec["oracle_rows"] = len(odf)
                rec["cols_match"] = sorted(sdf.columns) == sorted(odf.columns)
                if not rec["cols_match"]:
                    rec["spark_cols"] = sorted(sdf.columns)
                    rec["oracle_cols"] = sorted(odf.columns)
                else:
                    hs, ho = frame_hash(to_records(sdf)), frame_hash(to_records(odf))
                    rec["hash_match"] = hs == ho
                    if hs != ho:
                        rec["diff"] = _diff(to_records(sdf), to_records(odf))
        except Exception as e:  # noqa: BLE001
            rec["error"] = f"{type(e).__name__}: {str(e)[:800]}"
        ok = rec.get("hash_match") or (not rec["has_oracle"] and "error" not in rec)
        rec["ok"] = bool(ok)
        results[name] = rec
        print(name, rec, flush=True)
    return results


def _diff(a: pd.DataFrame, b: pd.DataFrame, n: int = 3) -> dict:
    cols = sorted(a.columns)
    ra = sorted("|".join(_norm(r[c]) for c in cols) for r in a[cols].to_dict("records"))
    rb = sorted("|".join(_norm(r[c]) for c in cols) for r in b[cols].to_dict("records"))
    sa, sb = set(ra), set(rb)
    return {"cols": cols, "spark_only": [x[:300] for x in ra if x not in sb][:n],
            "oracle_only": [x[:300] for x in rb if x not in sa][:n]}


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    res = run(sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if not v["ok"]]
    print("SUMMARY", len(res) - len(bad), "ok of", len(res), "bad:", bad)
