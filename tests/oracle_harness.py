"""Run registered plans against their DuckDB oracles, as the driver does.

    python tests/oracle_harness.py [name ...] [--sf DIR]

Per plan: row count, column names, column types and an order-insensitive
comparison of all values (rows sorted after columns are sorted by name).
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck_connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _kind(dtype) -> str:
    s = str(dtype).lower()
    if "int" in s:
        return "int"
    if "float" in s or "double" in s:
        return "float"
    if "bool" in s:
        return "bool"
    if s == "object":
        return "other"
    if "datetime" in s or "timestamp" in s:
        return "time"
    return "other"


def _norm_value(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float) or isinstance(v, np.floating):
        if math.isnan(v):
            return None
        return float(v)
    if isinstance(v, (np.integer,)):
        return int(v)
    if isinstance(v, (np.bool_,)):
        return bool(v)
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(_norm_value(x) for x in v)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    return v


def _rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm_value(v) for v in rec))
    key = lambda r: tuple((0, "") if x is None else (1, repr(x)) for x in r)
    return sorted(out, key=key)


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> dict:
    res = {"rows_spark": len(spark_pdf), "rows_oracle": len(duck_pdf)}
    res["names_match"] = sorted(spark_pdf.columns) == sorted(duck_pdf.columns)
    if not res["names_match"]:
        res["names"] = (sorted(spark_pdf.columns), sorted(duck_pdf.columns))
        res["ok"] = False
        return res
    kinds = {c: (_kind(spark_pdf[c].dtype), _kind(duck_pdf[c].dtype)) for c in spark_pdf.columns}
    # object columns (nullable booleans from Spark) are checked by value only, and
    # integers with nulls come out of pandas as floats
    nulls = {c for c in kinds if spark_pdf[c].isna().any()}
    res["type_diffs"] = {c: k for c, k in kinds.items() if k[0] != k[1] and "other" not in k and len(spark_pdf) and len(duck_pdf)
                         and not (c in nulls and set(k) == {"int", "float"})}
    a, b = _rows(spark_pdf), _rows(duck_pdf)
    res["rows_match"] = len(a) == len(b)
    exact = a == b
    res["values_exact"] = exact
    if not exact and len(a) == len(b):
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        res["n_diff_rows"] = len(bad)
        res["first_diff"] = bad[:3]
    res["ok"] = res["rows_match"] and exact and not res["type_diffs"]
    return res


def run(names: list[str] | None, sf_dir: str, verbose: bool = True, vanilla: bool = False) -> dict:
    import __spark_entry__ as entry
    from sitelens.session import get_session

    if vanilla:   # a plain session with Spark's defaults, as a driver might make
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = get_session("local[8]", shuffle_partitions=8)
    qs, oracles = entry.queries(), entry.oracle_sql()
    con = duck_connect(sf_dir)
    results = {}
    for name in (names or list(qs)):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            spdf = sdf.toPandas()
            t1 = time.time()
            if name not in oracles:
                results[name] = {"ok": None, "rows_spark": len(spdf), "note": "no oracle",
                                 "spark_s": round(t1 - t0, 2)}
            else:
                dpdf = con.execute(oracles[name]).df()
                r = compare(spdf, dpdf)
                r["spark_s"] = round(t1 - t0, 2)
                r["oracle_s"] = round(time.time() - t1, 2)
                results[name] = r
        except Exception as e:  # report and go on
            results[name] = {"ok": False, "error": f"{type(e).__name__}: {str(e)[:800]}"}
        if verbose:
            print(name, results[name], flush=True)
    return results


if __name__ == "__main__":
    ap = argparse.ArgumentParser()
    ap.add_argument("names", nargs="*")
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--vanilla", action="store_true", help="use a plain session with Spark defaults")
    args = ap.parse_args()
    t0 = time.time()
    res = run(args.names or None, args.sf, vanilla=args.vanilla)
    print(f"TOTAL {time.time() - t0:.1f} s")
    bad = [n for n, r in res.items() if r.get("ok") is False]
    print("SUMMARY ok=%d no_oracle=%d bad=%d %s" % (
        sum(1 for r in res.values() if r.get("ok")), sum(1 for r in res.values() if r.get("ok") is None),
        len(bad), bad))
