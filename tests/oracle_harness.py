"""Run a registered Spark query and its DuckDB oracle side by side and compare.

Rows are compared order-insensitively after normalising values to text
(floats rounded to 6 digits), column names sorted - the same shape of check
the driver applies.
"""

from __future__ import annotations

import decimal
import math
import sys

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        return f"{round(v, 6):.6f}"
    if isinstance(v, decimal.Decimal):
        return f"{v:.8f}"
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return str(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows), sorted(cols)


def compare(spark, name: str, sf_dir: str, verbose: bool = True):
    import __spark_entry__ as E
    sdf = E.queries()[name](spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    sql = E.oracle_sql().get(name)
    if sql is None:
        return {"name": name, "rows": len(srows), "oracle": None, "match": None}
    con = duck(sf_dir)
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    s, sc = rows_of(scols, srows)
    d, dc = rows_of(dcols, drows)
    ok = s == d and sc == dc
    out = {"name": name, "rows": len(srows), "oracle_rows": len(drows), "cols_match": sc == dc, "match": ok}
    if not ok and verbose:
        print("spark cols", sc, "\nduck  cols", dc)
        ss, dd = set(s), set(d)
        print("only spark:", sorted(ss - dd)[:5])
        print("only duck :", sorted(dd - ss)[:5])
    return out


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from metricbook.session import local_session
    import __spark_entry__ as E
    sf = sys.argv[1]
    names = sys.argv[2:] or list(E.queries())
    spark = local_session()
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf)
        except Exception as e:  # report and continue
            r = {"name": n, "error": repr(e)[:400]}
        print(r, flush=True)
        bad += not r.get("match", False) and r.get("oracle", 1) is not None
    print("FAILED:", bad)
