"""Compare registered Spark queries with their DuckDB oracle SQL.

Usable from pytest and as a script:
    python tests/oracle_check.py /root/testdata/sf0.01 [name ...]
Rows are compared as multisets after sorting columns by name; doubles are
compared exactly (-0.0 equals 0.0) and, failing that, to 1e-9 relative.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return 0.0 if v == 0 else v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime) and v.tzinfo is not None:
        return v.astimezone(dt.timezone.utc).replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]


def duck_rows(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    data = cur.fetchall()
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], [tuple(_norm(row[i]) for i in order) for row in data]


def _close(a, b):
    if a == b:
        return True
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12)
    return False


def compare(spark, con, name, build, sql, sf_dir):
    t0 = time.time()
    df = build(spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    python_udf = any(op in plan for op in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython"))
    s_cols, s_rows = spark_rows(df)
    t1 = time.time()
    d_cols, d_rows = duck_rows(con, sql)
    res = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": s_cols == d_cols, "spark_sec": round(t1 - t0, 2),
           "python_udf": python_udf}
    if s_cols != d_cols:
        res["spark_cols"], res["oracle_cols"] = s_cols, d_cols
        res["exact"] = res["close"] = False
        return res
    cs, cd = Counter(s_rows), Counter(d_rows)
    res["exact"] = cs == cd
    if res["exact"]:
        res["close"] = True
        return res
    only_s = list((cs - cd).elements())
    only_d = list((cd - cs).elements())
    res["only_spark"], res["only_oracle"] = len(only_s), len(only_d)
    key = lambda r: tuple((x is None, str(x)) for x in r)
    only_s.sort(key=key)
    only_d.sort(key=key)
    res["close"] = len(only_s) == len(only_d) and all(
        all(_close(a, b) for a, b in zip(x, y)) for x, y in zip(only_s, only_d))
    res["sample_spark"] = only_s[:3]
    res["sample_oracle"] = only_d[:3]
    return res


def main(argv):
    import __spark_entry__ as entry
    from skyfold.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    if os.environ.get("PLAIN_SESSION"):
        # A session with Spark's defaults only, as a caller might bring.
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").getOrCreate()
    else:
        spark = build_session("local[8]")
    con = duck_connection(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            print(f"{name}: no oracle")
            continue
        try:
            res = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as exc:  # report and go on
            res = {"name": name, "error": f"{type(exc).__name__}: {str(exc)[:400]}"}
        ok = res.get("exact")
        bad += 0 if ok else 1
        print(("OK  " if ok else "BAD ") + str(res), flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
