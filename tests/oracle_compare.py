"""Side-by-side check of every registered query against its DuckDB oracle SQL.

Usable from pytest (``tests/test_oracle.py``) and as a script:
``python tests/oracle_compare.py [sf_dir] [name ...]``.
Columns are compared sorted by name; rows as an order-insensitive multiset.  Values
are compared exactly (``exact``) and with floats rounded to 9 significant digits.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import tempfile
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from landframe.plans.tables import TABLES  # noqa: E402


def _norm(v, approx: bool):
    if v is None:
        return None
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return float(f"{v:.9g}") if approx else v
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, approx) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, approx)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict(), approx)
    return v


def _rows(names, rows, approx):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_norm(r[i], approx) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), str(x)) for x in t))


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


_SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "smallint": "SMALLINT", "tinyint": "TINYINT",
                  "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR", "boolean": "BOOLEAN",
                  "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE"}


def spark_type_name(t: str) -> str:
    if t.startswith("decimal"):
        return t.upper().replace(" ", "")
    if t.startswith("array<"):
        return spark_type_name(t[6:-1]) + "[]"
    return _SPARK_TO_DUCK.get(t, t.upper())


def type_mismatches(sdf, rel) -> list:
    s_types = {f.name: spark_type_name(f.dataType.simpleString()) for f in sdf.schema.fields}
    o_types = {n: str(t).upper().replace(" ", "") if str(t).upper().startswith("DECIMAL") else str(t).upper()
               for n, t in zip(rel.columns, rel.types)}
    return [(n, s_types[n], o_types.get(n)) for n in sorted(s_types) if s_types[n] != o_types.get(n)]


def compare_one(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_names = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "no-oracle"
        return res
    con.execute(f"CREATE OR REPLACE VIEW oracle_view AS {sql}")  # as the driver stores it
    rel = con.sql("SELECT * FROM oracle_view")
    o_names = list(rel.columns)
    o_rows = rel.fetchall()
    res["oracle_rows"] = len(o_rows)
    if sorted(s_names) != sorted(o_names):
        res["status"] = f"COLUMNS spark={sorted(s_names)} oracle={sorted(o_names)}"
        return res
    res["type_diffs"] = type_mismatches(sdf, rel)
    exact = _rows(s_names, s_rows, False) == _rows(o_names, o_rows, False)
    approx = exact or _rows(s_names, s_rows, True) == _rows(o_names, o_rows, True)
    res["status"] = "exact" if exact else ("approx" if approx else "MISMATCH")
    if not approx:
        a, b = _rows(s_names, s_rows, True), _rows(o_names, o_rows, True)
        sa, sb = set(a), set(b)
        res["only_spark"] = [x for x in a if x not in sb][:3]
        res["only_oracle"] = [x for x in b if x not in sa][:3]
    return res


def main(argv):
    from landframe.plans import ORACLE, QUERIES, load_all
    from landframe.session import build_session
    load_all()
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = build_session(extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="oracle-")})
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare_one(spark, con, n, QUERIES[n], ORACLE.get(n), sf_dir)
        except Exception as e:  # report and continue
            r = {"name": n, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("exact", "no-oracle"):
            bad += 1
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
