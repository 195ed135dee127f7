"""The driver contract: entry() runs on sf0.001 with a stable schema; every query has SQL."""

import importlib.util
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs_with_stable_schema(spark):
    mod = _entry_module()
    a, b = mod.entry(spark), mod.entry(spark)
    assert a.schema == b.schema
    assert a.count() == 25
    assert a.columns == ["n_nationkey", "n_name", "n_regionkey", "Y1996", "Y2000", "change"]


def test_queries_and_oracles_line_up():
    mod = _entry_module()
    q, o = mod.queries(), mod.oracle_sql()
    own = [k for k in q if not (k == "pipeline" or k[:2] == "op" and k[2].isdigit())]
    assert set(own) <= set(o) <= set(q) and len(own) >= 80
    assert all(callable(f) for f in q.values()) and all(isinstance(s, str) and s for s in o.values())
