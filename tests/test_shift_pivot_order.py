"""Grid shifts, long vocabularies, locale order and plain numbers on literal input."""

import random

import pytest
from pyspark.sql import functions as F

from landframe.functions.numbers import plain_number
from landframe.operators import reshape as R
from landframe.operators import setops as U
from landframe.operators.filters import profile_table
from landframe.operators.gridshift import grid_shift


def nodes(spark, n=12):
    rng = random.Random(3)
    rows = [(c, r, rng.uniform(-0.5, 0.5), rng.uniform(-0.5, 0.5)) for c in range(n) for r in range(n)]
    return rows, spark.createDataFrame(rows, "col long, row long, se double, sn double")


@pytest.mark.parametrize("budget", [128 << 20, 0])
def test_shift_there_and_back(spark, budget):
    rows, table = nodes(spark)
    at = {(c, r): (se, sn) for c, r, se, sn in rows}
    rng = random.Random(5)
    pts = [(i, 1000 + rng.uniform(0, 1100), 2000 + rng.uniform(0, 1100)) for i in range(500)] + [(900, 1000.0, 2000.0), (901, 999.0, 2500.0), (902, None, 2500.0), (903, 1100.0, 2100.0)]
    df = spark.createDataFrame(pts, "id int, x double, y double").withColumn("__t.x", F.lit(1))
    there = grid_shift(df, "x", "y", table, 100.0, (1000.0, 2000.0), broadcast_max_bytes=budget)
    assert there.columns == df.columns
    moved = {r.id: (r.x, r.y) for r in there.collect()}
    for i, x, y in pts:
        if i in (901, 902):
            assert moved[i] == (None, None)
            continue
        c, r = int((x - 1000) // 100), int((y - 2000) // 100)
        t, u = (x - 1000) / 100 - c, (y - 2000) / 100 - r
        want = [v + (1 - t) * (1 - u) * at[c, r][k] + t * (1 - u) * at[c + 1, r][k] + (1 - t) * u * at[c, r + 1][k] + t * u * at[c + 1, r + 1][k]
                for k, v in ((0, x), (1, y))]
        assert moved[i] == pytest.approx(want, abs=1e-9)
    back = {r.id: (r.x, r.y) for r in grid_shift(there, "x", "y", table, 100.0, (1000.0, 2000.0), inverse=True, iterations=6, broadcast_max_bytes=budget).collect()}
    assert all(back[i] == pytest.approx((x, y), abs=1e-6) for i, x, y in pts if i < 900)
    assert back[901] == (None, None)


def test_vocabulary_beyond_the_pivot_limit(spark):
    """12 000 tags in one table, and tags with odd names."""
    n = 12_000
    df = spark.range(0, n).select((F.col("id") % 7).alias("a.b"), F.concat(F.lit("t"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("k"), "id")
    wide = R.widen(df, ["a.b"], "k", "id", vocab=[f"t{i:05d}" for i in range(n)])
    assert len(wide.columns) == n + 1
    got = wide.selectExpr("`a.b`", "t00000", "t00001", "t02000", f"t{n - 1:05d}").orderBy("`a.b`").collect()
    for r in got:
        assert [r[1], r[2], r[3], r[4]] == [v if v % 7 == r[0] else None for v in (0, 1, 2000, n - 1)]
    rows = spark.createDataFrame([(1, "x`y", 1), (1, "a b", 2), (2, None, 3), (2, "zz", 4), (1, "a b", 9)], "id int, k string, v int")
    out = R.widen(rows, ["id"], "k", "v", vocab=["a b", "none", "x`y"], block=2)
    assert out.columns == ["id", "a b", "none", "x`y"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, 9, None, 1), (2, None, None, None)]
    same = R.widen(rows, ["id"], "k", "v", vocab=["a b", "none", "x`y"])
    assert sorted(tuple(r) for r in same.collect()) == sorted(tuple(r) for r in out.collect())


def test_more_tags_than_the_setting(spark):
    before = spark.conf.get("spark.sql.pivotMaxValues")
    spark.conf.set("spark.sql.pivotMaxValues", "3")
    try:
        df = spark.createDataFrame([("p", "a b c d e", 1), ("q", "b f", 2), ("r", None, 3)], "name string, tags string, n int")
        with pytest.raises(ValueError):
            R.tag_matrix(df, "name", "tags", ["n"])
        out = R.tag_matrix(df, "name", "tags", ["n"], max_tags=100)
        assert out.columns == ["name", "n", "a", "b", "c", "d", "e", "f"] and out.count() == 3
    finally:
        spark.conf.set("spark.sql.pivotMaxValues", before)


def test_locale_order(spark):
    words = ["b", "a", "B", "A", "é", "e", "E", "f", "É", None, "côte", "cote", "coté"]
    df = spark.createDataFrame([(w,) for w in words + ["a", "b"]], "w string")
    assert [r.w for r in U.unique_sorted(df, "w").collect()][:5] == [None, "A", "B", "E", "a"]
    assert [r.w for r in U.unique_sorted(df, "w", "UNICODE").collect()] == [None, "a", "A", "b", "B", "cote", "coté", "côte", "e", "E", "é", "É", "f"]
    assert [r.w for r in U.sort_by(df.distinct(), ["w"], "UNICODE").collect()][1:3] == ["a", "A"]


def test_plain_numbers_of_any_size(spark):
    df = spark.createDataFrame([("1.0E21",), ("1e20",), ("1e-20",), ("-1e-20",), ("0",), ("0.10",), ("123.450",), ("100",), ("1e40",), ("x",), (None,), ("-1.0E12",)], "t string")
    assert [r[0] for r in df.select(plain_number("t")).collect()] == [
        "1" + "0" * 21, "1" + "0" * 20, "0." + "0" * 19 + "1", "-0." + "0" * 19 + "1", "0", "0.1", "123.45", "100", None, None, None, "-1000000000000"]


def test_profile_of_a_frame(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, None)], "`x.y` int, s string")
    assert sorted(tuple(r) for r in profile_table(df).collect()) == [(1, "x.y", "int", 3, 0, 2), (2, "s", "string", 3, 2, 1)]
    assert profile_table(df.limit(0)).collect() == []
