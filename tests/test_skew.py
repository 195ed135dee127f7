"""A key holding a third of all rows: results against brute force, and plans that never
route a whole key through a per-key window."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from landframe.operators import aggregate as A
from landframe.operators import joins as J
from landframe.operators import window as W

N = 30_000


def _skewed(spark):
    # key 0 holds every third row (10 000 of 30 000); the rest are unique keys
    return spark.range(N).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 7).cast("double").alias("x"))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_add_count_hot_key(spark):
    df = _skewed(spark)
    out = W.add_count(df, ["k"], "n")
    assert "Window" not in _plan(out)
    got = Counter(r.n for r in out.select("n").collect())
    assert got == Counter({10_000: 10_000, 1: 20_000})


def test_first_and_repeats_hot_key(spark):
    df = _skewed(spark)
    first = W.first_per_key(df, ["k"], ["x", "id"])
    rep = W.find_repeats(df, ["k"], ["x", "id"])
    assert "Window" not in _plan(first) and "Window" not in _plan(rep)
    hot = first.filter("k = 0").collect()
    assert len(hot) == 1 and (hot[0].x, hot[0].id) == (0.0, 0)   # smallest (x, id) among ids % 3 == 0
    assert first.count() == 20_001
    assert rep.count() == N - 20_001


def test_flag_any_match_hot_blank_key(spark):
    left = spark.range(N).select("id", F.when(F.col("id") % 3 == 0, F.lit("")).otherwise(
        F.concat(F.lit("P"), F.col("id").cast("string"))).alias("pc"))
    right = spark.createDataFrame([("",), ("P1",), ("P2",)], "pc string")
    out = J.flag_any_match(left, right, [("pc", "pc")], "m")
    plan = _plan(out)
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert out.filter("m = 1").count() == 10_000 + 2
    assert out.count() == N


def test_multi_occupancy_hot_coordinate(spark):
    df = _skewed(spark).select("id", F.col("k").cast("double").alias("cx"), F.lit(0.0).alias("cy"),
                               (F.col("id") % 2).cast("string").alias("area"))
    res = {r.area: r.total_flats for r in A.multi_occupancy(df, "cx", "cy", "area", ["id"]).collect()}
    assert res == {"0": 10_000}       # the hot coordinate's first row (id 0) is in area "0"


def test_point_in_polygon_hot_cell(spark):
    from landframe.operators import spatial as G
    layer = G.polygon_layer(spark, [(1, "a", [[(0, 0), (10, 0), (10, 10), (0, 10)]]),
                                    (2, "b", [[(10, 0), (20, 0), (20, 10), (10, 10)]])], "name string")
    pts = spark.range(N).select("id", F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise((F.col("id") % 25).cast("double")).alias("x"),
                                F.lit(5.0).alias("y"))
    out = G.tag_with_polygon(pts, layer, "x", "y", ["name"])
    assert out.count() == N                      # one row per point, never multiplied
    got = Counter(r.name for r in out.select("name").collect())
    xs = [5.0 if i % 3 == 0 else float(i % 25) for i in range(N)]
    exp = Counter("a" if x < 10 else ("b" if x <= 20 else None) for x in xs)
    assert got == exp


def test_lookup_first_and_sum_hot_key(spark):
    df = _skewed(spark)
    keys = spark.createDataFrame([(0,), (1,), (2,)], "k long")
    first = {r.k: (r.id, r.match_count) for r in J.lookup_first(keys, df, "k", "k", ["id"]).collect()}
    assert first == {0: (0, 10_000), 1: (1, 1), 2: (2, 1)}
    sums = W.add_sum(df, ["k"], "x", "sx")
    assert "Window" not in _plan(sums)
    hot = sums.filter("k = 0").select("sx").distinct().collect()
    assert len(hot) == 1 and hot[0].sx == float(sum(i % 7 for i in range(0, N, 3)))


def test_widen_hot_id(spark):
    from landframe.operators.reshape import widen
    df = _skewed(spark).select(F.col("k").alias("id"), (F.col("id") % 4).cast("string").alias("key"), "x")
    w = widen(df, ["id"], "key", "x")
    assert w.columns == ["id", "0", "1", "2", "3"] and w.count() == 20_001
    hot = w.filter("id = 0").first()
    assert (hot["0"], hot["1"], hot["2"], hot["3"]) == (6.0, 6.0, 6.0, 6.0)


@pytest.mark.parametrize("name", ["count", "sum", "repeats", "flag", "lookup"])
def test_hot_key_is_split_in_the_join_back(spark, name):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 120_000
        df = spark.range(0, n, 1, 8).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 5000).alias("k"),
                                            F.col("id").alias("x"), F.hash("id").alias("v"))
        keys = spark.range(5000).select(F.col("id").alias("k"), F.col("id").alias("y")).unionByName(
            spark.createDataFrame([(-1, 1)], "k long, y long"))
        out = {"count": lambda: W.add_count(df, ["k"]), "sum": lambda: W.add_sum(df, ["k"], "x", "s"),
               "repeats": lambda: W.find_repeats(df, ["k"], ["x"]),
               "flag": lambda: J.flag_any_match(df, keys, [("k", "k")], "hit"),
               "lookup": lambda: J.lookup_first(df, keys, "k", "k", ["y"])}[name]()
        assert len(out.collect()) > n / 2
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
