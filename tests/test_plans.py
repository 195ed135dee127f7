"""Physical-plan properties of the registered queries."""

import pytest

from landframe.plans import QUERIES, load_all

load_all()
SMALL = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(spark, name):
    plan = _plan(QUERIES[name](spark, SMALL))
    for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, (name, bad)


def test_filters_reach_the_scan(spark):
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        plan = _plan(QUERIES["f1_f2_filters"](spark, SMALL))
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
    assert "PushedFilters: [IsNotNull(l_returnflag), IsNotNull(l_quantity), IsNotNull(l_discount), " \
           "EqualTo(l_returnflag,R), GreaterThan(l_quantity,10.0), GreaterThan(l_discount,0.0)]" in plan


def test_columns_are_pruned(spark):
    plan = _plan(QUERIES["w1_add_count"](spark, SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int>" in plan
    plan = _plan(QUERIES["l4_period_change"](spark, SMALL))
    # the melt's unused id columns never reach the scan
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int>" in plan


def test_left_join_plus_not_null_becomes_inner(spark):
    plan = QUERIES["j5_match_only"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "LeftOuter" not in plan


def test_group_count_has_no_window(spark):
    for name in ("w1_add_count", "w2_add_sum", "w5_first_per_key", "w6_repeats", "a4_multi_occupancy", "j11_lookup_first"):
        assert "Window" not in _plan(QUERIES[name](spark, SMALL)), name


def _file_layer(spark, n=400):
    """A mixed layer read from files: one large polygon and a dense town of tiny ones."""
    import uuid

    from landframe.operators import spatial as G
    from landframe.session import checkpoint_dir
    rows = [(0, "country", [[(0.0, 0.0), (4096.0, 0.0), (4096.0, 4096.0), (0.0, 4096.0)]])]
    rows += [(i + 1, f"house{i}", [[(x, y), (x + 0.9, y), (x + 0.9, y + 0.9), (x, y + 0.9)]])
             for i in range(n) for x, y in [(100.0 + i % 20, 100.0 + i // 20)]]
    path = f"{checkpoint_dir(spark)}/test-layer-{uuid.uuid4().hex}"
    G.polygon_layer(spark, rows, "name string").repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def test_polygon_join_without_broadcast_on_a_file_layer(spark):
    from pyspark.sql import functions as F

    from landframe.operators import spatial as G
    layer = _file_layer(spark)
    base, least, levels, _ = G._plan_grid(layer, None, 0)
    assert len(levels) == 2  # used levels only
    assert G.polygon_cells(layer, base, least).select(F.max(F.size("cands"))).first()[0] <= 25  # of 401
    pts = spark.range(3000).select("id", (F.col("id") % 60 / 2.0 + 95).alias("x"), (F.floor(F.col("id") / 60) / 2.0 + 95).alias("y"))
    far = G.tag_with_polygon(pts, layer, "x", "y", ["name"], broadcast_max_bytes=0)
    near = G.tag_with_polygon(pts, layer, "x", "y", ["name"])
    assert sorted(map(tuple, far.collect())) == sorted(map(tuple, near.collect()))
    houses = {(100.0 + i % 20, 100.0 + i // 20): f"house{i}" for i in range(400)}
    def name(r):  # 0.9 wide houses on a grid of 1: points at halves lie inside, the highest ordinal wins
        return houses.get((r.x // 1, r.y // 1), "country") if r.x % 1 <= 0.9 and r.y % 1 <= 0.9 else "country"
    assert all(r["name"] == name(r) for r in far.collect())
    text = far._jdf.queryExecution().optimizedPlan().toString()
    for line in text.splitlines():  # nothing that carries candidates is joined to the next level
        assert not ("Join" in line and "__cands" in line)


def test_exact_polygon_test_is_evaluated_once_under_a_filter(spark):
    from pyspark.sql import functions as F

    from landframe.operators import spatial as G
    layer = _file_layer(spark, 20)
    pts = spark.range(100).select("id", F.col("id").cast("double").alias("x"), F.col("id").cast("double").alias("y"))
    tagged = G.tag_with_polygon(pts, layer, "x", "y", ["name"])
    once = tagged._jdf.queryExecution().optimizedPlan().toString().count("aggregate(")
    kept = tagged.filter(F.col("name").isNotNull() & F.col("poly_id").isNotNull())
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("aggregate(") == once
