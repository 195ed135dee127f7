"""Work on map geometry that must grow with the input and no faster: position lists, tiles, loads."""

import contextlib
import io
import os
import time

from pyspark.sql import functions as F

from landframe.operators.spatial import poslist_ring, ring_bbox, tag_with_polygon
from landframe.plans import q_layers


def test_a_long_position_list_is_read_once(spark):
    n = 20_000  # places; read anew for each place, this takes minutes
    text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.concat(i.cast("string"), F.lit(" -"), i.cast("string"))), " ")
    rows = spark.range(4).select("id", F.when(F.col("id") < 2, text).when(F.col("id") == 2, F.lit("1 2 x 4 5")).alias("t"))
    began = time.time()
    out = rows.select("id", ring_bbox(F.array(poslist_ring("t"))).alias("b"), F.size(poslist_ring("t")).alias("n")).orderBy("id").collect()
    assert time.time() - began < 40
    assert [tuple(r.b) for r in out] == [(1.0, -n, n, -1.0)] * 2 + [(1.0, 2.0, 1.0, 4.0), (None,) * 4]
    assert [r.n for r in out[:3]] == [n, n, 2]


def test_tiles_are_made_by_many_tasks_into_one_folder(spark, tmp_path):
    parts = spark.range(0, 4000, 1, 1).select(F.col("id").alias("p_partkey"), (F.col("id") % 50).cast("int").alias("p_size"), F.lit("Brand#1").alias("p_brand"))
    parts.write.parquet(str(tmp_path / "part.parquet"))
    path = q_layers._tiles(spark, str(tmp_path)).removeprefix("file:")
    found = [os.path.join(at, f) for at, _, files in os.walk(path) for f in files if f.endswith(".txt")]
    tiles = [open(f).read() for f in found]
    assert {os.path.dirname(f) for f in found} == {path}  # one folder to list, not one for every tile
    assert len({os.path.basename(f).split("-")[1] for f in found}) > 2  # several tasks, though the table is one file
    assert sorted(t.count("<osgb:TopographicArea ") for t in tiles) == [200] * 20 and all(t.count("queryExtent>") == 2 for t in tiles)


def test_a_loaded_layer_of_many_polygons_is_not_broadcast(spark, tmp_path):
    n = 12_000  # a wide, well packed table: its estimate is far below its rows
    at = lambda dx, dy: F.struct((F.col("id") * 2.0 + dx).alias("x"), F.lit(float(dy)).alias("y"))
    wide = [F.lit(None).cast("string").alias(f"c{i}") for i in range(60)]
    ring = F.array(F.array(at(0, 0), at(1, 0), at(1, 1), at(0, 1), at(0, 0)))
    spark.range(n).select(F.col("id").alias("poly_id"), F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"), *wide, ring.alias("rings")).write.parquet(str(tmp_path / "areas"))
    areas = spark.read.parquet(str(tmp_path / "areas"))
    points = spark.range(3 * n).select("id", (F.col("id") * 1.0 - 0.5).alias("x"), F.lit(0.5).alias("y"))
    tagged = tag_with_polygon(points, areas, "x", "y", ["name"], broadcast_max_bytes=0)
    inside = (F.col("id") % 2 == 1) & (F.col("id") < 2 * n)
    name = F.when(inside, F.concat(F.lit("n"), F.floor(F.col("id") / 2).cast("string")))
    assert tagged.filter(~F.col("name").eqNullSafe(name)).count() == 0 and tagged.count() == 3 * n
    said = io.StringIO()
    with contextlib.redirect_stdout(said):
        tagged.explain()
    assert "BroadcastExchange" not in said.getvalue() and said.getvalue().count("SortMergeJoin") >= 3
