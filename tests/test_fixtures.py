"""End-to-end jobs on small files shaped like the jobs' real inputs (FIXTURES.md),
read through the library's own readers."""

import os
import uuid

from pyspark.sql import functions as F

from landframe.operators import spatial as G
from landframe.plans import pipelines as P
from landframe.session import checkpoint_dir
from landframe.sources import files as S
from landframe.sources.layouts import ADDRESS_FIELDS


def _scratch(spark, name):
    root = checkpoint_dir(spark)
    root = root[len("file:"):] if root.startswith("file:") else root
    path = f"{root.rstrip('/')}/fixture-{name}-{uuid.uuid4().hex}"
    os.makedirs(path)
    return path


def _write(path, name, lines):
    with open(f"{path}/{name}", "w") as f:
        f.write("\n".join(lines) + "\n")


def _address_line(uprn, parent, x, y):
    vals = [""] * len(ADDRESS_FIELDS)
    for k, v in (("UPRN", uprn), ("PARENT_UPRN", parent), ("X_COORDINATE", x), ("Y_COORDINATE", y),
                 ("STATE_DATE", "2017-04-03")):
        vals[ADDRESS_FIELDS.index(k)] = v
    return ",".join(vals)


def test_f1_address_release(spark):
    path = _scratch(spark, "address")
    a = [_address_line("1", "", "100.004", "200.006"),                 # 1-digit id, empty parent
         _address_line("12345678901", "5", "110", "210"),              # 11 digits
         _address_line("123456789012", "5", "110", "210"),             # 12 digits, shares a pair
         _address_line("1234567890123", "7", "53000", "1180000")]      # 13 digits, colliding paste
    b = [_address_line(str(100 + i), "9", "120", "220") for i in range(5)]   # pair shared by 5
    b += [_address_line("200", "9", "530001", "180000"),               # collides when pasted
          _address_line("201", "9", "", "220"), _address_line("202", "9", "abc", "220")]
    _write(path, "part1.csv", a)
    _write(path, "part2.csv", b)
    raw = S.read_headerless(spark, path, ADDRESS_FIELDS)
    assert raw.count() == 12
    boundary = G.polygon_layer(spark, [(1, "in", [[(0, 0), (1000, 0), (1000, 1000), (0, 1000)]])], "name string")
    all_rows, clipped, rejected = P.address_release(raw, boundary, "201704", [F.col("OBJECTID").cast("long")])
    got = {r.objectid: r for r in all_rows.collect()}
    assert got["1"].uprn == "000000000001" and got["1"].parent_uprn == "000000000000"
    assert got["12345678901"].uprn == "012345678901"
    assert got["1234567890123"].uprn == "1234567890123"            # never truncated
    assert (got["1"].x_coordinate, got["1"].y_coordinate) == (100.0, 200.01)
    assert got["12345678901"].flat == 2 and got["100"].flat == 5 and got["1"].flat == 1
    assert got["1234567890123"].flat == 1 and got["200"].flat == 1   # pairs kept apart
    assert {r.uprn for r in rejected.collect()} == {"000000000201", "000000000202"}
    assert {r.objectid for r in clipped.collect()} == {"1", "12345678901", "123456789012"} | {str(100 + i) for i in range(5)}
    assert {r.group for r in all_rows.collect()} == {1}


def test_f2_building_heights(spark):
    path = _scratch(spark, "heights")
    _write(path, "heights.csv", [
        "OS_TOPO_TOID,OS_TOPO_VERSION,BHA_ProcessDate,TileRef,AbsHMin,AbsH2,AbsHMax,RelH2,RelHMax,BHA_Conf",
        "osgb1000001,3,2017-01-05,TQ3080,10.1,20.2,22.0,10.1,11.9,80",
        "osgb1000001,3,2016-12-01,TQ3080,10.0,20.0,21.0,9.9,11.0,60",     # repeated id, earlier date wins
        "osgb1000002,2,not a date,TL1234,5.0,9.0,9.5,4.0,4.5,70",         # unparsable date kept as text
        "osgb1000003,1,2017-02-02,SU9999,1.0,2.0,3.0,1.0,2.0,50",         # tile not wanted
        "osgb1000009,1,2017-02-02,TQ1111,1.0,2.0,3.0,1.0,2.0,50"])        # no feature
    heights = S.read_csv(spark, path, schema="OS_TOPO_TOID string, OS_TOPO_VERSION int, BHA_ProcessDate string, "
                         "TileRef string, AbsHMin double, AbsH2 double, AbsHMax double, RelH2 double, "
                         "RelHMax double, BHA_Conf int")
    layer = spark.createDataFrame([("1000001", "Buildings"), ("1000002", "Buildings"),
                                   ("1000003", "Buildings"), ("1000004", "Roads")], "TOID string, Theme string")
    out = {r.TOID: r for r in P.building_heights(layer, heights, renames={"RelH2": "height"}).collect()}
    assert set(out) == {"1000001", "1000002"}
    assert out["1000001"].BHA_ProcessDate == "20161201000000" and out["1000001"].match_count == 2
    assert out["1000001"].height == 9.9
    assert out["1000002"].BHA_ProcessDate == "not a date"


def test_f4_population_change(spark):
    path = _scratch(spark, "population")
    _write(path, "population_wide.csv", [
        "GSS.Code.MSOA,District,Age,2016,2017,2050",
        "E02000001,City,0,10,11,12", "E02000001,City,1,20,21,30",
        "E02000002,Camden,0,5,6,", "E02000002,Camden,1,7,8,9"])       # a missing 2050 count
    wide = S.read_csv(spark, path, schema="`GSS.Code.MSOA` string, District string, Age int, "
                      "`2016` double, `2017` double, `2050` double")
    res = {r["GSS.Code.MSOA"]: (r["Y2016"], r["Y2050"], r["change"])
           for r in P.population_change(wide, ["GSS.Code.MSOA", "District", "Age"], "GSS.Code.MSOA",
                                        "2016", "2050").collect()}
    assert res == {"E02000001": (30.0, 42.0, 12.0), "E02000002": (12.0, None, None)}


def test_f7_tag_matrix_from_csv(spark):
    from landframe.operators.reshape import tag_matrix
    path = _scratch(spark, "skate")
    _write(path, "skate_park_data.csv", [
        "X,name,tags,borough,lat,lon",
        "1,Alpha,bowl street,Camden,51.5,-0.1",
        "2,Beta,  ,Hackney,51.6,-0.2",                 # null token: two spaces
        "3,Gamma,street  bowl bowl x,Islington,51.7,-0.3",
        "4,Delta,ramp,Ealing,51.8,-0.4"])
    raw = S.read_csv(spark, path, null_value="  ",
                     schema="X int, name string, tags string, borough string, lat double, lon double")
    m = tag_matrix(raw.drop("X"), "name", "tags", ["name"])
    assert set(m.columns) == {"name", "borough", "lat", "lon", "bowl", "street", "ramp", "x"}
    got = {r["name"]: (r["bowl"], r["street"], r["ramp"], r["x"]) for r in m.collect()}
    assert got == {"Alpha": (1, 1, None, None), "Beta": (None, None, None, None),
                   "Gamma": (1, 1, None, 1), "Delta": (None, None, 1, None)}


def test_f8_postcode_quality(spark):
    path = _scratch(spark, "planning")
    _write(path, "barbour.txt", [
        "Ptno,Pcode,Start_date,Completion_date",
        "1,SE1 2AA,20150101,20160101", "2,se1 2aa,0,20160101", "3,SE12AA,20150101,0",
        "4,xx SE1 2AA,20150101,20170101", "5,GIR 0AA,20150101,20150601", ",W1A 1AA,20150101,20150102"])
    rec = S.read_csv(spark, path, schema="Ptno int, Pcode string, Start_date int, Completion_date int")
    valid, missing, durations = P.postcode_quality(rec, "Ptno", "Pcode", "Start_date", "Completion_date")
    assert sorted((r.Ptno or 0) for r in valid.collect()) == [0, 1, 2, 4, 5]
    assert [r.Ptno for r in missing.collect()] == [3]
    assert sorted((r.Ptno or 0, r.duration) for r in durations.collect()) == [(0, 1), (1, 10000), (4, 20000), (5, 500)]


def test_f3_map_layers_from_tiles(spark):
    path = _scratch(spark, "tiles")

    def tile(name, areas, lines):
        body = "".join(f"<TopographicArea><TOID>{t}</TOID><FeatureCode>{c}</FeatureCode><Theme>Buildings</Theme>"
                       f"<CalculatedAreaValue>{a}</CalculatedAreaValue></TopographicArea>" for t, c, a in areas)
        body += "".join(f"<TopographicLine><TOID>{t}</TOID><FeatureCode>{c}</FeatureCode></TopographicLine>"
                        for t, c in lines)
        _write(path, name, [f"<FeatureCollection>{body}</FeatureCollection>"])

    tile("TQ3080.gml", [("osgb1", 10021, 12.5), ("osgb2", 10021, 40.0)], [("osgb9", 10019)])
    tile("TQ3081.gml", [("osgb3", 10053, 7.25)], [])
    layers = P.map_layer_load(spark, path, {
        "TopographicArea": "TOID string, FeatureCode int, Theme string, CalculatedAreaValue double",
        "TopographicLine": "TOID string, FeatureCode int"})
    areas = {r.TOID: (r.tile, r.CalculatedAreaValue) for r in layers["TopographicArea"].collect()}
    assert areas == {"osgb1": ("TQ3080", 12.5), "osgb2": ("TQ3080", 40.0), "osgb3": ("TQ3081", 7.25)}
    assert [(r.TOID, r.tile) for r in layers["TopographicLine"].collect()] == [("osgb9", "TQ3080")]


def test_f1_address_release_reprojects_to_boundary(spark):
    raw = spark.createDataFrame([("1", "", "-0.1276", "51.5072"), ("2", "", "-2.0", "53.0")],
                                "UPRN string, PARENT_UPRN string, X_COORDINATE string, Y_COORDINATE string")
    square = [(525000, 175000), (535000, 175000), (535000, 185000), (525000, 185000)]
    boundary = G.polygon_layer(spark, [(1, "centre", [square])], "name string")
    _all, clipped, _rej = P.address_release(raw, boundary, "201704", [F.col("OBJECTID").cast("long")],
                                            crs="EPSG:4326", boundary_crs="EPSG:27700")
    got = clipped.collect()
    assert [r.objectid for r in got] == ["1"]
    assert 529000 < got[0].x_coordinate < 531000 and 179000 < got[0].y_coordinate < 182000
