"""Malformed records (S1/Q4), nested markup (H1, H3, H6) and map geometry (S3/L11) on literal input."""

import random

import pytest
from pyspark.sql import functions as F

from landframe.operators.spatial import tag_with_polygon
from landframe.sources import files as S
from landframe.sources import gml
from landframe.sources import pages as H


@pytest.fixture()
def folder(tmp_path):
    path = tmp_path / "with space"
    path.mkdir()
    return path


@pytest.mark.parametrize("quoted_breaks", [None, True])
def test_every_record_is_loaded_or_rejected(spark, folder, quoted_breaks):
    (folder / "1.csv").write_text('1,a,b\n2,c,d,EXTRA\n3,"x\ny, z ""q""",w\n\n4\n5,,\n')
    (folder / "2.csv").write_text('6,a,b\n7,"c,c",\n8,5" pipe,z\n')
    (folder / "3.csv").write_text('9,a,b\n10,"never closed,x\n11,a,b\n')
    rows, bad = S.read_headerless_checked(spark, str(folder), ["A", "B", "C"], quoted_breaks=quoted_breaks)
    assert sorted(tuple(r) for r in rows.drop("file").collect()) == [
        ("1", "a", "b"), ("3", 'x\ny, z "q"', "w"), ("5", "", ""), ("6", "a", "b"), ("7", "c,c", ""), ("8", '5" pipe', "z"), ("9", "a", "b")]
    assert sorted((r.record, r.n_fields, r.reason) for r in bad.collect())[1:] == [("2,c,d,EXTRA", 4, "too many fields"), ("4", 1, "too few fields")]
    assert any("never closed" in r.record and "11,a,b" in r.record for r in bad.collect())


def test_seventy_seven_fields(spark, folder):
    names = [f"f{i}" for i in range(77)]
    lines = [",".join(str(i * j) for j in range(n)) for i, n in enumerate([77, 78, 77, 3, 76])]
    (folder / "a.csv").write_text("\n".join(lines) + "\n")
    counts = S.load_headerless(spark, str(folder), names, str(folder.parent / "out"), str(folder.parent / "bad")).first()
    assert (counts.loaded, counts.rejected) == (2, 3)
    assert sorted(r.n_fields for r in spark.read.parquet(str(folder.parent / "bad")).collect()) == [3, 76, 78]


def page(spark, html):
    return spark.createDataFrame([(1, html), (2, None), (3, "")], "id int, html string")


def texts(spark, html, tag, **kw):
    return [r.text for r in H.extract_text(page(spark, html), "id", "html", tag, **kw).orderBy("pos").collect()]


def test_links_are_href_attributes_decoded(spark):
    html = '<a data-href="no" href="/o?a=1&amp;b=2">x</a><a data-href="none">y</a><A HREF=\'/&eacute;&#33;\'>z</A>'
    assert [r.href for r in H.extract_links(page(spark, html), "id", "html").collect()] == ["/o?a=1&b=2", "/é!"]
    long = "/x" + "&amp;" * 3  # 4 characters decoded plus the slash and x
    assert H.filter_links(page(spark, f'<a href="{long}">'), "id", "html", 5).count() == 0


def test_entities(spark):
    one = spark.createDataFrame([("a&amp;lt;&nbsp;&#233;&#xE9;&Eacute;&#x1F600;&bogus;&#0;&#xD800;&amp &",)], "t string")
    assert one.select(H.decode_entities("t")).first()[0] == "a&lt;\xa0ééÉ😀&bogus;��&amp &"


def test_nested_and_unclosed_elements(spark):
    html = '<ul><li>one<ul><li>sub<li>sub2</ul>tail<li class="x y">two</ul><div id="d">a<div>b</div>c</div><p>p1<p>p2<div>d</div>x</p><p class=x>p3'
    assert texts(spark, html, "li") == ["onesubsub2tail", "sub", "sub2", "two"]
    assert texts(spark, html, "li", class_="x") == ["two"] and texts(spark, html, "li", class_="z") == []
    assert texts(spark, html, "div") == ["abc", "b", "d"] and texts(spark, html, "div", id_="d") == ["abc"]
    assert texts(spark, html, "p") == ["p1", "p2", "p3"] and texts(spark, html, "p", class_="x") == ["p3"]
    assert texts(spark, "<pre>no p</pre><b title='<p>'>x</b>", "b") == ["x"]
    assert texts(spark, "</p></ul></li>", "p") == [] and texts(spark, "<dl><dt>a<dd>b<dt>c</dl>", "dt") == ["a", "c"]


def cells(spark, html):
    return sorted((r.tbl, r.row, r.col, r.text) for r in H.extract_table(page(spark, html), "id", "html").collect())


def test_nested_and_unclosed_cells(spark):
    html = "<table><tr><td>o<table><tr><td>inner<td>i2</table>after</td><td>z</td></tr><tr><td>a<td>b<tr><td>c</table><td>outside"
    assert cells(spark, html) == [(0, 0, 0, "oinneri2after"), (0, 0, 1, "z"), (0, 1, 0, "a"), (0, 1, 1, "b"), (0, 2, 0, "c"), (1, 0, 0, "inner"), (1, 0, 1, "i2")]
    assert cells(spark, "<table><thead><tr><th>h</thead><tbody><td>x") == [(0, 0, 0, "h"), (0, 1, 0, "x")]
    assert cells(spark, "<TABLE><TR><TD a='>'>1</TD></TR></TABLE><table><td>2") == [(0, 0, 0, "1"), (1, 0, 0, "2")]


class Tree:
    """A random table tree, written with or without closing tags."""

    def __init__(self, rng, depth=0):
        self.rows = [[(f"t{rng.randrange(99)}", Tree(rng, depth + 1) if depth < 3 and rng.random() < 0.3 else None)
                      for _ in range(rng.randrange(1, 4))] for _ in range(rng.randrange(1, 4))]

    def html(self, rng):
        shut = lambda tag: tag if rng.random() < 0.5 else ""
        return "<table>" + "".join("<tr>" + "".join(
            f"<td>{t}{n.html(rng) if n else ''}" + shut("</td>") for t, n in row) + shut("</tr>") for row in self.rows) + "</table>"

    def text(self):
        return "".join(t + (n.text() if n else "") for row in self.rows for t, n in row)

    def cells(self, counter):
        me = counter[0]
        counter[0] += 1
        for i, row in enumerate(self.rows):
            for j, (t, n) in enumerate(row):
                yield me, i, j, t + (n.text() if n else "")
                if n:
                    yield from n.cells(counter)


def test_random_table_trees(spark):
    rng = random.Random(6)
    trees = [Tree(rng) for _ in range(60)]
    df = spark.createDataFrame([(i, t.html(rng)) for i, t in enumerate(trees)], "id int, html string")
    got = {}
    for r in H.extract_table(df, "id", "html").collect():
        got.setdefault(r.id, []).append((r.tbl, r.row, r.col, r.text))
    assert {i: sorted(v) for i, v in got.items()} == {i: sorted(t.cells([0])) for i, t in enumerate(trees)}


GML = """<?xml version='1.0'?>
<osgb:FeatureCollection xmlns:osgb='u' xmlns:gml='g'>
<gml:boundedBy><gml:Box><gml:coordinates>0,0 9,9</gml:coordinates></gml:Box></gml:boundedBy>
<osgb:queryExtent><gml:Box><gml:coordinates>1,2 5,7</gml:coordinates></gml:Box></osgb:queryExtent>
<osgb:topographicMember>
<osgb:TopographicArea fid='osgb1'><osgb:featureCode>10021</osgb:featureCode><osgb:theme>A</osgb:theme><osgb:theme>B</osgb:theme>
<osgb:polygon><gml:Polygon><gml:outerBoundaryIs><gml:LinearRing><gml:coordinates>0,0 0,4 4,4 4,0 0,0</gml:coordinates></gml:LinearRing></gml:outerBoundaryIs>
<gml:innerBoundaryIs><gml:LinearRing><gml:coordinates>1,1 2,1 2,2 1,2</gml:coordinates></gml:LinearRing></gml:innerBoundaryIs></gml:Polygon></osgb:polygon></osgb:TopographicArea></osgb:topographicMember>
<osgb:BoundaryLine fid="osgb2"><osgb:polyline><gml:LineString><gml:coordinates>0,0 1,1
 2,5</gml:coordinates></gml:LineString></osgb:polyline></osgb:BoundaryLine>
<x:Other fid="q"><a>1</a></x:Other>
<osgb:TopographicArea fid="osgb3"><gml:Surface><gml:exterior><gml:Ring><gml:curveMember><gml:LineString><gml:posList srsDimension="3">10 0 9 14 0 9 14 4 9</gml:posList></gml:LineString></gml:curveMember>
<gml:curveMember><gml:LineString><gml:pos>14 4</gml:pos><gml:pos>10 4</gml:pos></gml:LineString></gml:curveMember></gml:Ring></gml:exterior></gml:Surface></osgb:TopographicArea>
<osgb:CartographicText fid="osgb4"><osgb:textString>a fid b</osgb:textString><osgb:anchorPoint><gml:Point srsDimension="3"><gml:posList>3.5 2 1</gml:posList></gml:Point></osgb:anchorPoint></osgb:CartographicText>
<osgb:TopographicArea fid="osgb5"><gml:exterior><gml:LinearRing><gml:posList>0 0 1 x 1 1 0 0</gml:posList></gml:LinearRing></gml:exterior></osgb:TopographicArea>
<osgb:TopographicArea fid="osgb6"><gml:exterior><gml:LinearRing><gml:posList>0 0 1 1 0</gml:posList></gml:LinearRing></gml:exterior></osgb:TopographicArea>
<osgb:TopographicArea fid="osgb7"/>
</osgb:FeatureCollection>"""


def test_features_of_all_layers_with_geometry(spark, folder):
    (folder / "t1.gml").write_text(GML)
    rows = {r.TOID: r for r in gml.read_map_features(spark, str(folder)).collect()}
    ring = lambda r: [tuple(p) for p in r]
    assert [ring(r) for r in rows["osgb1"].rings] == [[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], [(1, 1), (1, 2), (2, 2), (2, 1), (1, 1)]]
    assert (rows["osgb1"].FeatureCode, rows["osgb1"].Theme, rows["osgb1"].ThemeCount, rows["osgb1"].tile) == (10021, "A", 2, "t1")
    assert [ring(r) for r in rows["osgb2"].lines] == [[(0, 0), (1, 1), (2, 5)]] and rows["osgb2"].rings is None
    assert [ring(r) for r in rows["osgb3"].rings] == [[(10, 0), (14, 0), (14, 4), (10, 4), (10, 0)]]
    assert tuple(rows["osgb4"].point) == (3.5, 2.0) and rows["osgb4"].TextString == "a fid b" and rows["osgb4"].lines is None
    assert rows["osgb5"].rings is None and rows["osgb5"].geometry_error == "position is no number"
    assert rows["osgb6"].rings is None and rows["osgb6"].geometry_error == "position is no number"
    assert [ring(r) for r in rows[None].rings] == [[(1, 2), (5, 2), (5, 7), (1, 7), (1, 2)]] and rows[None].layer == "queryExtent"
    # other feature types and features without content are not routed, and can be counted
    lost = gml.feature_records(spark, str(folder), list(gml.MAP_LAYERS)).filter("layer is null").collect()
    assert sorted(r.xml[:4] for r in lost) == ['"osg', '"q">']


def test_features_in_small_splits(spark, folder):
    """Splits inside a file cut no feature."""
    body = "".join(f"<o:TopographicArea fid='a{i}'><o:theme>{'x' * (i % 50)}</o:theme></o:TopographicArea>\n<o:TopographicPoint fid='p{i}'></o:TopographicPoint>" for i in range(500))
    (folder / "t.gml").write_text(f"<o:FeatureCollection>{body}</o:FeatureCollection>")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        got = gml.read_map_features(spark, str(folder)).select("layer", "TOID").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r.layer, r.TOID) for r in got) == sorted([("TopographicArea", f"a{i}") for i in range(500)] + [("TopographicPoint", f"p{i}") for i in range(500)])


def test_all_layers_in_one_scan_and_through_the_polygon_join(spark, folder):
    (folder / "t1.gml").write_text(GML)
    plan = gml.read_map_features(spark, str(folder))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    layers = gml.load_map_layers(spark, str(folder), str(folder.parent / "loaded"), "201704")
    assert {n: d.count() for n, d in layers.items()} == {"TopographicArea": 4, "BoundaryLine": 1, "CartographicText": 1, "queryExtent": 1,
                                                          "TopographicLine": 0, "TopographicPoint": 0, "CartographicSymbol": 0}
    points = spark.createDataFrame([(1, 0.5, 0.5), (2, 1.5, 1.5), (3, 12.0, 2.0), (4, 20.0, 2.0), (5, 1.0, 1.5)], "id int, x double, y double")
    tagged = tag_with_polygon(points, gml.polygon_layer_of(layers["TopographicArea"], ["TOID"]), "x", "y", ["TOID"])
    assert {r.id: r.TOID for r in tagged.collect()} == {1: "osgb1", 2: None, 3: "osgb3", 4: None, 5: "osgb1"}
    assert spark.read.parquet(str(folder.parent / "loaded")).select(F.countDistinct("release")).first()[0] == 1
