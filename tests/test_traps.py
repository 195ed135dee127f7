"""One small test per semantics trap plus operator properties, on literal rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from landframe import functions as X
from landframe.operators import aggregate as A
from landframe.operators import filters as FL
from landframe.operators import joins as J
from landframe.operators import reshape as R
from landframe.operators import spatial as G
from landframe.operators import window as W
from landframe.sources import pages as H


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()] if cols else [tuple(r) for r in df.collect()]


def test_pad_never_truncates(spark):
    df = spark.createDataFrame([("1234567890123",), ("",), ("42",), (None,)], "u string")
    got = rows(df.select(X.pad_left("u", 12).alias("p")))
    assert got == [("1234567890123",), ("000000000000",), ("000000000042",), (None,)]


def test_ansi_safe_conversions(spark):
    df = spark.createDataFrame([("", 1.0, 0.0), ("1e3", 3.0, 2.0), ("abc", 1.0, None)], "t string, a double, b double")
    got = rows(df.select(X.to_double("t"), X.safe_ratio("a", "b", 4)))
    assert got == [(None, None), (1000.0, 1.5), (None, None)]


def test_null_keys_match_like_r(spark):
    a = spark.createDataFrame([(1, "a"), (None, "b")], "k int, va string")
    b = spark.createDataFrame([(1, "x"), (None, "y")], "k2 int, vb string")
    assert len(J.merge_on(a, b, "k", "k2").collect()) == 2
    assert len(J.merge_on(a, b, "k", "k2", null_keys="drop").collect()) == 1


def test_merge_suffixes_and_key_first(spark):
    a = spark.createDataFrame([(1, "a", 10)], "id int, name string, v int")
    b = spark.createDataFrame([(1, "b", 20)], "key int, name string, w int")
    m = J.merge_on(a, b, "id", "key")
    assert m.columns == ["id", "name.x", "v", "name.y", "w"]


def test_keep_in_and_not_in_partition_input(spark):
    a = spark.createDataFrame([(i,) for i in [1, 2, 3, None]], "k int")
    b = spark.createDataFrame([(2,), (None,)], "k int")
    i, o = J.keep_in(a, b, "k"), J.keep_not_in(a, b, "k")
    assert i.count() + o.count() == a.count()
    assert sorted(rows(i), key=str) == sorted([(2,), (None,)], key=str)


def test_sum_poisoned_by_null(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0)], "g string, v double")
    got = dict(rows(A.group_sum(df, ["g"], "v", "s")))
    assert got == {"a": None, "b": 2.0}
    assert dict(rows(A.group_sum(df, ["g"], "v", "s", na="skip"))) == {"a": 1.0, "b": 2.0}


def test_period_change_inner_on_both_periods(spark):
    df = spark.createDataFrame([("x", 2016, 1.0), ("x", 2050, 4.0), ("y", 2016, 2.0)], "k string, yr int, v double")
    got = rows(A.period_change(df, ["k"], "yr", 2016, 2050, "v", "a", "b"))
    assert got == [("x", 1.0, 4.0, 3.0)]


def test_first_per_key_is_ordered_not_arbitrary(spark):
    df = spark.createDataFrame([(1, 3, "late"), (1, 1, "early"), (2, 5, "only")], "k int, o int, v string")
    assert sorted(rows(W.first_per_key(df, ["k"], ["o"]), "k", "v")) == [(1, "early"), (2, "only")]
    assert sorted(rows(W.find_repeats(df, ["k"], ["o"]), "k", "v")) == [(1, "late")]


def test_pivot_drops_null_key_and_sorts_bytes(spark):
    df = spark.createDataFrame([(1, "bowl", 1), (1, "Wood", 1), (2, "Street", 1), (3, None, 1)], "id int, k string, v int")
    w = R.widen(df, ["id"], "k", "v")
    assert w.columns == ["id", "Street", "Wood", "bowl"]
    assert w.count() == 2


def test_melt_then_widen_is_identity(spark):
    df = spark.createDataFrame([(1, "a", "b"), (2, "c", None)], "id int, p string, q string")
    back = R.widen(R.melt_except(df, ["id"]), ["id"], "key", "value", vocab=["p", "q"])
    assert sorted(rows(back)) == sorted(rows(df), key=str) or sorted(rows(back), key=str) == sorted(rows(df), key=str)


def test_coordinate_pairs_do_not_collide(spark):
    df = spark.createDataFrame([(53000.0, 1180000.0), (530001.0, 180000.0), (None, None), (None, None)], "x double, y double")
    got = sorted(rows(W.add_count(df, ["x", "y"], "n"), "n"))
    assert got == [(1,), (1,), (2,), (2,)]


def test_postcode_pattern_is_half_anchored(spark):
    df = spark.createDataFrame([("SE1 2AA",), ("xx SE1 2AA",), ("GIR 0AAzz",), ("SE12AA",), (None,)], "p string")
    got = rows(df.select(FL.valid_postcode("p"), FL.valid_postcode("p", strict=True)))
    assert got == [(True, True), (True, False), (True, False), (False, False), (False, False)]


def test_half_even_rounding(spark):
    df = spark.createDataFrame([(0.125,), (2.5,), (3.5,)], "v double")
    assert rows(df.select(X.round_half_even("v", 2), X.round_half_even("v", 0))) == [(0.12, 0.0), (2.5, 2.0), (3.5, 4.0)]


def test_paste_missing_values(spark):
    df = spark.createDataFrame([("a", None)], "a string, b string")
    assert rows(df.select(X.paste("a", "b"), X.paste("a", "b", na_text=None))) == [("a NA", None)]


def test_trim_removes_tabs_and_newlines(spark):
    df = spark.createDataFrame([("\t 123 \n",)], "u string")
    assert rows(df.select(X.trim_ws("u"))) == [("123",)]


def test_replace_first_only(spark):
    df = spark.createDataFrame([("City & Hackney & X",), ("none",)], "b string")
    assert rows(df.select(X.replace_first("b", " & ", " and "))) == [("City and Hackney & X",), ("none",)]


def test_normalise_date_leaves_unparsable(spark):
    df = spark.createDataFrame([("2017-04-03",), ("03/04/2017",), ("3 April 2017",), ("20170403120501.123",), ("n/a",), ("",)],
                               "d string")
    got = [r[0] for r in df.select(X.normalise_date("d")).collect()]
    assert got == ["20170403", "20170403", "20170403", "20170403", "n/a", ""]
    assert df.select(X.normalise_datetime("d")).collect()[3][0] == "20170403120501"


def test_blank_keys_match_unless_ignored(spark):
    a = spark.createDataFrame([(1, ""), (2, "AB1")], "id int, pc string")
    b = spark.createDataFrame([("",), ("ZZ9",)], "pc string")
    assert sorted(rows(J.flag_any_match(a, b, [("pc", "pc")], "m"), "id", "m")) == [(1, 1), (2, 0)]
    assert sorted(rows(J.flag_any_match(a, b, [("pc", "pc")], "m", ignore_blank=True), "id", "m")) == [(1, 0), (2, 0)]


def test_lookup_first_takes_first_and_counts(spark):
    a = spark.createDataFrame([("t1",), ("t2",), ("t3",)], "toid string")
    b = spark.createDataFrame([("t1", 2, 9.0), ("t1", 1, 5.0), ("t2", 7, 1.0)], "toid string, o int, h double")
    got = sorted(rows(J.lookup_first(a, b, "toid", "toid", ["o"]), "toid", "o", "h", "match_count"))
    assert got == [("t1", 1, 5.0, 2), ("t2", 7, 1.0, 1)]


def _layer(spark):
    return G.polygon_layer(spark, [
        (1, "sq", [[(0, 0), (10, 0), (10, 10), (0, 10)]]),
        (2, "over", [[(5, 5), (15, 5), (15, 15), (5, 15)]]),
        (3, "notch", [[(20, 0), (30, 0), (30, 10), (27, 10), (27, 3), (23, 3), (23, 10), (20, 10)]]),
        (4, "hole", [[(40, 0), (50, 0), (50, 10), (40, 10)], [(43, 3), (47, 3), (47, 7), (43, 7)]]),
    ], "name string")


def test_point_in_polygon_edges_overlaps_holes(spark):
    pts = spark.createDataFrame([
        (1, 2.0, 2.0), (2, 10.0, 3.0), (3, 0.0, 0.0), (4, 7.0, 7.0), (5, 25.0, 6.0),
        (6, 25.0, 1.0), (7, 45.0, 5.0), (8, 41.0, 5.0), (9, 100.0, 100.0), (10, 43.0, 5.0),
    ], "id int, x double, y double")
    last = dict(rows(G.tag_with_polygon(pts, _layer(spark), "x", "y", ["name"]), "id", "poly_id"))
    first = dict(rows(G.tag_with_polygon(pts, _layer(spark), "x", "y", [], pick="first"), "id", "poly_id"))
    assert last == {1: 1, 2: 1, 3: 1, 4: 2, 5: None, 6: 3, 7: None, 8: 4, 9: None, 10: 4}
    assert first[4] == 1
    clipped = {r[0] for r in G.clip(pts, _layer(spark), "x", "y").collect()}
    assert clipped == {k for k, v in last.items() if v is not None}


def test_spatial_plans_have_no_cross_join(spark):
    pts = spark.range(100).select(F.col("id").cast("double").alias("x"), F.col("id").cast("double").alias("y"))
    plan = G.clip(pts, _layer(spark), "x", "y")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_row_id_matches_global_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") % 97).alias("a"), F.col("id").alias("b"))
    got = W.add_row_id(df, ["a", "b"], num_partitions=7)
    exp = df.orderBy("a", "b").collect()
    got_sorted = got.orderBy("row_id").collect()
    assert [(r.a, r.b) for r in got_sorted] == [(r.a, r.b) for r in exp]
    assert [r.row_id for r in got_sorted] == list(range(1, 5001))


def test_row_id_with_adaptive_partition_count(spark):
    df = spark.range(0, 20000).select((F.col("id") * 7919 % 20000).alias("k"), F.col("id"))
    got = W.add_row_id(df, ["k"]).orderBy("row_id").collect()
    assert [r.k for r in got] == list(range(20000))
    assert [r.row_id for r in got] == list(range(1, 20001))


def test_batches_are_full_but_last(spark):
    df = spark.range(0, 2345).select(F.col("id"))
    sizes = dict(rows(W.add_batch(df, 1000, ["id"]).groupBy("group").count()))
    assert sizes == {1: 1000, 2: 1000, 3: 345}


def test_multi_occupancy(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0, "W1"), (2, 0.0, 0.0, "W2"), (3, 1.0, 1.0, "W1"),
                                (4, 2.0, 2.0, "W2"), (5, 2.0, 2.0, "W2"), (6, 2.0, 2.0, "W1")],
                               "id int, x double, y double, ward string")
    got = dict(rows(A.multi_occupancy(df, "x", "y", "ward", ["id"])))
    assert got == {"W1": 2, "W2": 3}


def test_tag_matrix_keeps_untagged(spark):
    df = spark.createDataFrame([(1, "a", "bowl street  bowl"), (2, "b", None), (3, "c", "x wood")],
                               "X int, name string, tags string")
    m = R.tag_matrix(df.drop("X"), "name", "tags", ["name"])
    assert set(m.columns) == {"name", "bowl", "street", "wood", "x"}
    got = {r["name"]: (r["bowl"], r["wood"]) for r in m.collect()}
    assert got == {"a": (1, None), "b": (None, None), "c": (None, 1)}


def test_html_noise_removed_and_tables(spark):
    html = ('<html><script>var t="</p><a href=\'/bad\'>";</script><!-- <a href="/gone"> -->'
            '<p>A &amp; B</p><a href="/x">x</a><table><tr><th>Borough</th><th>GOLD</th></tr>'
            '<tr><td>City &amp; Hackney</td><td>3</td></tr></table></html>')
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert rows(H.extract_links(pages, "page_id", "html"), "href") == [("/x",)]
    assert rows(H.extract_text(pages, "page_id", "html", "p"), "text") == [("A & B",)]
    cells = rows(H.extract_table(pages, "page_id", "html"), "row", "col", "text")
    assert cells == [(0, 0, "Borough"), (0, 1, "GOLD"), (1, 0, "City & Hackney"), (1, 1, "3")]


def test_release_gate(spark):
    from landframe.sources.release import releases_to_ingest
    rel = spark.createDataFrame([("r1", "Address Product", "3 April 2017"), ("r2", "Address Product", "3 April 2017"),
                                 ("r3", "Other", "3 April 2017"), ("r4", "Address Product", "2 April 2017")],
                                "release string, product string, update_date string")
    done = spark.createDataFrame([("r2",)], "release string")
    got = rows(releases_to_ingest(rel, dt.date(2017, 4, 3), "Address Product", done), "release")
    assert got == [("r1",)]


def test_no_python_udfs_in_any_query_plan(spark):
    from landframe.plans import QUERIES
    from tests.conftest import SF001
    for name in ["l1_address_clipped", "g3_tag", "j9_flag_any", "w1_add_count", "h7_kv_records", "r5_tag_matrix"]:
        plan = QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
        assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name
        assert "CartesianProduct" not in plan, name


def test_award_table_and_month_update(spark):
    from landframe.plans.pipelines import award_month_update, award_table
    rows_html = "".join(f"<tr><td>{b}</td><td>{n}</td><td>1</td><td>2</td><td>3</td></tr>"
                        for b, n in [("Total", 99), ("Kingston-upon-Thames", 5), ("City & Hackney", 7), ("Barnet", 4)])
    pages = spark.createDataFrame([(1, f"<table><tr><th>Borough</th></tr>{rows_html}</table>")], "page_id long, html string")
    t = award_table(pages, first_row=3, last_row=5)
    assert [tuple(r) for r in t.select("BOROUGH", "REGISTERED").collect()] == [
        ("Barnet", "4"), ("City and Hackney", "7"), ("Kingston upon Thames", "5")]
    reg = spark.createDataFrame([("Barnet", "1"), ("City and Hackney", "2")], "NAME string, MAR string")
    upd = award_month_update(reg, t, "APR")
    assert upd.columns == ["NAME", "MAR", "APR"]
    assert sorted(tuple(r) for r in upd.collect()) == [("Barnet", "1", "4"), ("City and Hackney", "2", "7")]


def test_schools_update_flags_any_key(spark):
    from landframe.plans.pipelines import schools_update
    reg = spark.createDataFrame([
        (1, "Alpha", "Camden", "N1 1AA", 10, 0, "02071234567", "Not applicable", 4, 11),
        (2, "Beta", "Barnet", "N2 2BB", 5, 5, "02079999999", "In special measures", 3, 7),
        (3, "Gamma", "Kingston upon Thames", "KT1 1CC", 8, 4, "02070000000", "Not in special measures", 11, 16),
        (4, "Delta", "Ealing", "W5 5DD", 1, 1, "02071111111", "Not applicable", 4, 11)],
        "URN int, EstablishmentName string, LAD11NM string, Postcode string, NumberOfBoys int, NumberOfGirls int, "
        "TelephoneNum string, OfstedSpecialMeasures__name_ string, StatutoryLowAge int, StatutoryHighAge int")
    prev = spark.createDataFrame([(1, "p"), (2, "p"), (3, "p"), (4, "p"), (5, "closed")], "URN int, Primary string")
    wf = spark.createDataFrame([(1, 20.5), (2, 18.0), (3, 17.0), (4, 16.0)], "URN int, `Pupil......Teacher.Ratio` double")
    healthy = spark.createDataFrame([
        ("x", "nowhere", "zz9 9zz", "\t1 "),          # URN match only
        ("y", "nowhere", "n2 2bb", "99"),             # postcode match only
        ("Gamma", "Kingston-upon-Thames", "", "98"),  # name + area match only
        ("q", "nowhere", "QQ1 1QQ", "97")],           # no match
        "School_name string, Borough_name string, Postcode string, URN string")
    schools, report = schools_update(reg, prev, wf, healthy, {"name": "School_name", "borough": "Borough_name",
                                                              "postcode": "Postcode", "urn": "URN"})
    got = {int(r["URN"]): (r["healthyschools_2017"], r["BoyGirl_R"], r["ofsted"], r["AGE"], r["Tele"])
           for r in schools.collect()}
    assert dict(schools.dtypes)["URN"] == "string" and "working" not in schools.columns
    assert got[5] == (0, None, None, "NA-NA", None) or got[5][0] == 0  # a school the register no longer has stays
    assert got[1] == (1, None, "2", "4-11", "0207 1234567")
    assert got[2][0] == 1 and got[3][0] == 1 and got[4][0] == 0
    assert got[3][1] == 2.0 and got[2][2] == "3"
    assert sorted(r["found"] for r in report.collect()) == [0, 1, 1, 1]


def test_national_grid_worked_example_and_round_trips(spark):
    lat = 52 + 39 / 60 + 27.2531 / 3600
    lon = 1 + 43 / 60 + 4.5177 / 3600
    df = spark.createDataFrame([(1, lon, lat)], "id int, x double, y double")
    grid = G.reproject(df, "x", "y", "EPSG:4277", "EPSG:27700").collect()[0]
    assert abs(grid.x - 651409.903) < 0.001 and abs(grid.y - 313177.270) < 0.001
    back = G.reproject(G.reproject(df, "x", "y", "EPSG:4277", "EPSG:27700"), "x", "y", "EPSG:27700", "EPSG:4277").collect()[0]
    assert abs(back.x - lon) < 1e-8 and abs(back.y - lat) < 1e-8
    w = spark.createDataFrame([(1, -0.1276, 51.5072)], "id int, x double, y double")
    bng = G.reproject(w, "x", "y", "EPSG:4326", "EPSG:27700").collect()[0]
    assert abs(bng.x - 530000) < 1000 and abs(bng.y - 180000) < 1000   # a point near the grid centre used by the tests
    rt = G.reproject(G.reproject(w, "x", "y", "EPSG:4326", "EPSG:27700"), "x", "y", "EPSG:27700", "EPSG:4326").collect()[0]
    assert abs(rt.x + 0.1276) < 1e-5 and abs(rt.y - 51.5072) < 1e-5
    same = G.reproject(df, "x", "y", "EPSG:27700", "EPSG:27700")
    assert same.collect()[0].x == lon and same.schema["x"].metadata == {"crs": "EPSG:27700"}


def test_planning_records_from_two_pages(spark):
    from landframe.plans.pipelines import planning_records

    def page(pairs):
        return "<table>" + "".join(f"<tr><td>{k}</td><td>{v}</td></tr>" for k, v in pairs) + "</table>"
    pages = spark.createDataFrame([
        (1, 10, page([("Reference", "17/0001"), ("Address", "1 High St")])),
        (1, 11, page([("Reference", "17/0001"), ("Decision", "Granted"), ("Decision", "Granted")])),
        (2, 20, page([("Reference", "17/0002"), ("Address", "2 Low Rd")])),
        (2, 21, page([("Reference", "17/0002"), ("Decision", "Refused")])),
        (3, 30, page([("Reference", "17/0001"), ("Address", "later copy")])),
        (4, 40, page([("Address", "no reference")])),
    ], "record_id long, page_id long, html string")
    got = {r["Reference"]: (r["record_id"], r["Address"], r["Decision"]) for r in planning_records(pages).collect()}
    # the latest record of a reference wins; one without a reference is kept
    assert got == {"17/0001": (3, "later copy", None), "17/0002": (2, "2 Low Rd", "Refused"), None: (4, "no reference", None)}
    alone = planning_records(pages.filter("record_id = 4")).collect()
    assert [(r["record_id"], r["Reference"]) for r in alone] == [(4, None)]


def test_map_layer_load_with_provenance(spark):
    import uuid
    from landframe.plans.pipelines import map_layer_load
    from landframe.session import checkpoint_dir
    root = f"{checkpoint_dir(spark).rstrip('/')}/test-layers-{uuid.uuid4().hex}"
    a = spark.createDataFrame([("osgb1", 10021, "Buildings")], "TOID string, FeatureCode int, Theme string")
    a.write.format("xml").option("rowTag", "TopographicArea").option("rootTag", "tile").save(f"{root}/in/a")
    a.write.format("xml").option("rowTag", "TopographicArea").option("rootTag", "tile").save(f"{root}/in/b")
    layers = map_layer_load(spark, [f"{root}/in/a", f"{root}/in/b"],
                            {"TopographicArea": "TOID string, FeatureCode int, Theme string"},
                            root=f"{root}/out", release="201704")
    df = layers["TopographicArea"]
    assert df.count() == 2 and df.select("file").distinct().count() == 2
    assert spark.read.parquet(f"{root}/out/TopographicArea").count() == 2


def test_publish_fans_out_and_gates(spark):
    import uuid
    from landframe.plans.pipelines import address_release, publish_address_release
    from landframe.session import checkpoint_dir
    raw = spark.createDataFrame(
        [(str(i), "" if i % 5 == 0 else str(i // 3), str(float(i % 40)), str(float(i % 30)) if i % 97 else "n/a")
         for i in range(1, 3001)], "UPRN string, PARENT_UPRN string, X_COORDINATE string, Y_COORDINATE string")
    layer = G.polygon_layer(spark, [(1, "b", [[(0, 0), (20, 0), (20, 20), (0, 20)]])], "name string")
    all_rows, clipped, rejected = address_release(raw, layer, "201704", [F.col("OBJECTID").cast("long")], batch_size=1000)
    assert rejected.count() == len([i for i in range(1, 3001) if i % 97 == 0])
    kept = [i for i in range(1, 3001) if i % 97]
    assert all_rows.filter("parent_uprn = '000000000000'").count() == len([i for i in kept if i % 5 == 0 or i // 3 == 0])
    # batches are numbered before rejects are set aside: 1000-row batches of the whole load
    per_batch = sorted(sum(1 for i in kept if (i - 1) // 1000 == b) for b in range(3))
    assert sorted(r[0] for r in all_rows.groupBy("group").count().select("count").collect()) == per_batch
    root = f"{checkpoint_dir(spark).rstrip('/')}/test-publish-{uuid.uuid4().hex}"
    status = {r.table: r for r in publish_address_release(all_rows, layer, root, "201704").collect()}
    assert status["clipped"].status == status["all"].status == "SUCCESSFUL"
    assert (status["all"].n_rows, status["clipped"].n_rows) == (all_rows.count(), clipped.count())
    # a later, too small release is judged by its own rows, and an empty one empties its partition
    few = all_rows.limit(5).withColumn("update_date", F.lit("201705"))
    late = {r.table: r for r in publish_address_release(few, layer, root, "201705").collect()}
    assert late["all"].n_rows == 5 and late["all"].status == late["clipped"].status == "FAILED"
    none = {r.table: r.n_rows for r in publish_address_release(few.limit(0), layer, root, "201705").collect()}
    assert none == {"all": 0, "clipped": 0}
    assert spark.read.parquet(f"{root}/all").count() == all_rows.count()


def test_award_table_is_cut_per_table(spark):
    from landframe.plans.pipelines import award_table
    html = "<table>" + "".join(f"<tr><td>b{i}</td><td>{i}</td><td>1</td><td>2</td><td>3</td></tr>" for i in range(40)) + "</table>"
    pages = spark.createDataFrame([(1, html), (2, html.replace(">b", ">c") + html.replace(">b", ">d"))], "page_id long, html string")
    got = {r["BOROUGH"] for r in award_table(pages).collect()}
    assert got == {f"{t}{i}" for t in "bcd" for i in range(1, 33)}


def test_repeats_among_ties(spark):
    from landframe.operators import window as W
    df = spark.createDataFrame([(1, 5, "a")] * 3 + [(1, 5, "b"), (2, None, "x"), (2, None, "x"), (None, 1, "n")], "k int, o int, v string")
    got = sorted((r.k, r.v) for r in W.find_repeats(df, ["k"], ["o"]).collect())
    assert got == [(1, "a"), (1, "a"), (1, "b"), (2, "x")]


def test_links_quotes_and_pairs_after_filtering(spark):
    from landframe.sources import pages as H
    html = """<a href="/o'brien/file">x</a><a class=z href='/say "hi"'>y</a><a href=/plain>z</a><a href="s">s</a><a href="/second/long">t</a>"""
    pages = spark.createDataFrame([(1, html)], "id int, html string")
    assert [r.href for r in H.extract_links(pages, "id", "html").collect()] == ["/o'brien/file", '/say "hi"', "/plain", "s", "/second/long"]
    names = spark.createDataFrame([(1, i, f"n{i}") for i in range(4)], "id int, pos int, name string")
    pairs = H.zip_pairs(names, H.filter_links(pages, "id", "html", 3), "id").orderBy("pos").collect()
    assert [(r.name, r.href) for r in pairs] == [("n0", "/o'brien/file"), ("n1", '/say "hi"'), ("n2", "/plain"), ("n3", "/second/long")]
    split = H.split_names(spark.createDataFrame([(1, "a b-c\r\n  \td ")], "id int, t string"), "id", "t").collect()
    assert [r.name for r in split] == ["ab_c", "d"]


def test_plain_number_keeps_all_digits(spark):
    from landframe.functions import plain_number
    df = spark.createDataFrame([(12.75,), (1e12,), (0.5,), (-3.0,), (100.0,), (None,)], "x double")
    assert [r[0] for r in df.select(plain_number("x")).collect()] == ["12.75", "1000000000000", "0.5", "-3", "100", None]


def test_areas_without_data_stay(spark):
    from landframe.plans.pipelines import flats_by_area, population_change
    wide = spark.createDataFrame([("a", 1.0, 3.0)], "area string, `2016` double, `2050` double")
    areas = spark.createDataFrame([("a", "A"), ("b", "B")], "code string, name string")
    got = {r["code"]: r["change"] for r in population_change(wide, ["area"], "area", "2016", "2050", areas, "code").collect()}
    assert got == {"a": 2.0, "b": None}
    # flats are counted under the code their first address carries, not the polygon it lies in
    layer = G.polygon_layer(spark, [(1, "one", [[(0, 0), (9, 0), (9, 9), (0, 9)]]), (2, "two", [[(20, 0), (29, 0), (29, 9), (20, 9)]])], "name string")
    pts = spark.createDataFrame([(1, 5.0, 5.0, 2), (2, 5.0, 5.0, 1), (3, 50.0, 5.0, 1), (4, 50.0, 5.0, 1)], "id int, x double, y double, ward_code long")
    assert [tuple(r) for r in flats_by_area(pts, layer, "x", "y", ["id"]).collect()] == [(2, "two", 2)]


def test_profile_is_bounded(spark):
    df = spark.range(100).withColumn("t", F.lit("x"))
    p = FL.profile(df, 3)
    assert len(p["head"]) == 3 and p["rows"] == 100 and p["dtypes"] == [("id", "bigint"), ("t", "string")]


def test_mixed_polygon_sizes_use_levels(spark):
    big = [(0, 0), (10000, 0), (10000, 10000), (0, 10000)]
    rows = [(1, "big", [big])] + [(2 + i, f"s{i}", [[(i * 3, 5), (i * 3 + 1, 5), (i * 3 + 1, 6), (i * 3, 6)]])
                                  for i in range(30)]
    layer = G.polygon_layer(spark, rows, "name string")
    base, least, levels, bc = G._plan_grid(layer, None, 64 << 20)
    assert (base, least, levels, bc) == (10000.0, 1.0, [0, 6], True)
    cells = G.polygon_cells(layer, base, least)
    assert cells.select(F.max(F.size("cands"))).first()[0] <= 4      # no cell gathers the small polygons
    assert cells.count() <= 4 * 31
    pts = spark.createDataFrame([(1, 3.5, 5.5), (2, 500.0, 500.0), (3, 20000.0, 1.0)], "id int, x double, y double")
    got = dict(rows_of(G.tag_with_polygon(pts, layer, "x", "y", ["name"])))
    assert got == {1: "s1", 2: "big", 3: None}


def rows_of(df):
    return [(r["id"], r["name"]) for r in df.collect()]


def test_load_status_outcomes(spark):
    from landframe.operators.quality import load_status
    none = spark.range(0)
    assert load_status(none, spark.range(5000), "t").first().status == "NO UPDATE"
    assert load_status(spark.range(2), spark.range(5000), "t").first().status == "SUCCESSFUL"
    assert load_status(spark.range(2), spark.range(10), "t").first().status == "FAILED"


def test_boundary_points_can_be_outside(spark):
    pts = spark.createDataFrame([(1, 5.0, 5.0), (2, 10.0, 3.0), (3, 0.0, 0.0), (4, 43.0, 5.0)], "id int, x double, y double")
    strict = dict(rows(G.tag_with_polygon(pts, _layer(spark), "x", "y", [], boundary_inside=False), "id", "poly_id"))
    # (5,5): strictly inside the square, only a corner of polygon 2; (10,3): on the square's
    # edge; (0,0): a vertex; (43,5): on the edge of polygon 4's hole
    assert strict == {1: 1, 2: None, 3: None, 4: None}
    clipped = {r.id for r in G.clip(pts, _layer(spark), "x", "y", boundary_inside=False).collect()}
    assert clipped == {1}


def test_layer_stats_are_per_layer(spark):
    small = G.polygon_layer(spark, [(1, "s", [[(0, 0), (1, 0), (1, 1), (0, 1)]])], "name string")
    big = G.polygon_layer(spark, [(1, "b", [[(0, 0), (500, 0), (500, 500), (0, 500)]])], "name string")
    assert G.layer_stats(small)["hi"] == 1.0 and G.layer_stats(big)["hi"] == 500.0
    # a frame derived from a literal layer computes its stats with a job, same answer
    assert G.layer_stats(big.drop("name")) == G.layer_stats(big)
    pts = spark.createDataFrame([(1, 250.0, 250.0), (2, 0.5, 0.5)], "id int, x double, y double")
    assert dict(rows(G.tag_with_polygon(pts, big, "x", "y", ["name"]), "id", "name")) == {1: "b", 2: "b"}
    assert dict(rows(G.tag_with_polygon(pts, small, "x", "y", ["name"]), "id", "name")) == {1: None, 2: "s"}


def test_degenerate_polygon_with_given_cell_size(spark):
    layer = G.polygon_layer(spark, [(1, "dot", [[(3, 3), (3, 3), (3, 3)]]),
                                    (2, "sq", [[(10, 10), (20, 10), (20, 20), (10, 20)]])], "name string")
    pts = spark.createDataFrame([(1, 3.0, 3.0), (2, 15.0, 15.0), (3, 4.0, 4.0)], "id int, x double, y double")
    got = dict(rows(G.tag_with_polygon(pts, layer, "x", "y", ["name"], cell_size=0.5), "id", "name"))
    assert got == {1: "dot", 2: "sq", 3: None}
