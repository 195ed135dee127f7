"""Registered end-to-end queries (L-series) over the driver's tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from landframe.operators.filters import POSTCODE_PATTERN
from landframe.operators.window import add_row_id
from landframe.plans import pipelines as P
from landframe.plans import standins as S
from landframe.plans.q_functions import _DATE_TEXT_SQL, _POSTCODE_SQL, _date_text, _postcode
from landframe.plans.q_spatial import _HITS_SQL, _names_sql, polygons
from landframe.plans.registry import register
from landframe.plans.tables import table
from landframe.session import checkpoint_dir
from landframe.sources.files import lookup
from landframe.sources.pages import extract_table


@register("l4_period_change", sql="""
WITH w AS (
  SELECT c.c_nationkey AS area, year(o.o_orderdate) AS yr,
         CAST(o.o_totalprice AS DECIMAL(18,2)) AS v
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
s AS (
  SELECT area,
         SUM(CASE WHEN yr = 1996 THEN v ELSE 0 END) AS y0,
         SUM(CASE WHEN yr = 2000 THEN v ELSE 0 END) AS y1
  FROM w GROUP BY area)
SELECT n.n_nationkey, n.n_name, n.n_regionkey,
       CAST(s.y0 AS DOUBLE) AS Y1996, CAST(s.y1 AS DOUBLE) AS Y2000,
       CAST(s.y1 - s.y0 AS DOUBLE) AS change
FROM nation n LEFT JOIN s ON n.n_nationkey = s.area
""")
def l4_period_change(spark, sf_dir):
    """L4: order value per nation, 1996 vs 2000, from a wide per-year table."""
    wide = S.population_wide(spark, sf_dir)
    res = P.population_change(wide, ["area", "district", "age"], "area", "1996", "2000",
                              areas=table(spark, sf_dir, "nation"), area_key="n_nationkey")
    return res.select("n_nationkey", "n_name", "n_regionkey",
                      *[F.col(c).cast("double").alias(c) for c in ("Y1996", "Y2000", "change")])


# --------------------------------------------------------------------------- shared stand-ins


def _address_raw(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("string").alias("UPRN"),
                     F.col("l_orderkey").cast("string").alias("PARENT_UPRN"),
                     F.col("l_quantity").cast("string").alias("X_COORDINATE"),
                     F.col("l_suppkey").cast("string").alias("Y_COORDINATE"))


def _pad_sql(c: str) -> str:
    return f"CASE WHEN length({c}) >= 12 THEN {c} ELSE lpad({c}, 12, '0') END"


@register("l1_address_clipped", sql=f"""
WITH {_HITS_SQL},
a AS (SELECT CAST(l_orderkey * 8 + l_linenumber AS VARCHAR) AS objectid, l_orderkey * 8 + l_linenumber AS k,
             CAST(l_orderkey AS VARCHAR) AS parent,
             CAST(l_quantity AS DOUBLE) AS x, CAST(l_suppkey AS DOUBLE) AS y FROM lineitem),
b AS (SELECT *, count(*) OVER (PARTITION BY x, y) AS flat,
             CAST(ceil(row_number() OVER (ORDER BY k) / 100000) AS BIGINT) AS grp FROM a)
SELECT objectid, {_pad_sql('objectid')} AS uprn, {_pad_sql('parent')} AS parent_uprn,
       round_even(x, 2) AS x_coordinate, round_even(y, 2) AS y_coordinate,
       flat, '201704' AS update_date, grp AS "group"
FROM b WHERE (x, y) IN (SELECT (px, py) FROM hits)
""")
def l1_address_clipped(spark, sf_dir):
    """L1: address release shaped (ids, coordinates, flat counts, batches) and clipped."""
    raw = _address_raw(spark, sf_dir)
    _all, clipped, _rej = P.address_release(raw, polygons(spark), "201704",
                                            order_by=[F.col("OBJECTID").cast("long")])
    return clipped.select("objectid", "uprn", "parent_uprn", "x_coordinate", "y_coordinate",
                          "flat", "update_date", "group")


@register("l2_building_heights", sql="""
WITH h AS (
  SELECT CAST(l_partkey AS VARCHAR) AS TOID,
         CASE l_returnflag WHEN 'A' THEN 'TQ' WHEN 'N' THEN 'TL' ELSE 'SU' END || l_linestatus AS TileRef,
         strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS pdate, l_quantity AS RelH2,
         l_orderkey * 8 + l_linenumber AS ROW_REF
  FROM lineitem),
r AS (
  SELECT *, row_number() OVER (PARTITION BY TOID ORDER BY pdate, ROW_REF) AS rn,
         count(*) OVER (PARTITION BY TOID) AS match_count
  FROM h WHERE contains(TileRef, 'TQ') OR contains(TileRef, 'TL'))
SELECT r.TOID, p.p_size AS FeatureCode, 'Buildings' AS Theme, r.TileRef,
       strftime(strptime(r.pdate, '%Y-%m-%d %H:%M:%S'), '%Y%m%d%H%M%S') AS BHA_ProcessDate,
       r.RelH2 AS height_rel, r.ROW_REF, r.match_count
FROM part p JOIN r ON CAST(p.p_partkey AS VARCHAR) = r.TOID AND r.rn = 1
WHERE p.p_type = 'ECONOMY'
""")
def l2_building_heights(spark, sf_dir):
    """L2: building heights (tile filter, key repair, first match + count, date format)
    attached to the 'Buildings' features of a layer."""
    layer, heights = _height_inputs(spark, sf_dir)
    return P.building_heights(layer, heights, order_by=["BHA_ProcessDate", "ROW_REF"],
                              renames={"RelH2": "height_rel", "NotThere": "x"})


@register("l2_every_height", sql="""
SELECT CAST(p_partkey AS VARCHAR) AS TOID, p_size AS FeatureCode, strftime(l_shipdate, '%Y%m%d') || '000000' AS BHA_ProcessDate,
       l_quantity AS height_rel, l_orderkey * 8 + l_linenumber AS ROW_REF
FROM part JOIN lineitem ON l_partkey = p_partkey WHERE p_type = 'ECONOMY' AND l_returnflag IN ('A', 'N')
""")
def l2_every_height(spark, sf_dir):
    """L2, one to many: every feature repeated for each of its height rows."""
    layer, heights = _height_inputs(spark, sf_dir)
    out = P.building_heights(layer, heights, renames={"RelH2": "height_rel"}, every_match=True)
    return out.select("TOID", "FeatureCode", "BHA_ProcessDate", "height_rel", "ROW_REF")


def _height_inputs(spark, sf_dir):
    """A layer with plain ids and heights whose ids carry the ``osgb`` prefix."""
    p = table(spark, sf_dir, "part")
    layer = p.select(F.col("p_partkey").cast("string").alias("TOID"),
                     F.col("p_size").alias("FeatureCode"),
                     F.when(F.col("p_type") == "ECONOMY", F.lit("Buildings")).otherwise(F.col("p_type")).alias("Theme"))
    li = table(spark, sf_dir, "lineitem")
    tile = (F.when(F.col("l_returnflag") == "A", F.lit("TQ")).when(F.col("l_returnflag") == "N", F.lit("TL"))
            .otherwise(F.lit("SU")))
    heights = li.select(F.concat(F.lit("osgb"), F.col("l_partkey").cast("string")).alias("OS_TOPO_TOID"),
                        F.concat(tile, F.col("l_linestatus")).alias("TileRef"),
                        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("BHA_ProcessDate"),
                        F.col("l_quantity").alias("RelH2"),
                        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("ROW_REF"))
    return layer, heights


def _points(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("x"),
                     F.col("l_suppkey").cast("double").alias("y"), "l_returnflag")


@register("l5_flats_by_area", sql=f"""
WITH {_HITS_SQL},
names(poly_id, name) AS (VALUES {_names_sql()}),
t AS (SELECT CAST(l_quantity AS DOUBLE) AS x, CAST(l_suppkey AS DOUBLE) AS y, l_orderkey, l_linenumber,
             l_partkey % 6 + 1 AS ward_code
      FROM lineitem WHERE (CAST(l_quantity AS DOUBLE), CAST(l_suppkey AS DOUBLE)) IN (SELECT (px, py) FROM hits)),
xy AS (SELECT x, y, count(*) AS flat, arg_min(ward_code, (l_orderkey, l_linenumber)) AS poly_id FROM t GROUP BY x, y)
SELECT CAST(n.poly_id AS BIGINT) AS poly_id, n.name, CAST(sum(flat) AS BIGINT) AS total_flats
FROM xy JOIN names n ON xy.poly_id = n.poly_id
WHERE flat > 1 GROUP BY n.poly_id, n.name
""")
def l5_flats_by_area(spark, sf_dir):
    """Addresses sharing a coordinate, clipped to the areas and counted per area code of
    their first address (codes that differ from the polygon, some without an area)."""
    li = table(spark, sf_dir, "lineitem")
    pts = li.select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("x"), F.col("l_suppkey").cast("double").alias("y"),
                    (F.col("l_partkey") % 6 + 1).cast("long").alias("ward_code"))
    return P.flats_by_area(pts, polygons(spark), "x", "y", ["l_orderkey", "l_linenumber"])


# The sub-area names looked up by polygon ordinal (polygon 4 has none).
SUB_AREAS = [(1, "Sub-area A"), (2, "Sub-area B"), (3, "Sub-area C"), (5, "Sub-area E")]


@register("l8_postcodes_in_subareas", sql=f"""
WITH {_HITS_SQL},
sub(poly_id, Sub_Area) AS (VALUES {", ".join(f"({k}, '{v}')" for k, v in SUB_AREAS)}),
best AS (SELECT px, py, max(poly_id) AS poly_id FROM hits GROUP BY px, py)
SELECT 'P' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS POSTCODE,
       l_returnflag AS DISTRICT_NAME, s.Sub_Area
FROM lineitem
JOIN best b ON CAST(l_quantity AS DOUBLE) = b.px AND CAST(l_suppkey AS DOUBLE) = b.py
JOIN sub s ON s.poly_id = b.poly_id
""")
def l8_postcodes_in_subareas(spark, sf_dir):
    """Postcode points tagged with the sub-area polygon containing them."""
    pts = _points(spark, sf_dir).select(
        F.concat(F.lit("P"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
        .alias("POSTCODE"), F.col("l_returnflag").alias("DISTRICT_NAME"), "x", "y")
    names = lookup(spark, SUB_AREAS, T.StructType([T.StructField("poly_id", T.LongType()),
                                                   T.StructField("Sub_Area", T.StringType())]))
    return P.postcodes_in_subareas(pts, polygons(spark).drop("name"), names, "x", "y", ["POSTCODE", "DISTRICT_NAME"])


def _planning_records(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey)
    start = F.date_format("o_orderdate", "yyyyMMdd").cast("int")
    done = F.when(F.col("o_orderstatus") == "O", F.lit(0)).otherwise(start + 10000)
    return j.select(F.col("o_orderkey").alias("Ptno"), _postcode(None).alias("Pcode"),
                    start.alias("Start_date"), done.alias("Completion_date"))


_PLANNING_SQL = f"""
WITH rec AS (
  SELECT o_orderkey AS Ptno, {_POSTCODE_SQL} AS Pcode,
         CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS Start_date,
         CASE WHEN o_orderstatus = 'O' THEN 0 ELSE CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) + 10000 END AS Completion_date
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

@register("l7_valid_postcodes", sql=_PLANNING_SQL + """
SELECT Ptno, Pcode FROM rec WHERE regexp_matches(Pcode, '{pat}')
""".replace("{pat}", POSTCODE_PATTERN))
def l7_valid_postcodes(spark, sf_dir):
    """Planning records with a valid postcode."""
    valid, _m, _d = P.postcode_quality(_planning_records(spark, sf_dir), "Ptno", "Pcode", "Start_date", "Completion_date")
    return valid.select("Ptno", "Pcode")


@register("l7_missing_valid", sql=_PLANNING_SQL + """
SELECT Ptno, Pcode FROM rec r WHERE NOT EXISTS (
  SELECT 1 FROM rec v WHERE regexp_matches(v.Pcode, '{pat}') AND v.Ptno = r.Ptno)
""".replace("{pat}", POSTCODE_PATTERN))
def l7_missing_valid(spark, sf_dir):
    """Records whose id has no valid-postcode record (anti join)."""
    _v, missing, _d = P.postcode_quality(_planning_records(spark, sf_dir), "Ptno", "Pcode", "Start_date", "Completion_date")
    return missing.select("Ptno", "Pcode")


@register("l7_durations", sql=_PLANNING_SQL + """
SELECT Ptno, Completion_date - Start_date AS duration,
       'ldd' || CAST(row_number() OVER (ORDER BY Ptno) AS VARCHAR) AS lddid
FROM rec WHERE Start_date > 0 AND Completion_date > 0
""")
def l7_durations(spark, sf_dir):
    """Build durations of records with both dates, numbered ``ldd1, ldd2, ...``."""
    _v, _m, durations = P.postcode_quality(_planning_records(spark, sf_dir), "Ptno", "Pcode", "Start_date",
                                           "Completion_date")
    numbered = add_row_id(durations.select("Ptno", "duration"), ["Ptno"], out="lddid", prefix="ldd")
    return numbered


# The positional names applied to the raw address extract of the graph.
GRAPH_NAMES = ["UPRN", "PARENT_UPRN", "STATE_DATE", "X_COORDINATE", "Y_COORDINATE"]


def _graph_raw(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    ytext = F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).otherwise(F.col("o_custkey").cast("string"))
    return o.select(F.col("o_orderkey").cast("string").alias("V1"), F.col("o_custkey").cast("string").alias("V2"),
                    _date_text(o).alias("V3"), F.col("o_totalprice").cast("string").alias("V4"), ytext.alias("V5"))


_GRAPH_SQL = f"""
WITH g AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS objectid, CAST(o_custkey AS VARCHAR) AS parent, {_DATE_TEXT_SQL} AS dtext,
         o_totalprice AS px, TRY_CAST(CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS DOUBLE) AS py
  FROM orders)"""


@register("l12_address_graph", sql=_GRAPH_SQL + f"""
SELECT objectid, {_pad_sql('objectid')} AS uprn, {_pad_sql('parent')} AS parent_uprn,
       coalesce(strftime(coalesce(
           try_strptime(dtext, '%Y-%m-%d'), try_strptime(dtext, '%Y%m%d'),
           try_strptime(dtext, '%d/%m/%Y'), try_strptime(dtext, '%d %B %Y')), '%Y%m%d'), dtext) AS state_date,
       px, py
FROM g WHERE py IS NOT NULL
""")
def l12_address_graph(spark, sf_dir):
    """The address graph's features (named, ids padded, dates normalised, points)."""
    ok, _rej = P.address_graph(_graph_raw(spark, sf_dir), GRAPH_NAMES, ["STATE_DATE"])
    return ok.select("objectid", "uprn", "parent_uprn", "state_date", "px", "py")


@register("l12_typed_features", sql=_GRAPH_SQL + f"""
SELECT objectid, {_pad_sql('objectid')} AS uprn, CAST(coalesce(
           try_strptime(dtext, '%Y-%m-%d'), try_strptime(dtext, '%Y%m%d'),
           try_strptime(dtext, '%d/%m/%Y'), try_strptime(dtext, '%d %B %Y')) AS DATE) AS state_date,
       px AS x_coordinate, py AS y_coordinate
FROM g WHERE py IS NOT NULL
""")
def l12_typed_features(spark, sf_dir):
    """The address graph's features in the database table's types."""
    ok, _rej = P.address_graph(_graph_raw(spark, sf_dir), GRAPH_NAMES, ["STATE_DATE"], typed=True)
    return ok.select("objectid", "uprn", "state_date", "x_coordinate", "y_coordinate")


@register("l12_rejected", sql=_GRAPH_SQL + """
SELECT objectid FROM g WHERE py IS NULL
""")
def l12_rejected(spark, sf_dir):
    """The graph's reject output (coordinates that are not numbers)."""
    _ok, rej = P.address_graph(_graph_raw(spark, sf_dir), GRAPH_NAMES, ["STATE_DATE"])
    return rej.select("objectid")


@register("l9_school_repeats", sql="""
SELECT c_custkey, c_mktsegment, c_nationkey, uniqschool FROM (
  SELECT c_custkey, c_mktsegment, c_nationkey, c_mktsegment || ' ' || CAST(c_nationkey AS VARCHAR) AS uniqschool,
         row_number() OVER (PARTITION BY c_mktsegment || ' ' || CAST(c_nationkey AS VARCHAR) ORDER BY c_custkey) AS rn
  FROM customer) WHERE rn > 1
""")
def l9_school_repeats(spark, sf_dir):
    """Repeated (school name, borough) rows of a report; customers' segment and
    nation stand in for school and borough."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    return P.school_repeats(c, "c_mktsegment", "c_nationkey", ["c_custkey"])


# --------------------------------------------------------------------------- L3

_SEG_OFSTED = """CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Not in special measures'
  WHEN 'BUILDING' THEN 'Not applicable' WHEN 'FURNITURE' THEN 'In special measures' ELSE 'Other' END"""


def _school_inputs(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cn = c.join(n, c.c_nationkey == n.n_nationkey)
    seg = F.col("c_mktsegment")
    ofsted = (F.when(seg == "AUTOMOBILE", "Not in special measures").when(seg == "BUILDING", "Not applicable")
              .when(seg == "FURNITURE", "In special measures").otherwise("Other"))
    la = F.replace(F.col("n_name"), F.lit("_"), F.lit(" "))
    register = cn.select(
        F.col("c_custkey").alias("URN"), F.col("c_name").alias("EstablishmentName"), la.alias("LAD11NM"),
        _postcode(None).alias("Postcode"), F.col("c_nationkey").alias("NumberOfBoys"),
        (F.col("c_nationkey") % 4).alias("NumberOfGirls"),
        F.lpad(F.col("c_custkey").cast("string"), 11, "0").alias("TelephoneNum"),
        ofsted.alias("OfstedSpecialMeasures__name_"),
        F.col("c_nationkey").alias("StatutoryLowAge"), (F.col("c_nationkey") + 7).alias("StatutoryHighAge"))
    # the previous table also has a closed school for each open one, in no other table
    previous = c.select(F.explode(F.array(F.col("c_custkey"), F.col("c_custkey") + 10_000_000)).alias("URN"), seg.alias("Primary"))
    workforce = c.select(F.col("c_custkey").alias("URN"),
                         (F.col("c_acctbal") / 100).alias("Pupil......Teacher.Ratio"))
    urn_text = F.when(seg == "AUTOMOBILE", F.concat(F.lit("\t"), F.col("c_custkey").cast("string"), F.lit(" "))) \
        .otherwise(F.concat(F.lit("u"), F.col("c_custkey").cast("string")))
    post = F.when(seg == "BUILDING", F.lower(_postcode(None))).otherwise(F.lit("ZZ9 9ZZ"))
    borough = F.when(seg == "FURNITURE", F.replace(F.col("n_name"), F.lit("_"), F.lit("-"))).otherwise(F.lit("elsewhere"))
    healthy = cn.select(F.col("c_name").alias("School_name"), borough.alias("Borough_name"),
                        post.alias("Postcode"), urn_text.alias("URN"))
    return register, previous, workforce, healthy


_L3_SQL = f"""
WITH cn AS (SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey),
reg AS (
  SELECT c_custkey AS URN, c_name AS SCHOOL_NAME, replace(n_name, '_', ' ') AS LA_NAME, {_POSTCODE_SQL} AS POSTCODE,
         CAST(c_nationkey AS VARCHAR) || '-' || CAST(c_nationkey + 7 AS VARCHAR) AS AGE,
         round_even(CAST(CAST(CAST(c_nationkey AS DOUBLE) / nullif(CAST(c_nationkey % 4 AS DOUBLE), 0) AS VARCHAR) AS DECIMAL(38,20)), 4) AS BoyGirl_R,
         substr(lpad(CAST(c_custkey AS VARCHAR), 11, '0'), 1, 4) || ' ' || substr(lpad(CAST(c_custkey AS VARCHAR), 11, '0'), 5, 7) AS Tele,
         replace(replace(replace({_SEG_OFSTED}, 'Not in special measures', '1'), 'Not applicable', '2'), 'In special measures', '3') AS ofsted
  FROM cn),
sch AS (
  SELECT p.URN, r.* EXCLUDE (URN), p."Primary", w.c_acctbal / 100 AS PupilTeach_R,
         coalesce(r.SCHOOL_NAME, 'NA') || ' ' || coalesce(r.LA_NAME, 'NA') AS working
  FROM (SELECT c_custkey AS URN, c_mktsegment AS "Primary" FROM customer
        UNION ALL SELECT c_custkey + 10000000, c_mktsegment FROM customer) p
  LEFT JOIN reg r ON p.URN = r.URN LEFT JOIN customer w ON w.c_custkey = p.URN),
hl AS (
  SELECT CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN chr(9) || CAST(c_custkey AS VARCHAR) || ' ' ELSE 'u' || CAST(c_custkey AS VARCHAR) END AS urn_text,
         CASE WHEN c_mktsegment = 'BUILDING' THEN lower({_POSTCODE_SQL}) ELSE 'ZZ9 9ZZ' END AS pc,
         c_name || ' ' || replace(CASE WHEN c_mktsegment = 'FURNITURE' THEN replace(n_name, '_', '-') ELSE 'elsewhere' END, '-', ' ') AS working
  FROM cn),
hk AS (SELECT regexp_replace(urn_text, '^[ \\t\\r\\n]+|[ \\t\\r\\n]+$', '', 'g') AS k_urn,
              upper(replace(pc, ' ', '')) AS k_pc, working AS k_work FROM hl)"""


@register("l3_schools_update", sql=_L3_SQL + """
SELECT CAST(URN AS VARCHAR) AS URN, SCHOOL_NAME, LA_NAME, POSTCODE, AGE, CAST(BoyGirl_R AS DOUBLE) AS BoyGirl_R, Tele, ofsted,
       "Primary", PupilTeach_R,
       CASE WHEN CAST(URN AS VARCHAR) IN (SELECT k_urn FROM hk)
              OR replace(POSTCODE, ' ', '') IN (SELECT k_pc FROM hk)
              OR working IN (SELECT k_work FROM hk) THEN 1 ELSE 0 END AS healthyschools_2017
FROM sch
""")
def l3_schools_update(spark, sf_dir):
    """L3: schools refreshed from the register (renames, derived fields, merges with the
    previous and workforce tables) and flagged when any of URN / postcode / name+area
    occurs in the programme report."""
    register_, previous, workforce, healthy = _school_inputs(spark, sf_dir)
    schools, _report = P.schools_update(register_, previous, workforce, healthy,
                                        {"name": "School_name", "borough": "Borough_name",
                                         "postcode": "Postcode", "urn": "URN"},
                                        output=["URN", "SCHOOL_NAME", "LA_NAME", "POSTCODE", "AGE", "BoyGirl_R", "Tele",
                                                "ofsted", "Primary", "PupilTeach_R", "healthyschools_2017"])
    return schools


@register("l3_report_found", sql=_L3_SQL + """
SELECT k_urn AS URN, CASE WHEN k_urn IN (SELECT CAST(URN AS VARCHAR) FROM sch)
              OR k_pc IN (SELECT replace(POSTCODE, ' ', '') FROM sch)
              OR k_work IN (SELECT working FROM sch) THEN 1 ELSE 0 END AS found
FROM hk
""")
def l3_report_found(spark, sf_dir):
    """L3: the programme report flagged when any of its keys occurs among the schools."""
    register_, previous, workforce, healthy = _school_inputs(spark, sf_dir)
    _schools, report = P.schools_update(register_, previous, workforce, healthy,
                                        {"name": "School_name", "borough": "Borough_name",
                                         "postcode": "Postcode", "urn": "URN"})
    from landframe.functions import trim_ws
    return report.select(trim_ws("URN").alias("URN"), "found")


# --------------------------------------------------------------------------- L1 publishing


@register("l1_publish_status", sql=f"""
WITH {_HITS_SQL},
first_load AS (SELECT CAST(l_quantity AS DOUBLE) AS x, CAST(l_suppkey AS DOUBLE) AS y FROM lineitem),
second_load AS (SELECT CAST(n_regionkey AS DOUBLE) AS x, CAST(n_nationkey AS DOUBLE) AS y FROM nation),
loads AS (SELECT '201703' AS release, * FROM first_load UNION ALL SELECT '201704', * FROM second_load),
n AS (SELECT release, 'addresses' AS "table", count(*) AS n_rows FROM loads GROUP BY release
      UNION ALL SELECT r.release, 'addresses_clipped', count(x) FROM (VALUES ('201703'), ('201704')) r(release)
      LEFT JOIN (SELECT * FROM loads WHERE CASE WHEN release = '201704' THEN x BETWEEN 0 AND 20 AND y BETWEEN 0 AND 40  -- all in the square
        ELSE (x, y) IN (SELECT (px, py) FROM hits) END) l ON l.release = r.release GROUP BY r.release)
SELECT release, "table", n_rows, TRUE AS present, CASE WHEN n_rows > 1000 THEN 'SUCCESSFUL' ELSE 'FAILED' END AS status FROM n
""")
def l1_publish_status(spark, sf_dir):
    """Two releases shaped and published one after the other, each with its own
    status rows; the second is too small whatever the first left in the folder."""
    root = f"{checkpoint_dir(spark)}/landframe-io/publish-{uuid.uuid4().hex}"
    s = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("UPRN"), F.col("n_nationkey").cast("string").alias("PARENT_UPRN"),
        F.col("n_regionkey").cast("string").alias("X_COORDINATE"), F.col("n_nationkey").cast("string").alias("Y_COORDINATE"))
    out = None
    for release, raw in (("201703", _address_raw(spark, sf_dir)), ("201704", s)):
        rows, _clipped, _rejected = P.address_release(raw, polygons(spark), release, order_by=[], batch_size=None)
        status = P.publish_address_release(rows, polygons(spark), root, release, tables=("addresses", "addresses_clipped"))
        status = status.withColumn("release", F.lit(release))
        out = status if out is None else out.unionByName(status)
    return out


# --------------------------------------------------------------------------- L9 / L10 pages


def _html_row(*cells):
    return F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), c.cast("string"), F.lit("</td>")) for c in cells], F.lit("</tr>\n"))


# Borough spellings that the award table corrects, by nation number
SPELLINGS = {1: "City & Hackney", 2: "Kingston-upon-Thames", 3: "Richmond-upon-Thames"}


def _award_pages(spark, sf_dir):
    """One page with one award table for every 40 suppliers: the table's rows in supplier order."""
    s = table(spark, sf_dir, "supplier")
    name = F.col("s_name")
    for k, spelling in SPELLINGS.items():
        name = F.when(F.col("s_nationkey") == k, F.lit(spelling.replace("&", "&amp;"))).otherwise(name)
    row = _html_row(name, F.col("s_suppkey"), F.col("s_nationkey"), F.col("s_nationkey") + 1, F.col("s_nationkey") + 2)
    pages = s.select(F.floor(F.col("s_suppkey") / 40).alias("page_id"), F.struct("s_suppkey", row.alias("html")).alias("r"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["html"]), "")
    return pages.groupBy("page_id").agg(F.concat(F.lit("<html><table class='awards'>"), body, F.lit("</table></html>")).alias("html"))


_AWARDS_SQL = """
WITH a AS (
  SELECT s_suppkey // 40 AS page_id, row_number() OVER (PARTITION BY s_suppkey // 40 ORDER BY s_suppkey) AS pos, s_suppkey, s_nationkey,
         CASE s_nationkey WHEN 1 THEN 'City & Hackney' WHEN 2 THEN 'Kingston-upon-Thames' WHEN 3 THEN 'Richmond-upon-Thames' ELSE s_name END AS name
  FROM supplier)"""


@register("l9_award_table", sql=_AWARDS_SQL + """
SELECT CASE s_nationkey WHEN 1 THEN 'City and Hackney' WHEN 2 THEN 'Kingston upon Thames' WHEN 3 THEN 'Richmond upon Thames' ELSE name END AS BOROUGH,
       CAST(s_suppkey AS VARCHAR) AS REGISTERED, CAST(s_nationkey AS VARCHAR) AS BRONZE,
       CAST(s_nationkey + 1 AS VARCHAR) AS SILVER, CAST(s_nationkey + 2 AS VARCHAR) AS GOLD
FROM a WHERE pos BETWEEN 2 AND 33
""")
def l9_award_table(spark, sf_dir):
    """The award table of every page, rows 2 to 33 of each, spellings corrected."""
    return P.award_table(_award_pages(spark, sf_dir))


@register("h6_award_cells", sql=_AWARDS_SQL + """
SELECT page_id, 0 AS tbl, CAST(pos - 1 AS INTEGER) AS "row", CAST(col AS INTEGER) AS col,
       [name, CAST(s_suppkey AS VARCHAR), CAST(s_nationkey AS VARCHAR), CAST(s_nationkey + 1 AS VARCHAR), CAST(s_nationkey + 2 AS VARCHAR)][col + 1] AS text
FROM a, range(5) t(col)
""")
def h6_award_cells(spark, sf_dir):
    """H6: every cell of the award pages' tables."""
    return extract_table(_award_pages(spark, sf_dir), "page_id", "html")


@register("l9_month_update", sql=_AWARDS_SQL + """
SELECT name AS NAME, CAST(s_nationkey AS VARCHAR) AS Y2016, CAST(s_suppkey AS VARCHAR) AS Y2017_04
FROM a WHERE pos BETWEEN 2 AND 33 AND s_nationkey > 3
""")
def l9_month_update(spark, sf_dir):
    """This month's registrations added to the history as a new column; the new
    version is written to its own folder and read back."""
    s = table(spark, sf_dir, "supplier").filter("s_nationkey > 3")
    history = s.select(F.col("s_name").alias("NAME"), F.col("s_nationkey").cast("string").alias("Y2016"))
    path = f"{checkpoint_dir(spark)}/landframe-io/registrations-{uuid.uuid4().hex}"
    P.award_month_update(history, P.award_table(_award_pages(spark, sf_dir)), "Y2017_04").write.parquet(path)
    return spark.read.parquet(path)


@register("l10_planning_records", sql="""
WITH r AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN 'R' || CAST(o_custkey AS VARCHAR) END AS ref,
                  o_orderstatus, CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS prio FROM orders)
SELECT CAST(max(o_orderkey) AS BIGINT) AS record_id, ref AS "Reference", arg_max(o_orderstatus, o_orderkey) AS "Status",
       max_by(coalesce(prio, ''), o_orderkey) AS "Priority"
FROM r GROUP BY ref
""")
def l10_planning_records(spark, sf_dir):
    """Records from detail tables spread over a main and a further page each; the latest
    record of a reference stays, and one of those without a reference."""
    o = table(spark, sf_dir, "orders")
    ref = F.when(F.col("o_orderstatus") != "P", _html_row(F.lit("Reference"), F.concat(F.lit("R"), F.col("o_custkey").cast("string"))))
    main = F.concat(F.lit("<table>"), F.coalesce(ref, F.lit("")), _html_row(F.lit("Status"), F.col("o_orderstatus")), F.lit("</table>"))
    prio = F.when(F.col("o_orderstatus") == "O", _html_row(F.lit("Priority"), F.col("o_orderpriority")))
    more = F.concat(F.lit("<p>more</p><table>"), _html_row(F.lit("Status"), F.lit("later")), F.coalesce(prio, F.lit("")), F.lit("</table>"))
    pages = o.select(F.col("o_orderkey").alias("record_id"), F.posexplode(F.array(main, more)).alias("n", "html"))
    pages = pages.select("record_id", (F.col("record_id") * 2 + F.col("n")).alias("page_id"), "html")
    out = P.planning_records(pages, vocab=["Priority", "Reference", "Status"])
    return out.select("record_id", "Reference", "Status", F.coalesce("Priority", F.lit("")).alias("Priority"))


@register("l11_map_layers", sql="""
SELECT 'osgb' || CAST(p_partkey AS VARCHAR) AS TOID, CAST(p_size AS SMALLINT) AS FeatureCode, CAST(1 AS SMALLINT) AS Version,
       p_brand AS Theme, CAST(2 AS SMALLINT) AS ThemeCount, p_retailprice AS CalculatedAreaValue,
       CASE WHEN p_size > 25 THEN '2016-01-02' END AS ChangeDate, CAST(CASE WHEN p_size > 25 THEN 2 ELSE 0 END AS SMALLINT) AS ChangeHistoryCount,
       string_split(p_name, ' ')[1] AS DescriptiveGroup, CAST(2 AS SMALLINT) AS DescriptiveGroupCount,
       CAST(NULL AS VARCHAR) AS DescriptiveTerm, CAST(0 AS SMALLINT) AS DescriptiveTermCount, 'Manmade' AS Make, 'part' AS src
FROM part
""")
def l11_map_layers(spark, sf_dir):
    """The TopographicArea layer out of tiles with prefixed element names, the id in
    an attribute, repeated children and a second layer; loaded, written by release and read back."""
    p = table(spark, sf_dir, "part")
    tag = lambda name, c: F.concat(F.lit(f"<osgb:{name}>"), c.cast("string"), F.lit(f"</osgb:{name}>"))
    words = F.split("p_name", " ")
    history = F.when(F.col("p_size") > 25, F.lit("".join(
        f"<osgb:changeHistory><osgb:changeDate>{d}</osgb:changeDate><osgb:reasonForChange>New</osgb:reasonForChange></osgb:changeHistory>"
        for d in ("2016-01-02", "2017-03-04")))).otherwise(F.lit(""))
    area = F.concat(F.lit('<osgb:TopographicArea fid="osgb'), F.col("p_partkey").cast("string"), F.lit('">'), tag("featureCode", F.col("p_size")),
                    tag("version", F.lit(1)), tag("theme", F.col("p_brand")), tag("theme", F.lit("Land")),
                    tag("calculatedAreaValue", F.col("p_retailprice")), history, tag("descriptiveGroup", words[0]),
                    tag("descriptiveGroup", words[1]), tag("make", F.lit("Manmade")), F.lit("</osgb:TopographicArea>"),
                    F.lit('<osgb:TopographicLine fid="x"><osgb:featureCode>1</osgb:featureCode></osgb:TopographicLine>'))
    # a tile file holds 200 parts
    body = F.array_join(F.collect_list(area), "")
    tiles = p.groupBy(F.floor(F.col("p_partkey") / 200).alias("sheet")).agg(
        F.concat(F.lit('<osgb:FeatureCollection xmlns:osgb="urn:osgb">'), body, F.lit("</osgb:FeatureCollection>")).alias("value"))
    root = f"{checkpoint_dir(spark)}/landframe-io/layers-{uuid.uuid4().hex}"
    tiles.write.partitionBy("sheet").text(f"{root}/tiles")
    layers = P.map_layer_load(spark, f"{root}/tiles", {"TopographicArea": None}, f"{root}/out", "201704")
    out = spark.read.schema(layers["TopographicArea"].schema).parquet(f"{root}/out/TopographicArea")
    return out.select("TOID", "FeatureCode", "Version", "Theme", "ThemeCount", "CalculatedAreaValue", "ChangeDate", "ChangeHistoryCount",
                      "DescriptiveGroup", "DescriptiveGroupCount", "DescriptiveTerm", "DescriptiveTermCount", "Make",
                      F.regexp_extract("tile", "^(part)-", 1).alias("src"))
