"""End-to-end jobs (L1-L12) composed from the operators.

Each function takes plain DataFrames in the job's own input schema and returns the
job's output DataFrame; nothing here knows about the driver's test tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landframe.operators.aggregate import period_change
from landframe.operators.filters import valid_postcode
from landframe.operators.joins import keep_not_in, merge_on
from landframe.operators.reshape import melt_except


def population_change(wide: DataFrame, ids: Sequence[str], area_col: str, p0: str, p1: str,
                      areas: DataFrame | None = None, area_key: str | None = None,
                      out0: str | None = None, out1: str | None = None) -> DataFrame:
    """L4: change of a per-area total between two periods of a wide table.

    ``wide`` has id columns and one value column per period (column name = period).
    Steps: keep the two period columns (the period filter applied before the melt, so
    the other periods are never expanded) -> melt to (ids, period, count) -> keep rows
    of the two periods -> per-area sums of each period in one conditional-aggregation
    pass, null-poisoned like R's ``sum`` -> ``change = p1 - p0`` -> optionally merge
    the result onto an area attribute table (``areas``, key ``area_key``), which keeps
    every area, with nulls where it has no data.
    """
    out0, out1 = out0 or f"Y{p0}", out1 or f"Y{p1}"
    narrow = wide.select(*[F.col(f"`{c}`") for c in ids], F.col(f"`{p0}`"), F.col(f"`{p1}`"))
    long = melt_except(narrow, ids, "period", "count")
    long = long.filter(F.col("period").isin(str(p0), str(p1)))
    res = period_change(long, [area_col], "period", str(p0), str(p1), "count", out0, out1)
    if areas is not None:
        res = merge_on(areas, res, area_key, area_col, "left")
    return res


def postcode_quality(records: DataFrame, id_col: str, postcode_col: str, start_col: str,
                     end_col: str, strict: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Split planning records by postcode validity and derive build durations.

    Returns ``(valid, missing_valid, durations)``: rows with a valid postcode; rows
    whose id has no valid-postcode row (anti join on the id); rows with both dates
    positive plus ``duration = end - start``.
    """
    valid = records.filter(valid_postcode(postcode_col, strict))
    missing = keep_not_in(records, valid.select(id_col), id_col)
    durations = (records.filter((F.col(start_col) > 0) & (F.col(end_col) > 0))
                 .withColumn("duration", F.col(end_col) - F.col(start_col)))
    return valid, missing, durations


# --------------------------------------------------------------------------- L1 / L12


def address_release(raw: DataFrame, boundary: DataFrame, release: str, order_by: Sequence,
                    batch_size: int | None = 100_000, x: str = "X_COORDINATE", y: str = "Y_COORDINATE",
                    uprn: str = "UPRN", parent: str = "PARENT_UPRN", crs: str = "EPSG:27700",
                    boundary_crs: str = "EPSG:27700") -> tuple[DataFrame, DataFrame, DataFrame]:
    """L1: shape one address release and clip it to a boundary.

    Steps: keep the raw id as ``OBJECTID``; pad ids to 12 characters (never cut);
    coordinates to numbers rounded half-even to 2 places; ``FLAT`` = rows sharing the
    coordinate pair; ``update_date`` release stamp; ``group`` = insert batch of
    ``batch_size`` rows in ``order_by`` order (``None``: no batch column, and neither the
    sort nor the written copy it costs); rows with unusable coordinates set aside;
    names lower-cased; points moved into the boundary's coordinate system (a no-op that
    only records the CRS when both are the same); clip to the boundary polygons.

    ``order_by`` must identify rows uniquely (e.g. the raw UPRN as a number): it fixes
    which rows share an insert batch.  Returns ``(all_rows, clipped_rows, rejected_rows)``.
    """
    from landframe.functions import pad_left, round_half_even, to_double
    from landframe.operators.columns import copy_col, lower_names, with_const
    from landframe.operators.spatial import clip, reproject, with_point
    from landframe.operators.window import add_batch, add_count

    df = copy_col(raw, uprn, "OBJECTID")
    # batch numbers first: the numbering checkpoints its input, so the flat count below
    # is computed once, from the checkpoint, instead of inside the sampling and
    # checkpoint jobs as well
    if batch_size is not None:
        df = df.withColumn("__order", F.struct(*order_by))
        df = add_batch(df, batch_size, ["__order"], "group").drop("__order")
    df = df.withColumns({uprn: pad_left(uprn, 12), parent: pad_left(parent, 12),
                         x: round_half_even(to_double(x), 2), y: round_half_even(to_double(y), 2)})
    df = add_count(df, [x, y], "FLAT")
    df = with_const(df, "update_date", release)
    ok, rejected = with_point(df, x, y, "__px", "__py")
    ok = lower_names(ok.drop("__px", "__py"))
    located = reproject(ok, x.lower(), y.lower(), crs, boundary_crs)
    clipped = clip(located, boundary, x.lower(), y.lower())
    return ok, clipped, lower_names(rejected)


def publish_address_release(all_rows: DataFrame, boundary: DataFrame, root: str, release: str, min_rows: int = 1000,
                            tables: tuple[str, str] = ("all", "clipped"), jdbc_url: str | None = None,
                            key: str = "objectid", release_col: str = "update_date", x: str = "x_coordinate",
                            y: str = "y_coordinate", crs: str = "EPSG:27700", boundary_crs: str = "EPSG:27700") -> DataFrame:
    """L1 sinks: the shaped rows are written once; the second output, the rows inside ``boundary``
    (moved into its coordinate system), reads them back from the first.  Each is
    release-partitioned Parquet under ``root`` and
    optionally a database table (replace load, key checked first).

    Returns one status row per output, from the rows of the loaded ``release`` alone.  An
    empty release empties its partition: what an earlier load left there is removed."""
    from landframe.operators.quality import row_gate
    from landframe.operators.spatial import clip, reproject
    from landframe.sources.files import replace_table, write_release
    spark = all_rows.sparkSession

    def sink(name: str):
        def write(df: DataFrame) -> None:
            write_release(df, f"{root}/{name}", release_col, replaces=[release])
            if jdbc_url:
                loaded = spark.read.schema(df.schema).parquet(f"{root}/{name}").filter(F.col(release_col) == release)
                replace_table(loaded.drop("group"), jdbc_url, name, key)
        return write

    whole, inside = tables
    sink(whole)(all_rows)
    written = spark.read.schema(all_rows.schema).parquet(f"{root}/{whole}").filter(F.col(release_col) == release)
    sink(inside)(clip(reproject(written, x, y, crs, boundary_crs), boundary, x, y))
    status = [row_gate(spark.read.schema(all_rows.schema).parquet(f"{root}/{t}").filter(F.col(release_col) == release), t, min_rows)
              for t in tables]
    return status[0].unionByName(status[1])


def address_graph(raw: DataFrame, names: Sequence[str], date_cols: Sequence[str],
                  x: str = "X_COORDINATE", y: str = "Y_COORDINATE", uprn: str = "UPRN",
                  parent: str = "PARENT_UPRN", typed: bool = False) -> tuple[DataFrame, DataFrame]:
    """The address graph: positional names, ``OBJECTID`` copy, 12-character ids,
    dates re-emitted as ``yyyyMMdd`` (unparsable left as they are), points made from the
    coordinates with failures routed to a reject output, names lower-cased.  ``typed`` gives
    the features the database table's types: dates as DATE (unparsable null), coordinates as
    doubles; the reject output keeps its text.

    Returns ``(features, rejected)``.
    """
    from landframe.functions import normalise_date, pad_left
    from landframe.operators.columns import copy_col, lower_names, rename_all
    from landframe.operators.spatial import with_point

    df = rename_all(raw, names)
    df = copy_col(df, uprn, "OBJECTID")
    df = df.withColumns({uprn: pad_left(uprn, 12), parent: pad_left(parent, 12)})
    df = df.withColumns({c: normalise_date(c) for c in date_cols})
    ok, rejected = with_point(df, x, y, "px", "py")
    if typed:
        ok = ok.withColumns({x: F.col("px"), y: F.col("py"), **{c: F.try_to_timestamp(F.col(c), F.lit("yyyyMMdd")).cast("date") for c in date_cols}})
    return lower_names(ok), lower_names(rejected)


# --------------------------------------------------------------------------- L2


def building_heights(layer: DataFrame, heights: DataFrame, tiles: Sequence[str] = ("TQ", "TL"),
                     theme: str = "Buildings", prefix: str = "osgb", order_by: Sequence[str] = ("BHA_ProcessDate",),
                     renames: dict | None = None, every_match: bool = False) -> DataFrame:
    """L2: attach building heights to map-layer features.

    Heights rows are kept for the wanted tiles (text contains any tile code); the ``osgb``
    prefix is taken off their key, because the layer's ids are plain; layer features are
    kept for one theme; every feature with a height takes the first height row by
    ``order_by`` plus the number of height rows for it (features without heights drop out),
    or with ``every_match`` is repeated for each of its height rows; the process date is
    re-emitted as ``yyyyMMddHHmmss``; attributes renamed where present.
    """
    from landframe.functions import contains_any, normalise_datetime, strip_prefix
    from landframe.operators.columns import rename_if_present
    from landframe.operators.joins import lookup_first, merge_duplicating

    h = heights.filter(contains_any("TileRef", tiles))
    h = h.withColumn("TOID", strip_prefix("OS_TOPO_TOID", prefix)).drop("OS_TOPO_TOID")
    feats = layer.filter(F.col("Theme") == theme)
    if every_match:
        joined = merge_duplicating(feats, h, "TOID", "TOID")
    else:
        joined = lookup_first(feats, h, "TOID", "TOID", list(order_by), count_col="match_count")
    joined = joined.withColumn("BHA_ProcessDate", normalise_datetime("BHA_ProcessDate"))
    return rename_if_present(joined, renames or {})


# --------------------------------------------------------------------------- L5 / L8


def flats_by_area(addresses: DataFrame, areas: DataFrame, x: str, y: str, order_by: Sequence[str],
                  code_col: str = "ward_code", area_key: str = "poly_id", area_attrs: Sequence[str] = ("name",),
                  crs: str = "EPSG:27700", areas_crs: str = "EPSG:27700") -> DataFrame:
    """Per area, the number of addresses at coordinates shared by more than one address.

    Points are moved into the areas' coordinate system (no-op when equal) and clipped to the
    areas; each coordinate is counted once, under the area code that its first address
    carries (not the polygon it lies in); counts above one are summed per code and joined to
    the areas whose ``area_key`` is that code."""
    from landframe.operators.aggregate import multi_occupancy
    from landframe.operators.spatial import clip, reproject

    inside = clip(reproject(addresses, x, y, crs, areas_crs), areas, x, y)
    per_code = multi_occupancy(inside, x, y, code_col, order_by)
    return merge_on(areas.select(area_key, *area_attrs), per_code, area_key, code_col)


def postcodes_in_subareas(points: DataFrame, polygons: DataFrame, lookup_rows: DataFrame,
                          x: str, y: str, keep: Sequence[str], key: str = "poly_id",
                          label: str = "Sub_Area", crs: str = "EPSG:27700") -> DataFrame:
    """Sub-area name for every postcode point inside a sub-area polygon.

    The points' coordinate system is declared (``crs``, metadata only), the name lookup
    is left-joined onto the polygons, points are tagged with the polygon containing
    them, points without a sub-area name are dropped."""
    from landframe.operators.joins import left_lookup
    from landframe.operators.spatial import set_crs, tag_with_polygon

    named = left_lookup(polygons, lookup_rows, key, key)
    tagged = tag_with_polygon(set_crs(points, [x, y], crs), named, x, y, [label], pick="last", order=key)
    return tagged.filter(F.col(label).isNotNull()).select(*keep, label)


# --------------------------------------------------------------------------- L3


# Source -> target names of the school register fields (renamed when present).
SCHOOL_RENAMES = {
    "EstablishmentName": "SCHOOL_NAME", "TypeOfEstablishment__name_": "TYPE",
    "PhaseOfEducation__name_": "PHASE", "Street": "ADDRESS", "Town": "TOWN",
    "EstablishmentStatus__name_": "STATUS", "Gender__name_": "GENDER", "WardNM": "WARD_NAME",
    "LSOA11NM": "LSOA_NAME", "LAD11NM": "LA_NAME", "SchoolWebsite": "WEBLINK", "Postcode": "POSTCODE",
    "NumberOfBoys": "NoofBoys", "NumberOfGirls": "NoofGirls", "PercentageFSM": "PerFSM",
    "TelephoneNum": "Tele", "OfstedSpecialMeasures__name_": "ofsted",
}
# Special-measures text -> code, applied in this order.
OFSTED_CODES = [("Not in special measures", "1"), ("Not applicable", "2"), ("In special measures", "3")]


def schools_update(register: DataFrame, previous: DataFrame, workforce: DataFrame, healthy: DataFrame,
                   healthy_cols: dict, ratio_col: str = "Pupil......Teacher.Ratio",
                   keep: Sequence[str] | None = None, output: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """L3: refresh the schools table and cross-flag it with a programme report.

    Register fields renamed where present; ``AGE`` = low-high, ``BoyGirl_R`` = boys /
    girls rounded half-even to 4 (null when no girls), telephone regrouped 4+7, special
    measures recoded; merged on URN onto the previous table, which keeps
    all its rows, and with the workforce table; text casts.  Both sides get three match keys - URN (trimmed), postcode (upper case,
    no spaces) and school name + area - and each side is flagged 1 when any key occurs
    on the other side (``healthyschools_2017`` / ``found``).

    ``healthy_cols`` names the report's columns: ``name``, ``borough``, ``postcode``,
    ``urn``.  Schools come out without the helper key, URN as text, with the columns
    ``output`` in that order (default: all).  Returns ``(schools, report)``.
    """
    from landframe.functions import compact_key, paste, recode, regroup, replace_all, safe_ratio, trim_ws
    from landframe.operators.columns import rename_if_present
    from landframe.operators.joins import flag_any_match

    df = rename_if_present(register, SCHOOL_RENAMES)
    df = df.withColumns({
        "AGE": paste("StatutoryLowAge", "StatutoryHighAge", sep="-"),
        "BoyGirl_R": safe_ratio("NoofBoys", "NoofGirls", 4),
        "Tele": regroup("Tele", [(1, 4), (5, 11)]),
        "ofsted": recode("ofsted", OFSTED_CODES),
    })
    if keep:
        df = df.select(*keep)
    # a merge onto the spatial table keeps all its rows
    df = merge_on(previous, df, "URN", "URN", "left")
    df = merge_on(df, workforce, "URN", "URN", "left")
    df = df.withColumnRenamed(ratio_col, "PupilTeach_R")
    text_cols = [c for c in ("WEBLINK", "SCHOOL_NAME", "TYPE", "PHASE", "ADDRESS", "TOWN", "POSTCODE",
                             "STATUS", "GENDER", "WARD_NAME") if c in df.columns]
    df = df.withColumns({c: F.col(c).cast("string") for c in text_cols})

    h = healthy.withColumn(healthy_cols["borough"],
                           replace_all(replace_all(healthy_cols["borough"], " & ", " and "), "-", " "))
    h = h.withColumn("working", paste(healthy_cols["name"], healthy_cols["borough"]))
    df = df.withColumn("working", paste("SCHOOL_NAME", "LA_NAME"))
    s_keys = [F.col("URN").cast("string"), F.replace(F.col("POSTCODE"), F.lit(" "), F.lit("")), F.col("working")]
    h_keys = [trim_ws(F.col(healthy_cols["urn"]).cast("string")), compact_key(healthy_cols["postcode"]), F.col("working")]
    schools = flag_any_match(df, h, list(zip(s_keys, h_keys)), "healthyschools_2017").drop("working")
    schools = schools.withColumn("URN", F.col("URN").cast("string"))
    if output:
        schools = schools.select(*output)
    report = flag_any_match(h, df, list(zip(h_keys, s_keys)), "found")
    return schools, report


# --------------------------------------------------------------------------- L9


# Borough spellings corrected in the award table (first occurrence only).
BOROUGH_FIXES = [
    ("City & Hackney", "City and Hackney"),
    ("Hammersmith & Fulham", "Hammersmith and Fulham"),
    ("Kensington & Chelsea", "Kensington and Chelsea"),
    ("Kingston-upon-Thames", "Kingston upon Thames"),
    ("Richmond-upon-Thames", "Richmond upon Thames"),
]
AWARD_NAMES = ["BOROUGH", "REGISTERED", "BRONZE", "SILVER", "GOLD"]


def award_table(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
                first_row: int = 2, last_row: int = 33) -> DataFrame:
    """L9 (first half): the award summary table of a page as rows.

    Table cells (H6) widened to one row per table row, the first five columns named
    positionally (further ones are not read), borough spellings fixed (first occurrence),
    rows ``first_row..last_row`` of every table kept (1-based; the first row is a total),
    sorted by borough."""
    from landframe.functions import replace_first
    from landframe.operators.columns import rename_all
    from landframe.operators.reshape import widen
    from landframe.sources.pages import extract_table

    cells = extract_table(pages, id_col, html_col).withColumn("col", F.col("col").cast("string"))
    wide = widen(cells, [id_col, "tbl", "row"], "col", "text", vocab=[str(i) for i in range(len(AWARD_NAMES))])
    t = rename_all(wide, [id_col, "tbl", "row", *AWARD_NAMES])
    b = F.col("BOROUGH")
    for old, new in BOROUGH_FIXES:
        b = replace_first(b, old, new)
    t = t.withColumn("BOROUGH", b)
    t = t.filter(F.col("row").between(first_row - 1, last_row - 1))
    return t.select(*AWARD_NAMES).orderBy("BOROUGH")


def award_month_update(registrations: DataFrame, awards: DataFrame, period: str) -> DataFrame:
    """L9 (second half): this period's registered count added to the running history as
    a column named after the period (write the result to a new version folder)."""
    from landframe.sources.files import append_period_column
    return append_period_column(registrations, awards, "NAME", "BOROUGH", "REGISTERED", period,
                                drop=["BRONZE", "SILVER", "GOLD"])


def school_repeats(report: DataFrame, name_col: str, borough_col: str, order_by: Sequence[str]) -> DataFrame:
    """L9 report: rows after the first with the same school name + borough."""
    from landframe.functions import paste
    from landframe.operators.window import find_repeats
    keyed = report.withColumn("uniqschool", paste(name_col, borough_col))
    return find_repeats(keyed, ["uniqschool"], order_by)


# --------------------------------------------------------------------------- L10 / L11


def planning_records(pages: DataFrame, record_col: str = "record_id", page_col: str = "page_id",
                     html_col: str = "html", reference: str = "Reference",
                     vocab: Sequence[str] | None = None) -> DataFrame:
    """Planning records assembled from two-column detail tables.

    Each record's details are spread over several pages (a main page and a "further
    information" page share one ``record_col``).  Every table row ``(X1, X2)`` of those
    pages is a key/value pair; a record's pairs are stacked, exact duplicates dropped,
    the first value per key kept (page, then row order), keys widened to columns (null
    where a record lacks one), and the latest record (highest id) kept per ``reference``
    value, as each new record is put on top of the earlier ones; records without a
    reference count as one value.  ``vocab`` names the keys; without it they are read from
    the pairs, which fails above ``spark.sql.pivotMaxValues`` keys.
    """
    from landframe.operators.reshape import pivot_vocabulary, widen
    from landframe.operators.setops import distinct_rows
    from landframe.operators.window import first_per_key
    from landframe.sources.pages import extract_table

    cells = extract_table(pages, page_col, html_col)
    kv = (cells.groupBy(page_col, "tbl", "row")
          .agg(F.max(F.when(F.col("col") == 0, F.col("text"))).alias("key"),
               F.max(F.when(F.col("col") == 1, F.col("text"))).alias("value")))
    kv = kv.join(pages.select(page_col, record_col), page_col)
    kv = kv.filter(F.col("key").isNotNull() & (F.col("key") != ""))
    kv = distinct_rows(kv.select(record_col, "key", "value", page_col, "tbl", "row"))
    vocab = pivot_vocabulary(kv, "key") if vocab is None else vocab
    kv = first_per_key(kv, [record_col, "key"], [page_col, "tbl", "row"])
    wide = widen(kv.select(record_col, "key", "value"), [record_col], "key", "value", vocab)
    if reference not in wide.columns:
        wide = wide.withColumn(reference, F.lit(None).cast("string"))
    return first_per_key(wide, [reference], [record_col], descending=True)


def map_layer_load(spark, paths, layers: dict, root: str | None = None,
                   release: str | None = None) -> dict:
    """Every named feature layer out of a folder of XML/GML tiles, with ``tile`` /
    ``file`` provenance, the declared attributes selected; optionally written per layer
    partitioned by release.  ``layers`` maps row tag -> schema (DDL or StructType),
    or a declared layer's name (``layouts.MAP_LAYERS``) -> None.  Returns the layer DataFrames."""
    from landframe.sources.files import read_features, read_map_layer, write_release
    out = {}
    for tag, schema in layers.items():
        df = read_map_layer(spark, paths, tag) if schema is None else read_features(spark, paths, tag, schema)
        if release is not None:
            df = df.withColumn("release", F.lit(release))
        out[tag] = df
        if root is not None and release is not None:
            write_release(df, f"{root}/{tag}", "release")
    return out
