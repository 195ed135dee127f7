"""Registered queries for the scalar functions (C*), column operators (P*) and filters (F*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from landframe import functions as X
from landframe.operators import columns as P
from landframe.operators import filters as FL
from landframe.plans.registry import register
from landframe.plans.tables import table


@register("c1_pad", sql="""
SELECT c_custkey,
       CASE WHEN length(CAST(c_custkey AS VARCHAR)) >= 12 THEN CAST(c_custkey AS VARCHAR)
            ELSE lpad(CAST(c_custkey AS VARCHAR), 12, '0') END AS key12,
       CASE WHEN length(c_name) >= 12 THEN c_name ELSE lpad(c_name, 12, '0') END AS name12,
       CASE WHEN length(c_mktsegment) >= 9 THEN c_mktsegment ELSE lpad(c_mktsegment, 9, ' ') END AS seg9
FROM customer
""")
def c1_pad(spark, sf_dir):
    """Left pad that never truncates (18-char names stay whole)."""
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey",
                    X.pad_left(F.col("c_custkey").cast("string"), 12).alias("key12"),
                    X.pad_left("c_name", 12).alias("name12"),
                    X.pad_left("c_mktsegment", 9, " ").alias("seg9"))


@register("c2_c3_replace", sql="""
SELECT p_partkey,
       CASE WHEN strpos(p_name, 'e') > 0
            THEN substr(p_name, 1, strpos(p_name, 'e') - 1) || 'E' || substr(p_name, strpos(p_name, 'e') + 1)
            ELSE p_name END AS name_first,
       replace(p_name, 'e', 'E') AS name_all,
       regexp_replace(p_brand, '[0-9]+', 'N', 'g') AS brand_re
FROM part
""")
def c2_c3_replace(spark, sf_dir):
    """First literal occurrence, every literal occurrence, regex replace."""
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey",
                    X.replace_first("p_name", "e", "E").alias("name_first"),
                    X.replace_all("p_name", "e", "E").alias("name_all"),
                    X.replace_all("p_brand", "[0-9]+", "N", regex=True).alias("brand_re"))


@register("c4_recode", sql="""
SELECT o_orderkey,
       regexp_replace(regexp_replace(regexp_replace(o_orderpriority,
           'NOT SPECIFIED', '1', 'g'), 'LOW', '2', 'g'), 'MEDIUM', '3', 'g') AS priority_code
FROM orders
""")
def c4_recode(spark, sf_dir):
    """C4: sequential category recode (each replacement applied to the previous result)."""
    o = table(spark, sf_dir, "orders")
    steps = [("NOT SPECIFIED", "1"), ("LOW", "2"), ("MEDIUM", "3")]
    return o.select("o_orderkey", X.recode("o_orderpriority", steps).alias("priority_code"))


@register("c5_regroup", sql="""
SELECT c_custkey,
       substr(c_name, 1, 4) || ' ' || substr(c_name, 5, 7) AS tele,
       substr(c_name, 10, 9) AS digits
FROM customer
""")
def c5_regroup(spark, sf_dir):
    """Substring by start/stop and the 4+7 regrouping of a phone-like code."""
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", X.regroup("c_name", [(1, 4), (5, 11)]).alias("tele"),
                    X.substring_range("c_name", 10, 18).alias("digits"))


@register("c6_paste", sql="""
SELECT c_custkey,
       concat_ws('-', coalesce(c_name, 'NA'), coalesce(nullif(c_mktsegment, 'BUILDING'), 'NA')) AS pasted,
       c_name || '-' || nullif(c_mktsegment, 'BUILDING') AS concat_sql,
       c_name || CAST(c_nationkey AS VARCHAR) AS paste0
FROM customer
""")
def c6_paste(spark, sf_dir):
    """R paste (missing -> "NA"), SQL concat (missing -> null), paste0."""
    c = table(spark, sf_dir, "customer")
    seg = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    return c.select("c_custkey",
                    X.paste("c_name", seg, sep="-").alias("pasted"),
                    X.paste("c_name", seg, sep="-", na_text=None).alias("concat_sql"),
                    X.paste("c_name", "c_nationkey", sep="").alias("paste0"))


@register("c8_c9_keys", sql="""
SELECT p_partkey,
       regexp_replace(chr(9) || ' ' || p_type || ' ' || chr(10), '^[ \\t\\r\\n]+|[ \\t\\r\\n]+$', '', 'g') AS type_trim,
       upper(replace(p_name, ' ', '')) AS name_key,
       upper(p_brand) AS brand_up, lower(p_type) AS type_low,
       CAST(length(p_name) AS INTEGER) AS name_len
FROM part
""")
def c8_c9_keys(spark, sf_dir):
    """Whitespace trim incl. tabs/newlines, compact upper key, case, length."""
    p = table(spark, sf_dir, "part")
    padded = F.concat(F.lit("\t "), F.col("p_type"), F.lit(" \n"))
    return p.select("p_partkey", X.trim_ws(padded).alias("type_trim"),
                    X.compact_key("p_name").alias("name_key"),
                    F.upper("p_brand").alias("brand_up"), F.lower("p_type").alias("type_low"),
                    F.length("p_name").alias("name_len"))


@register("c13_round", sql="""
SELECT l_orderkey, l_linenumber,
       CAST(round_even(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)), 2) AS DOUBLE) AS disc_amount,
       CAST(ceil(l_orderkey / 1000) AS BIGINT) AS batch
FROM lineitem
""")
def c13_round(spark, sf_dir):
    """Half-even rounding of an exact product; ceiling of a ratio."""
    li = table(spark, sf_dir, "lineitem")
    prod = F.col("l_extendedprice").cast("decimal(18,2)") * F.col("l_discount").cast("decimal(4,2)")
    return li.select("l_orderkey", "l_linenumber",
                     X.round_half_even(prod, 2).cast("double").alias("disc_amount"),
                     X.ceil_ratio("l_orderkey", 1000).alias("batch"))


@register("c15_c16_ratio", sql="""
SELECT c_custkey,
       CAST(round_even(CAST(CAST(c_acctbal / nullif(c_nationkey, 0) AS VARCHAR) AS DECIMAL(38,20)), 4) AS DOUBLE) AS ratio,
       c_acctbal - c_nationkey AS diff
FROM customer
""")
def c15_c16_ratio(spark, sf_dir):
    """Ratio rounded half-even to 4 digits (ties judged on the shortest decimal
    form of the double), null rather than an error on a zero divisor; difference."""
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", X.safe_ratio("c_acctbal", "c_nationkey", 4).alias("ratio"),
                    X.difference("c_acctbal", "c_nationkey").alias("diff"))


@register("c15_safe_ratio_double", sql="""
SELECT p_partkey,
       p_size / nullif(p_size % 7, 0) AS ratio
FROM part
""")
def c15_safe_ratio_double(spark, sf_dir):
    """C15 on doubles, unrounded: division by zero gives null under ANSI mode."""
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", X.safe_ratio("p_size", F.col("p_size") % 7, digits=None).alias("ratio"))


_DATE_TEXT_SQL = """
CASE o_orderpriority
  WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%d')
  WHEN '2-HIGH' THEN strftime(o_orderdate, '%d/%m/%Y')
  WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%Y%m%d')
  WHEN '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%-d %B %Y')
  ELSE 'unknown ' || o_orderstatus END"""


def _date_text(o):
    pr = F.col("o_orderpriority")
    d = F.col("o_orderdate")
    return (F.when(pr == "1-URGENT", F.date_format(d, "yyyy-MM-dd"))
            .when(pr == "2-HIGH", F.date_format(d, "dd/MM/yyyy"))
            .when(pr == "3-MEDIUM", F.date_format(d, "yyyyMMdd"))
            .when(pr == "4-NOT SPECIFIED", F.date_format(d, "d MMMM yyyy"))
            .otherwise(F.concat(F.lit("unknown "), F.col("o_orderstatus"))))


@register("c18_c21_dates", sql=f"""
SELECT o_orderkey,
       CAST(o_orderdate AS DATE) AS parsed,
       strftime(o_orderdate, '%Y%m') AS release,
       upper(strftime(o_orderdate, '%b')) AS month_label,
       coalesce(strftime(coalesce(
           try_strptime(dtext, '%Y-%m-%d'), try_strptime(dtext, '%Y%m%d'),
           try_strptime(dtext, '%d/%m/%Y'), try_strptime(dtext, '%d %B %Y')), '%Y%m%d'), dtext) AS normalised
FROM (SELECT *, {_DATE_TEXT_SQL} AS dtext FROM orders)
""")
def c18_c21_dates(spark, sf_dir):
    """C18/C19/C21: 'd Month yyyy' parse; any-layout date -> yyyyMMdd with unparsable
    text left unchanged; yyyyMM release stamp; upper-case month label."""
    o = table(spark, sf_dir, "orders")
    dmy = F.date_format("o_orderdate", "d MMMM yyyy")
    return o.select("o_orderkey",
                    X.parse_day_month_year(dmy).alias("parsed"),
                    X.format_date("o_orderdate", "yyyyMM").alias("release"),
                    X.month_label("o_orderdate").alias("month_label"),
                    X.normalise_date(_date_text(o)).alias("normalised"))


@register("c20_datetime", sql="""
SELECT event_id,
       strftime(CAST(split_part(CAST(ts AS VARCHAR), '.', 1) AS TIMESTAMP), '%Y%m%d%H%M%S') AS stamp
FROM events
""")
def c20_datetime(spark, sf_dir):
    """C20: timestamp text -> yyyyMMddHHmmss, the fractional-second part ignored."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", X.normalise_datetime(F.col("ts").cast("string")).alias("stamp"))


@register("p_columns", sql="""
SELECT s_suppkey AS uprn, s_name AS name, CAST(s_nationkey AS VARCHAR) AS nation,
       CAST(s_acctbal AS VARCHAR) AS balance, s_suppkey AS objectid, '201704' AS release,
       CAST(NULL AS VARCHAR) AS extra_a, CAST(NULL AS VARCHAR) AS extra_b
FROM supplier
""")
def p_columns(spark, sf_dir):
    """Positional rename, rename-if-present, lower-case names,
    select by position, copy column, text casts, constant stamp, data-driven null columns."""
    s = table(spark, sf_dir, "supplier")
    df = P.rename_all(s, ["UPRN", "NAME", "NATION", "BALANCE"])
    df = P.rename_if_present(df, {"BALANCE": "Balance", "MISSING": "Other"})
    df = P.copy_col(df, "UPRN", "OBJECTID")
    df = P.lower_names(df)
    df = P.cast_all(df, ["nation", "balance"], "string")
    df = P.with_const(df, "release", "201704")
    df = P.add_null_columns(df, ["extra_a", "extra_b"])
    return P.select_at(df, [1, 2, 3, 4, 5, 6, 7, 8])


@register("p11_p12_numbers", sql="""
SELECT c_custkey,
       TRY_CAST(c_name AS DOUBLE) AS name_num,
       TRY_CAST(CAST(c_acctbal AS VARCHAR) AS DOUBLE) AS bal_num,
       CAST(CAST(c_custkey * 1e12 AS DECIMAL(38,0)) AS VARCHAR) AS big_plain,
       regexp_replace(regexp_replace(CAST(CAST(CAST(c_acctbal AS VARCHAR) AS DECIMAL(38,18)) AS VARCHAR), '0+$', ''), '[.]$', '') AS bal_plain
FROM customer
""")
def p11_p12_numbers(spark, sf_dir):
    """Text -> double with unparsable -> null; P12: no scientific notation."""
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", X.to_double("c_name").alias("name_num"),
                    X.to_double(F.col("c_acctbal").cast("string")).alias("bal_num"),
                    X.plain_number(F.col("c_custkey") * F.lit(1e12)).alias("big_plain"),
                    X.plain_number("c_acctbal").alias("bal_plain"))


@register("f1_f2_filters", sql="""
SELECT l_orderkey, l_linenumber, l_quantity, l_discount
FROM lineitem
WHERE l_returnflag = 'R' AND l_quantity > 10 AND l_discount > 0
""")
def f1_f2_filters(spark, sf_dir):
    """equality and a conjunction of comparisons (pushed into the scan)."""
    li = table(spark, sf_dir, "lineitem")
    return (li.filter(F.col("l_returnflag") == "R")
            .filter((F.col("l_quantity") > 10) & (F.col("l_discount") > 0))
            .select("l_orderkey", "l_linenumber", "l_quantity", "l_discount"))


@register("f3_contains_any", sql="""
SELECT p_partkey, p_name FROM part
WHERE contains(p_name, 'ring') OR contains(p_name, 'bolt')
""")
def f3_contains_any(spark, sf_dir):
    """text contains any of two words."""
    p = table(spark, sf_dir, "part")
    return FL.keep_contains_any(p, "p_name", ["ring", "bolt"]).select("p_partkey", "p_name")


_POSTCODE_SQL = """
CASE c_mktsegment
  WHEN 'AUTOMOBILE' THEN chr(65 + c_nationkey % 26) || CAST(c_custkey % 90 + 1 AS VARCHAR) || ' ' || CAST(c_custkey % 10 AS VARCHAR) || 'AB'
  WHEN 'BUILDING' THEN lower(chr(65 + c_nationkey % 26)) || 'e' || CAST(c_custkey % 9 + 1 AS VARCHAR) || ' ' || CAST(c_custkey % 10 AS VARCHAR) || 'zz'
  WHEN 'FURNITURE' THEN chr(65 + c_nationkey % 26) || CAST(c_custkey % 90 + 1 AS VARCHAR) || CAST(c_custkey % 10 AS VARCHAR) || 'AB'
  WHEN 'HOUSEHOLD' THEN 'xx ' || chr(83) || 'E1 ' || CAST(c_custkey % 10 AS VARCHAR) || 'AA'
  ELSE 'GIR 0AA' || CASE WHEN c_custkey % 2 = 0 THEN 'zz' ELSE '' END END"""


def _postcode(c):
    seg, n, k = F.col("c_mktsegment"), F.col("c_nationkey"), F.col("c_custkey")
    letter = F.expr("chr(65 + c_nationkey % 26)")
    return (F.when(seg == "AUTOMOBILE", F.concat(letter, (k % 90 + 1).cast("string"), F.lit(" "),
                                                 (k % 10).cast("string"), F.lit("AB")))
            .when(seg == "BUILDING", F.concat(F.lower(letter), F.lit("e"), (k % 9 + 1).cast("string"),
                                              F.lit(" "), (k % 10).cast("string"), F.lit("zz")))
            .when(seg == "FURNITURE", F.concat(letter, (k % 90 + 1).cast("string"),
                                               (k % 10).cast("string"), F.lit("AB")))
            .when(seg == "HOUSEHOLD", F.concat(F.lit("xx SE1 "), (k % 10).cast("string"), F.lit("AA")))
            .otherwise(F.concat(F.lit("GIR 0AA"), F.when(k % 2 == 0, F.lit("zz")).otherwise(F.lit("")))))


@register("f4_postcode", sql=f"""
SELECT c_custkey, postcode,
       regexp_matches(postcode, '{FL.POSTCODE_PATTERN}') AS valid_strict_false,
       regexp_matches(postcode, '{FL.POSTCODE_PATTERN_STRICT}') AS valid_strict
FROM (SELECT c_custkey, {_POSTCODE_SQL} AS postcode FROM customer)
WHERE regexp_matches(postcode, '{FL.POSTCODE_PATTERN}')
""")
def f4_postcode(spark, sf_dir):
    """postcode validity filter (faithful half-anchored pattern) plus the strict flag."""
    c = table(spark, sf_dir, "customer").select("c_custkey", _postcode(None).alias("postcode"))
    return (c.filter(FL.valid_postcode("postcode"))
            .select("c_custkey", "postcode",
                    FL.valid_postcode("postcode").alias("valid_strict_false"),
                    FL.valid_postcode("postcode", strict=True).alias("valid_strict")))


@register("f5_f6_nulls_length", sql="""
SELECT c.c_custkey, c.c_mktsegment, o.o_orderkey
FROM customer c LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F') o ON c.c_custkey = o.o_custkey
WHERE o.o_orderkey IS NULL AND length(c.c_mktsegment) > 8
""")
def f5_f6_nulls_length(spark, sf_dir):
    """customers without a finished urgent order (null filter on a left-join result), of
    segments with a minimum length of name."""
    c = table(spark, sf_dir, "customer")
    o = table(spark, sf_dir, "orders").filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")).select("o_orderkey", "o_custkey")
    j = c.join(o, c.c_custkey == o.o_custkey, "left").filter(F.col("o_orderkey").isNull())
    return FL.keep_min_length(j, "c_mktsegment", 8).select("c_custkey", "c_mktsegment", "o_orderkey")


@register("f6_non_empty", sql="""
SELECT c_custkey, c_mktsegment, label FROM (
  SELECT c_custkey, c_mktsegment, CASE c_nationkey % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE c_name END AS label FROM customer)
WHERE label <> '' AND length(c_mktsegment) > 8
""")
def f6_non_empty(spark, sf_dir):
    """rows whose label is neither missing nor empty and whose segment is long enough."""
    c = table(spark, sf_dir, "customer")
    label = F.when(F.col("c_nationkey") % 4 == 0, F.lit("")).when(F.col("c_nationkey") % 4 != 1, F.col("c_name"))
    rows = c.select("c_custkey", "c_mktsegment", label.alias("label"))
    return FL.keep_min_length(FL.keep_non_empty(rows, "label"), "c_mktsegment", 8)


@register("f5_keep_null", sql="""
SELECT o_orderkey, o_custkey, c_custkey FROM orders
LEFT JOIN (SELECT c_custkey FROM customer WHERE c_nationkey >= 5) ON o_custkey = c_custkey WHERE c_custkey IS NULL
""")
def f5_keep_null(spark, sf_dir):
    """orders without a match in a table of customers that lacks some nations."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").filter(F.col("c_nationkey") >= 5).select("c_custkey")
    return o.join(c, o["o_custkey"] == c["c_custkey"], "left").filter(F.col("c_custkey").isNull())


@register("f7_slice", sql="""
SELECT o_orderkey, o_totalprice FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 32 OFFSET 1
""")
def f7_slice(spark, sf_dir):
    """rows 2..33 of the frame ordered by price (the positional slice is the feature)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return FL.slice_rows(o, 2, 33, [F.col("o_totalprice").desc(), F.col("o_orderkey")])


@register("f8_profile", sql="""
SELECT 1 AS position, 'c_custkey' AS "column", 'bigint' AS dtype, count(*) AS n_rows, count(*) - count(c_custkey) AS n_missing, count(DISTINCT c_custkey) AS n_distinct FROM customer
UNION ALL SELECT 2, 'segment', 'string', count(*), count(*) FILTER (c_nationkey % 3 = 0), count(DISTINCT CASE WHEN c_nationkey % 3 <> 0 THEN c_mktsegment END) FROM customer
UNION ALL SELECT 3, 'nation', 'string', count(*), 0, count(DISTINCT c_nationkey) FROM customer
""")
def f8_profile(spark, sf_dir):
    """F8: rows, missing and distinct values of every column."""
    c = table(spark, sf_dir, "customer")
    return FL.profile_table(c.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), F.when(F.col("c_nationkey") % 3 != 0, F.col("c_mktsegment")).alias("segment"),
                                     F.col("c_nationkey").cast("string").alias("nation")))


@register("p12_large_and_small", sql="""
SELECT o_orderkey, CASE o_orderkey WHEN 0 THEN '0' ELSE CAST(o_orderkey AS VARCHAR) || '000000000000000000000' END AS big, CAST(o_orderkey AS VARCHAR) || '.25' AS middle,
       '0.00000000000000000000' || lpad(CAST(o_orderkey % 1000 + 1001 AS VARCHAR), 4, '0') || '7' AS small
FROM orders
""")
def p12_large_and_small(spark, sf_dir):
    """Numbers from 1e20 on and far below 1 in plain digits."""
    k = F.col("o_orderkey").cast("string")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", X.plain_number(F.concat(k, F.lit("E21"))).alias("big"), X.plain_number(F.concat(k, F.lit(".2500"))).alias("middle"),
        X.plain_number(F.concat((F.col("o_orderkey") % 1000 + 1001).cast("string"), F.lit("7E-25"))).alias("small"))
