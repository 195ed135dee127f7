"""Registered queries for joins (J*), aggregates (A*), window-like operators (W*),
reshapes (R*) and set operations (U*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from landframe.functions import add_prefix, strip_prefix
from landframe.operators import aggregate as A
from landframe.operators import joins as J
from landframe.operators import reshape as R
from landframe.operators import setops as U
from landframe.operators import window as W
from landframe.plans.registry import register
from landframe.plans.tables import table

# ---------------------------------------------------------------- joins


@register("j1_merge_natural", sql="""
SELECT c.c_nationkey, c.c_custkey, c.c_name, n.n_name, n.n_regionkey
FROM customer c JOIN nation n ON c.c_nationkey IS NOT DISTINCT FROM n.n_nationkey
""")
def j1_merge_natural(spark, sf_dir):
    """Inner merge on all shared column names (key first in the output)."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    return J.merge_natural(c, n)


@register("j2_merge_suffix", sql="""
SELECT c.c_nationkey AS nk, c.c_custkey, c.c_name AS "name.x", n.n_regionkey, n.n_name AS "name.y"
FROM customer c JOIN nation n ON c.c_nationkey IS NOT DISTINCT FROM n.n_nationkey
""")
def j2_merge_suffix(spark, sf_dir):
    """Merge on differently named keys; clashing names get .x/.y suffixes."""
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nk"), "c_custkey", F.col("c_name").alias("name"))
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("name"), "n_regionkey")
    return J.merge_on(c, n, "nk", "n_nationkey")


@register("j4_left", sql="""
SELECT c.c_custkey, c.c_name, o.o_orderkey, o.o_totalprice
FROM customer c LEFT JOIN orders o ON c.c_custkey IS NOT DISTINCT FROM o.o_custkey
""")
def j4_left(spark, sf_dir):
    """Left join; customers without orders keep null order columns."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return J.left_lookup(c, o, "c_custkey", "o_custkey")


@register("j5_match_only", sql="""
SELECT o.o_orderkey, o.o_custkey, c.c_name, c.c_mktsegment
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE c.c_mktsegment IS NOT NULL
""")
def j5_match_only(spark, sf_dir):
    """Left join then drop unmatched rows (planned as an inner join)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return J.match_only(o, c, "o_custkey", "c_custkey", require="c_mktsegment")


@register("j6_j7_keep_in", sql="""
SELECT c_custkey, c_name FROM customer c
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_orderstatus = 'F'
              AND o.o_custkey IS NOT DISTINCT FROM c.c_custkey)
""")
def j6_j7_keep_in(spark, sf_dir):
    """Semi join / key membership (``%in%``)."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    o = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    return J.keep_in(c, o, "c_custkey", "o_custkey")


@register("j8_keep_not_in", sql="""
SELECT c_custkey, c_name FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderstatus = 'F'
                  AND o.o_custkey IS NOT DISTINCT FROM c.c_custkey)
""")
def j8_keep_not_in(spark, sf_dir):
    """Anti membership (``!%in%``)."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    o = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    return J.keep_not_in(c, o, "c_custkey", "o_custkey")


def _j9_keys():
    # (left key exprs on customer, right key exprs on supplier)
    return [
        ([F.floor("c_acctbal")], [F.floor("s_acctbal")]),
        ([F.substring("c_name", -3, 3)], [F.substring("s_name", -3, 3)]),
        ([F.col("c_nationkey"), F.floor(F.col("c_acctbal") / 1000)],
         [F.col("s_nationkey"), F.floor(F.col("s_acctbal") / 1000)]),
    ]


@register("j9_flag_any", sql="""
SELECT c_custkey, c_name,
  CASE WHEN floor(c_acctbal) IN (SELECT floor(s_acctbal) FROM supplier)
         OR right(c_name, 3) IN (SELECT right(s_name, 3) FROM supplier)
         OR EXISTS (SELECT 1 FROM supplier s WHERE s.s_nationkey = c.c_nationkey
                    AND floor(s.s_acctbal / 1000) = floor(c.c_acctbal / 1000))
       THEN 1 ELSE 0 END AS matched
FROM customer c
""")
def j9_flag_any(spark, sf_dir):
    """1 if a customer matches a supplier on balance OR name tail OR (nation, band)."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_nationkey")
    s = table(spark, sf_dir, "supplier")
    return J.flag_any_match(c, s, _j9_keys(), "matched").select("c_custkey", "c_name", "matched")


@register("j10_reverse_flag", sql="""
SELECT s_suppkey, s_name,
  CASE WHEN floor(s_acctbal) IN (SELECT floor(c_acctbal) FROM customer)
         OR right(s_name, 3) IN (SELECT right(c_name, 3) FROM customer)
         OR EXISTS (SELECT 1 FROM customer c WHERE c.c_nationkey = s.s_nationkey
                    AND floor(c.c_acctbal / 1000) = floor(s.s_acctbal / 1000))
       THEN 1 ELSE 0 END AS found
FROM supplier s
""")
def j10_reverse_flag(spark, sf_dir):
    """The same three keys checked from the other side."""
    c = table(spark, sf_dir, "customer")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal", "s_nationkey")
    keys = [(rk, lk) for lk, rk in _j9_keys()]
    return J.flag_any_match(s, c, keys, "found").select("s_suppkey", "s_name", "found")


@register("j11_lookup_first", sql="""
SELECT p.p_partkey, p.p_name, f.l_orderkey, f.l_linenumber, f.l_quantity, f.match_count
FROM part p JOIN (
  SELECT l_partkey, l_orderkey, l_linenumber, l_quantity,
         row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber) AS rn,
         count(*) OVER (PARTITION BY l_partkey) AS match_count
  FROM lineitem) f ON p.p_partkey = f.l_partkey AND f.rn = 1
""")
def j11_lookup_first(spark, sf_dir):
    """First matching line per part (by order key, line) plus the match count."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_quantity")
    return J.lookup_first(p, li, "p_partkey", "l_partkey", ["l_orderkey", "l_linenumber"])


@register("j12_merge_duplicating", sql="""
SELECT p.p_partkey, p.p_name, l.l_orderkey, l.l_linenumber
FROM part p JOIN lineitem l ON p.p_partkey = l.l_partkey
""")
def j12_merge_duplicating(spark, sf_dir):
    """One-to-many merge, each part repeated per matching line; unmatched dropped."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber")
    return J.merge_duplicating(p, li, "p_partkey", "l_partkey")


@register("j13_key_repair", sql="""
SELECT o.o_orderkey, 'osgb' || CAST(o.o_custkey AS VARCHAR) AS toid, c.c_name
FROM orders o JOIN customer c
  ON CAST(replace('osgb' || CAST(o.o_custkey AS VARCHAR), 'osgb', '') AS BIGINT) = c.c_custkey
""")
def j13_key_repair(spark, sf_dir):
    """Prefixed text key repaired (prefix stripped) before the join."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", add_prefix(F.col("o_custkey").cast("string"),
                                                                         "osgb").alias("toid"))
    o = o.withColumn("key", strip_prefix("toid", "osgb").cast("bigint"))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return J.merge_on(o, c, "key", "c_custkey").select("o_orderkey", "toid", "c_name")


# ---------------------------------------------------------------- aggregates


@register("a1_group_sum", sql="""
SELECT c.c_nationkey,
       CAST(CASE WHEN count(o.o_totalprice) = count(*) THEN sum(CAST(o.o_totalprice AS DECIMAL(18,2))) END AS DOUBLE) AS total
FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey
GROUP BY c.c_nationkey
""")
def a1_group_sum(spark, sf_dir):
    """A1: per-nation order total; a nation with an order-less customer becomes null."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    o = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_totalprice").cast("decimal(18,2)").alias("v"))
    j = c.join(o, c.c_custkey == o.o_custkey, "left")
    return A.group_sum(j, ["c_nationkey"], "v", "total").withColumn("total", F.col("total").cast("double"))


@register("a2_period_change", sql="""
SELECT o_orderpriority,
       CAST(sum(CASE WHEN year(o_orderdate) = 1997 THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS y1997,
       CAST(sum(CASE WHEN year(o_orderdate) = 1999 THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS y1999,
       CAST(sum(CASE WHEN year(o_orderdate) = 1999 THEN CAST(o_totalprice AS DECIMAL(18,2)) END)
          - sum(CASE WHEN year(o_orderdate) = 1997 THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS change
FROM orders GROUP BY o_orderpriority
HAVING count(CASE WHEN year(o_orderdate) = 1997 THEN 1 END) > 0
   AND count(CASE WHEN year(o_orderdate) = 1999 THEN 1 END) > 0
""")
def a2_period_change(spark, sf_dir):
    """A2: two-period change in one conditional-aggregation pass."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderpriority", F.year("o_orderdate").alias("yr"), F.col("o_totalprice").cast("decimal(18,2)").alias("v"))
    r = A.period_change(o, ["o_orderpriority"], "yr", 1997, 1999, "v", "y1997", "y1999")
    return r.select("o_orderpriority", *[F.col(c).cast("double").alias(c) for c in ("y1997", "y1999", "change")])


@register("a3_count_non_null", sql="""
SELECT c.c_nationkey, count(o.o_orderkey) AS matched
FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey
GROUP BY c.c_nationkey
""")
def a3_count_non_null(spark, sf_dir):
    """A3: number of matched rows per group (``sum(!is.na(x))``)."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    return A.count_non_null(c.join(o, c.c_custkey == o.o_custkey, "left"), ["c_nationkey"], "o_orderkey", "matched")


@register("a4_multi_occupancy", sql="""
WITH xy AS (
  SELECT l_partkey, l_suppkey, count(*) AS flat,
         arg_min(l_returnflag, (l_orderkey, l_linenumber)) AS area
  FROM lineitem GROUP BY l_partkey, l_suppkey)
SELECT area AS l_returnflag, CAST(sum(flat) AS BIGINT) AS total_flats
FROM xy WHERE flat > 1 GROUP BY area
""")
def a4_multi_occupancy(spark, sf_dir):
    """A4: rows sharing a coordinate (part, supplier) counted, first row's area kept,
    coordinates with more than one row summed per area (return flag)."""
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag", "l_orderkey", "l_linenumber")
    return A.multi_occupancy(li, "l_partkey", "l_suppkey", "l_returnflag", ["l_orderkey", "l_linenumber"])


@register("a5_control_values", sql="""
SELECT count(*) AS n_rows, count(*) > 0 AS has_rows, max(o_orderkey) AS max_o_orderkey FROM orders
""")
def a5_control_values(spark, sf_dir):
    """A5: row count and maximum used as control values."""
    return A.control_values(table(spark, sf_dir, "orders"), "o_orderkey")


@register("a6_vocabulary", sql="""
SELECT DISTINCT t AS token FROM (SELECT unnest(string_split(p_name, ' ')) AS t FROM part)
WHERE length(t) > 1
""")
def a6_vocabulary(spark, sf_dir):
    """Sorted unique tokens longer than one character."""
    return A.vocabulary(table(spark, sf_dir, "part"), "p_name", " ", 1)


# ---------------------------------------------------------------- window-like


@register("w1_add_count", sql="""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       count(*) OVER (PARTITION BY l_partkey, l_suppkey) AS n
FROM lineitem
""")
def w1_add_count(spark, sf_dir):
    """Rows sharing a coordinate (part, supplier) counted on every row."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return W.add_count(li, ["l_partkey", "l_suppkey"], "n")


@register("w2_add_sum", sql="""
SELECT l_orderkey, l_linenumber, l_partkey,
       sum(l_quantity) OVER (PARTITION BY l_partkey) AS part_qty
FROM lineitem
""")
def w2_add_sum(spark, sf_dir):
    """Group sum on every row."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return W.add_sum(li, ["l_partkey"], "l_quantity", "part_qty").drop("l_quantity")


@register("w3_row_id", sql="""
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_id,
       'ord' || CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS VARCHAR) AS label
FROM orders
""")
def w3_row_id(spark, sf_dir):
    """Global sequence number and prefixed id in (date, key) order."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    r = W.add_row_id(o, ["o_orderdate", "o_orderkey"], out="row_id")
    return r.select("o_orderkey", "row_id", F.concat(F.lit("ord"), F.col("row_id").cast("string")).alias("label"))


@register("w4_batch", sql="""
SELECT o_orderkey, CAST(ceil(row_number() OVER (ORDER BY o_orderkey) / 1000) AS BIGINT) AS "group"
FROM orders
""")
def w4_batch(spark, sf_dir):
    """Batch number ceil(row / 1000) in key order."""
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    return W.add_batch(o, 1000, ["o_orderkey"])


@register("w5_first_per_key", sql="""
SELECT event_id, ts, user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts NULLS FIRST, event_id NULLS FIRST) AS rn
  FROM events) WHERE rn = 1
""")
def w5_first_per_key(spark, sf_dir):
    """First event per (user, type) by (ts, event_id), all columns kept."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return W.first_per_key(e, ["user_id", "event_type"], ["ts", "event_id"])


@register("w6_repeats", sql="""
SELECT event_id, ts, user_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn
  FROM events) WHERE rn > 1
""")
def w6_repeats(spark, sf_dir):
    """Every event after the first of its (user, type)."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return W.find_repeats(e, ["user_id", "event_type"], ["ts", "event_id"])


# ---------------------------------------------------------------- reshape


@register("w6_tied_repeats", sql="""
SELECT user_id, event_type FROM (
  SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id, event_type) AS rn FROM events) WHERE rn > 1
""")
def w6_tied_repeats(spark, sf_dir):
    """Repeats among rows that are wholly equal: all but one of each."""
    return W.find_repeats(table(spark, sf_dir, "events").select("user_id", "event_type"), ["user_id", "event_type"], ["event_type"])


@register("r1_melt", sql="""
SELECT p_partkey, 'p_name' AS key, p_name AS value FROM part
UNION ALL SELECT p_partkey, 'p_brand', p_brand FROM part
UNION ALL SELECT p_partkey, 'p_type', p_type FROM part
""")
def r1_melt(spark, sf_dir):
    """Wide -> long over every non-id column."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    return R.melt_except(p, ["p_partkey"], "key", "value")


@register("r2_widen", sql="""
SELECT user_id, nullif(count(*) FILTER (event_type = 'click'), 0) AS click, nullif(count(*) FILTER (event_type = 'error'), 0) AS error,
       nullif(count(*) FILTER (event_type = 'purchase'), 0) AS purchase, nullif(count(*) FILTER (event_type = 'signup'), 0) AS signup,
       nullif(count(*) FILTER (event_type = 'view'), 0) AS "view"
FROM events GROUP BY user_id
""")
def r2_widen(spark, sf_dir):
    """R2: long -> wide, one column per event type, null where a user has none."""
    e = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return R.widen(e, ["user_id"], "event_type", "n")


@register("r3_split_rows", sql="""
SELECT p_partkey, unnest(string_split(p_name, ' ')) AS p_name FROM part
""")
def r3_split_rows(spark, sf_dir):
    """Split a delimited cell into rows."""
    return R.split_rows(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_name", " ")


@register("r4_split_columns", sql="""
SELECT p_partkey, p_name, string_split(p_name, ' ')[1] AS w1,
       string_split(p_name, ' ')[2] AS w2, string_split(p_name, ' ')[3] AS w3
FROM part
""")
def r4_split_columns(spark, sf_dir):
    """Split a delimited cell into fixed columns (missing pieces null)."""
    return R.split_columns(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_name", " ", ["w1", "w2", "w3"])


# The words of the part names
PART_WORDS = ["anvil", "blue", "bolt", "cold", "gear", "gizmo", "hot", "large", "new", "old", "plate", "red", "ring",
              "rod", "small", "widget"]


@register("r5_tag_matrix", sql="SELECT p_partkey, p_brand, " + ", ".join(
    f"CASE WHEN list_contains(string_split(p_name, ' '), '{w}') THEN 1 END AS \"{w}\"" for w in PART_WORDS) + " FROM part")
def r5_tag_matrix(spark, sf_dir):
    """Tag matrix of part-name words (one indicator column per word)."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", F.col("p_name").alias("tags"))
    return R.tag_matrix(p, "p_partkey", "tags", order_by=["p_brand"])


# ---------------------------------------------------------------- set operations


@register("u1_stack", sql="""
SELECT c_custkey AS key, c_name AS name, c_nationkey AS nation FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier
""")
def u1_stack(spark, sf_dir):
    """Stack same-layout frames by position."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
                                                F.col("c_nationkey").alias("nation"))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return U.stack([c, s])


@register("u2_u3_stack_fill", sql="""
SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey AS key, s_name AS name, NULL AS segment FROM supplier
UNION ALL SELECT n_nationkey AS key, n_name AS name, NULL AS segment FROM nation
""")
def u2_u3_stack_fill(spark, sf_dir):
    """Stack by name; columns missing from a frame are null there."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
                                                F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("key"))
    n = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"),
                                              F.col("n_nationkey").cast("bigint").alias("key"))
    return U.stack_fill([c, U.stack_by_name([s, n])])


@register("u4_distinct", sql="""
SELECT DISTINCT l_returnflag, l_linestatus, l_tax FROM lineitem
""")
def u4_distinct(spark, sf_dir):
    """U4: distinct rows."""
    return U.distinct_rows(table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_tax"))


@register("u5_u6_unique_sorted", sql="""
SELECT DISTINCT p_type FROM part ORDER BY p_type
""")
def u5_u6_unique_sorted(spark, sf_dir):
    """Sorted distinct values of one column."""
    return U.sort_by(U.unique_sorted(table(spark, sf_dir, "part"), "p_type"), ["p_type"])


# Months of the orders, the columns of the block pivot below.
_MONTHS = [f"{y}{m:02d}" for y in range(1992, 1999) for m in range(1, 13)]


@register("r2_widen_blocks", sql="SELECT o_custkey, " + ", ".join(
    f"max(CASE WHEN strftime(o_orderdate, '%Y%m') = '{m}' THEN o_orderkey END) AS \"{m}\"" for m in _MONTHS) + " FROM orders GROUP BY o_custkey")
def r2_widen_blocks(spark, sf_dir):
    """R2: a column a month, the vocabulary dealt into blocks of 16."""
    o = table(spark, sf_dir, "orders").select("o_custkey", F.date_format("o_orderdate", "yyyyMM").alias("month"), "o_orderkey")
    return R.widen(o, ["o_custkey"], "month", "o_orderkey", vocab=_MONTHS, block=16)


@register("u6_locale_order", sql="""
WITH n AS (SELECT DISTINCT CASE p_partkey % 4 WHEN 0 THEN h WHEN 1 THEN upper(h) WHEN 2 THEN replace(h, 'e', chr(233)) ELSE replace(upper(h), 'E', chr(201)) END AS name
           FROM (SELECT p_partkey, md5(CAST(p_partkey AS VARCHAR))[1:3] AS h FROM part))
SELECT name, row_number() OVER (ORDER BY lower(strip_accents(name)), translate(lower(name), '0123456789abcdf' || chr(233), 'eeeeeeeeeeeeeeez'),
       regexp_replace(regexp_replace(name, '[^A-Z' || chr(201) || ']', '0', 'g'), '[^0]', '1', 'g')) AS row_id
FROM n
""")
def u6_locale_order(spark, sf_dir):
    """Distinct names numbered in a locale's order: letters, then accents, then case."""
    h = F.substring(F.md5(F.col("p_partkey").cast("string").cast("binary")), 1, 3)
    kind = F.col("p_partkey") % 4
    name = (F.when(kind == 0, h).when(kind == 1, F.upper(h)).when(kind == 2, F.replace(h, F.lit("e"), F.lit("é")))
            .otherwise(F.replace(F.upper(h), F.lit("E"), F.lit("É"))))
    names = U.unique_sorted(table(spark, sf_dir, "part").select(name.alias("name")), "name", collation="UNICODE")
    return W.add_row_id(names, [U.locale_order("name", "UNICODE"), F.col("name")])
