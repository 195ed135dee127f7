"""Registered source/sink and load-check queries (S*, Q*).

Round-trip queries write the driver's rows in the job's file layout into the shared
checkpoint folder (never a machine-local temp folder), read them back through the
library's readers, and return the rows read.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import functions as F

from landframe.operators import quality as Q
from landframe.plans.registry import register
from landframe.plans.tables import table
from landframe.session import checkpoint_dir
from landframe.sources import files as S
from landframe.sources import versions
from landframe.sources.release import releases_to_ingest
from landframe.streaming.ingest import ingest_log, publish_batch


def _scratch(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/landframe-io/{name}-{uuid.uuid4().hex}"


# The external names list applied to the headerless order extract.
ORDER_NAMES = ["ORDER_ID", "CUSTOMER", "STATUS", "PRIORITY", "ORDER_DATE"]


@register("s1_headerless", sql="""
SELECT CAST(o_orderkey AS VARCHAR) AS ORDER_ID, CAST(o_custkey AS VARCHAR) AS CUSTOMER,
       o_orderstatus AS STATUS, o_orderpriority AS PRIORITY, strftime(o_orderdate, '%Y-%m-%d') AS ORDER_DATE,
       'part' AS src_kind
FROM orders
""")
def s1_headerless(spark, sf_dir):
    """Orders written as several headerless CSV files, read back as text with
    external names and provenance."""
    o = table(spark, sf_dir, "orders")
    text = o.select(*[F.col(c).cast("string") for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")],
                    F.date_format("o_orderdate", "yyyy-MM-dd"))
    path = _scratch(spark, "headerless")
    text.repartition(4).write.option("header", False).csv(path)
    df = S.read_headerless(spark, path, ORDER_NAMES, provenance=True)
    return df.select(*ORDER_NAMES, F.regexp_extract("tile", "^(part)-", 1).alias("src_kind"))


_RAGGED_SQL = """
WITH o AS (SELECT CAST(o_orderkey AS VARCHAR) AS k, CAST(o_custkey AS VARCHAR) AS c, o_orderstatus AS s, o_orderpriority AS p,
           strftime(o_orderdate, '%Y-%m-%d') AS d, o_orderkey % 8 AS kind FROM orders)"""


def _ragged_orders(spark, sf_dir):
    """Orders as lines of files: every eighth has a field too many, the next ones three fields, a
    quoted line break, a quoted separator and quote; all others are plain."""
    o = table(spark, sf_dir, "orders")
    kind = F.col("o_orderkey") % 8
    k, c = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    day, join = F.date_format("o_orderdate", "yyyy-MM-dd"), lambda *parts: F.concat_ws(",", *parts)
    line = (F.when(kind == 0, join(k, c, "o_orderstatus", "o_orderpriority", day, F.lit("EXTRA")))
            .when(kind == 1, join(k, c, F.lit("short")))
            .when(kind == 2, join(k, c, "o_orderstatus", F.concat(F.lit('"'), "o_orderpriority", F.lit('\nnext line"')), day))
            .when(kind == 3, join(k, c, "o_orderstatus", F.concat(F.lit('"a, ""b"" '), "o_orderpriority", F.lit('"')), day))
            .otherwise(join(k, c, "o_orderstatus", "o_orderpriority", day)))
    path = _scratch(spark, "ragged")
    o.select(line.alias("value"), (kind == 2).alias("broken")).repartition(6, "broken").select("value").write.text(path)
    return path


@register("s1_rejects", sql=_RAGGED_SQL + """
SELECT 'loaded' AS kept, k AS "ORDER_ID", c AS "CUSTOMER", s AS "STATUS",
       CASE kind WHEN 2 THEN p || chr(10) || 'next line' WHEN 3 THEN 'a, "b" ' || p ELSE p END AS "PRIORITY", d AS "ORDER_DATE",
       CAST(NULL AS VARCHAR) AS record, CAST(NULL AS INTEGER) AS n_fields, CAST(NULL AS VARCHAR) AS reason FROM o WHERE kind > 1
UNION ALL
SELECT 'rejected', NULL, NULL, NULL, NULL, NULL, CASE kind WHEN 0 THEN concat_ws(',', k, c, s, p, d, 'EXTRA') ELSE concat_ws(',', k, c, 'short') END,
       CASE kind WHEN 0 THEN 6 ELSE 3 END, CASE kind WHEN 0 THEN 'too many fields' ELSE 'too few fields' END FROM o WHERE kind < 2
""")
def s1_rejects(spark, sf_dir):
    """Ragged records go to the reject output, quoted line breaks stay in their field."""
    rows, bad = S.read_headerless_checked(spark, _ragged_orders(spark, sf_dir), ORDER_NAMES)
    none = lambda *names: [F.lit(None).cast("string").alias(n) for n in names]
    good = rows.select(F.lit("loaded").alias("kept"), *ORDER_NAMES, *none("record"), F.lit(None).cast("int").alias("n_fields"), *none("reason"))
    return good.unionByName(bad.select(F.lit("rejected").alias("kept"), *none(*ORDER_NAMES), "record", "n_fields", "reason"))


@register("s1_load_counts", sql="""
SELECT count(*) FILTER (o_orderkey % 8 > 1) AS loaded, count(*) FILTER (o_orderkey % 8 <= 1) AS rejected FROM orders
""")
def s1_load_counts(spark, sf_dir):
    """Loaded and rejected records, both written; together they are the files' records."""
    path = _ragged_orders(spark, sf_dir)
    return S.load_headerless(spark, path, ORDER_NAMES, f"{path}-loaded", f"{path}-rejected")


@register("s3_s4_features", sql="""
SELECT p_partkey, p_name, p_size, p_retailprice, 'part' AS src_kind FROM part
""")
def s3_s4_features(spark, sf_dir):
    """Parts written as XML feature files, one layer read back by row tag with
    a declared schema and provenance columns."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    path = _scratch(spark, "features")
    p.repartition(3).write.format("xml").option("rowTag", "TopographicArea").option("rootTag", "features").save(path)
    schema = "p_partkey bigint, p_name string, p_size int, p_retailprice double"
    df = S.read_features(spark, path, "TopographicArea", schema)
    return df.select("p_partkey", "p_name", "p_size", "p_retailprice",
                     F.regexp_extract("tile", "^(part)-", 1).alias("src_kind"))


@register("s2_read_csv", sql="""
SELECT c_custkey, c_name, NULLIF(c_mktsegment, 'BUILDING') AS c_mktsegment FROM customer
""")
def s2_read_csv(spark, sf_dir):
    """Header CSV with a custom null token (here ``BUILDING`` stands for missing)."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    path = _scratch(spark, "csv")
    c.repartition(2).write.option("header", True).csv(path)
    return S.read_csv(spark, path, null_value="BUILDING",
                      schema="c_custkey bigint, c_name string, c_mktsegment string")


@register("s6_release_partitions", sql="""
SELECT o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y%m') AS release FROM orders
""")
def s6_release_partitions(spark, sf_dir):
    """Orders written partitioned by release month, 1997 releases then re-written
    (dynamic overwrite keeps the others), all read back."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus",
                                              F.date_format("o_orderdate", "yyyyMM").alias("release"))
    path = _scratch(spark, "releases")
    S.write_release(o, path)
    S.write_release(o.filter(F.col("release").startswith("1997")), path)
    back = spark.read.schema("o_orderkey bigint, o_orderstatus string, release string").parquet(path)
    return back.select("o_orderkey", "o_orderstatus", "release")


@register("s10_releases_to_ingest", sql="""
SELECT o_orderkey AS release, o_orderpriority AS product, strftime(o_orderdate, '%-d %B %Y') AS update_date
FROM orders o
WHERE contains(o_orderpriority, 'URGENT') AND CAST(o_orderdate AS DATE) = DATE '1997-07-10'
  AND NOT EXISTS (SELECT 1 FROM orders d WHERE d.o_orderstatus = 'F' AND d.o_orderkey = o.o_orderkey)
""")
def s10_releases_to_ingest(spark, sf_dir):
    """Releases of the wanted product updated on the run date, minus those done."""
    o = table(spark, sf_dir, "orders")
    rel = o.select(F.col("o_orderkey").alias("release"), F.col("o_orderpriority").alias("product"),
                   F.date_format("o_orderdate", "d MMMM yyyy").alias("update_date"))
    done = o.filter(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("release"))
    return releases_to_ingest(rel, _dt.date(1997, 7, 10), "URGENT", done)


@register("q1_duplicate_keys", sql="""
SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1
""")
def q1_duplicate_keys(spark, sf_dir):
    """Q1: key values occurring more than once (order key is not unique in lines)."""
    return Q.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey"])


@register("q1_unique_orders", sql="""
SELECT o_orderkey, count(*) AS n FROM orders GROUP BY o_orderkey HAVING count(*) > 1
""")
def q1_unique_orders(spark, sf_dir):
    """Q1: the primary-key check on orders (empty when the key is unique)."""
    return Q.duplicate_keys(table(spark, sf_dir, "orders"), ["o_orderkey"])


@register("q2_q3_gate", sql="""
SELECT 'lineitem' AS "table", count(*) AS n_rows, true AS present,
       CASE WHEN count(*) > 1000 THEN 'SUCCESSFUL' ELSE 'FAILED' END AS status
FROM lineitem
""")
def q2_q3_gate(spark, sf_dir):
    """Q2/Q3: minimum-rows gate and the status record for a loaded table."""
    path = f"{sf_dir.rstrip('/')}/lineitem.parquet"
    return Q.row_gate(table(spark, sf_dir, "lineitem"), "lineitem", 1000, Q.table_present(spark, path))


@register("s9_append_period", sql="""
SELECT n.n_name AS NAME, CAST(n.n_regionkey AS VARCHAR) AS MAR, CAST(c.c_custkey AS VARCHAR) AS APR
FROM nation n JOIN customer c ON c.c_nationkey = n.n_nationkey
""")
def s9_append_period(spark, sf_dir):
    """This period's value added to a running history as a column named after
    the period (update merged on the name, unwanted update columns dropped)."""
    n = table(spark, sf_dir, "nation")
    history = n.select(F.col("n_name").alias("NAME"), F.col("n_regionkey").cast("string").alias("MAR"))
    c = table(spark, sf_dir, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    update = c.select(F.col("n_name").alias("BOROUGH"), F.col("c_custkey").cast("string").alias("REGISTERED"),
                      F.col("c_mktsegment").alias("BRONZE"), F.col("c_acctbal").alias("GOLD"))
    from landframe.operators.columns import period_name
    return S.append_period_column(history, update, "NAME", "BOROUGH", "REGISTERED",
                                  period_name(_dt.date(2017, 4, 3)), drop=["BRONZE", "GOLD"])


@register("q3_load_status", sql="""
SELECT 'lineitem' AS "table", pending, n_rows,
       CASE WHEN pending = 0 THEN 'NO UPDATE' WHEN n_rows > 1000 THEN 'SUCCESSFUL' ELSE 'FAILED' END AS status
FROM (SELECT
        (SELECT count(*) FROM orders o WHERE contains(o_orderpriority, 'URGENT')
           AND CAST(o_orderdate AS DATE) = DATE '1997-07-10'
           AND NOT EXISTS (SELECT 1 FROM orders d WHERE d.o_orderstatus = 'F' AND d.o_orderkey = o.o_orderkey)) AS pending,
        (SELECT count(*) FROM lineitem) AS n_rows)
""")
def q3_load_status(spark, sf_dir):
    """Q3: status of a run: releases waiting (S10 gate) and rows loaded."""
    pending = s10_releases_to_ingest(spark, sf_dir)
    return Q.load_status(pending, table(spark, sf_dir, "lineitem"), "lineitem", 1000)


@register("s6_versions", sql="""
SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1997 THEN 'corrected' ELSE o_orderstatus END AS o_orderstatus, strftime(o_orderdate, '%Y%m') AS release
FROM orders WHERE year(o_orderdate) <> 1998
""")
def s6_versions(spark, sf_dir):
    """Orders committed by release month; 1997 replaced and 1998 removed by later versions,
    each published by its manifest alone."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.date_format("o_orderdate", "yyyyMM").alias("release"))
    root = _scratch(spark, "versions")
    versions.commit(o, root, "release")
    versions.commit(o.filter(F.col("release").startswith("1997")).withColumn("o_orderstatus", F.lit("corrected")), root, "release")
    versions.commit(None, root, removed=[f"1998{m:02d}" for m in range(1, 13)])
    return versions.read_version(spark, root)


_STREAM_SQL = """
WITH r AS (SELECT strftime(o_orderdate, '%Y%m') AS release, count(*) AS n_rows FROM orders GROUP BY 1),
due AS (SELECT * FROM r WHERE CAST(release AS INTEGER) % 2 = 1 AND (release = '199507' OR release LIKE '1997%')),
least AS (SELECT avg(n_rows) AS least FROM r)"""


def _streamed(spark, sf_dir):
    """Orders delivered as a file a month; odd months are of the wanted product.  July 1995 is
    updated on the run's date, 1997 is on the backfill list; below the mean of all months a
    release is too small."""
    o = table(spark, sf_dir, "orders")
    month = F.date_format("o_orderdate", "yyyyMM")
    folder, root = _scratch(spark, "delivered"), _scratch(spark, "published")
    o.select(F.col("o_orderkey").cast("string"), "o_orderstatus", month.alias("m")).repartition("m").write.partitionBy("m").csv(f"{folder}/files")
    counts = o.groupBy(month.alias("release")).agg(F.count(F.lit(1)).alias("n"))
    announced = counts.select("release", F.when(F.col("release").cast("int") % 2 == 1, "Address Plus").otherwise("Address Core").alias("product"),
                              F.when(F.col("release") == "199507", "3 April 2017").otherwise("4 April 2017").alias("update_date"))
    least = int(counts.agg(F.avg("n")).first()[0])
    rows = (spark.readStream.schema("o_orderkey string, o_orderstatus string, m string").csv(f"{folder}/files")
            .withColumn("file", F.concat(F.lit("orders_"), "m")).drop("m"))
    backfill = [f"1997{m:02d}" for m in range(1, 13)]

    def each(batch, batch_id):
        publish_batch(batch, batch_id, announced, root, "orders", _dt.date(2017, 4, 3), "Plus", backfill, least)
        publish_batch(batch, batch_id, announced, root, "orders", _dt.date(2017, 4, 3), "Plus", backfill, least)  # replayed

    w = rows.writeStream.foreachBatch(each).option("checkpointLocation", f"{folder}/checkpoint")
    w.trigger(availableNow=True).start().awaitTermination()
    return root


@register("s10_gated_stream", sql=_STREAM_SQL + """
SELECT release, n_rows, CASE WHEN n_rows > floor(least) THEN 'SUCCESSFUL' ELSE 'FAILED' END AS status FROM due, least
""")
def s10_gated_stream(spark, sf_dir):
    """Status of every release that was due when the stream ran over all delivered files."""
    return ingest_log(spark, _streamed(spark, sf_dir)).select("release", "n_rows", "status")


@register("s10_published_rows", sql=_STREAM_SQL + """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y%m') AS release FROM orders
WHERE strftime(o_orderdate, '%Y%m') IN (SELECT release FROM due, least WHERE n_rows > floor(least))
""")
def s10_published_rows(spark, sf_dir):
    """The rows that the stream published, those of small and unwanted releases not."""
    return versions.read_version(spark, _streamed(spark, sf_dir))
