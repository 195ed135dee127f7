"""Stand-in inputs: rows in the schema a job expects, built from the driver's tables.

These only rename, cast and lay out columns (plus the joins needed to fetch a column
from a related table).  They do none of the job's own work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landframe.plans.tables import table

# Schema of the population stand-in: one value column per year present in ``orders``.
POPULATION_YEARS = tuple(str(y) for y in range(1995, 2002))


def population_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide "population" table: (area, district, age, one column per year).

    One row per order: area = customer nation, district = order status, age = order
    priority, and the order's total price (exact decimal) under its own year column,
    0 under the others.
    """
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = o.join(c, o.o_custkey == c.c_custkey)
    yr = F.year("o_orderdate").cast("string")
    val = F.col("o_totalprice").cast("decimal(18,2)")
    years = [F.when(yr == y, val).otherwise(F.lit(0).cast("decimal(18,2)")).alias(y) for y in POPULATION_YEARS]
    return j.select(F.col("c_nationkey").alias("area"), F.col("o_orderstatus").alias("district"),
                    F.col("o_orderpriority").alias("age"), *years)
