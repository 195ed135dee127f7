"""Load checks (Q1-Q3): computed as small aggregates; nothing is collected but a count."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The three outcomes a load run records.
SUCCESSFUL, FAILED, NO_UPDATE = "SUCCESSFUL", "FAILED", "NO UPDATE"


def duplicate_keys(df: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    """Q1: key values that occur more than once (must be empty for a primary key)."""
    return (df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias(out))
            .filter(F.col(f"`{out}`") > 1))


def row_gate(df: DataFrame, name: str, min_rows: int = 1000, present: bool = True) -> DataFrame:
    """Q2/Q3: one status row ``(table, n_rows, present, status)``: SUCCESSFUL when the
    table is present and has more than ``min_rows`` rows, else FAILED."""
    agg = df.agg(F.count(F.lit(1)).alias("n_rows"))
    ok = F.lit(present) & (F.col("n_rows") > min_rows)
    return agg.select(F.lit(name).alias("table"), "n_rows", F.lit(present).alias("present"),
                      F.when(ok, F.lit(SUCCESSFUL)).otherwise(F.lit(FAILED)).alias("status"))


def load_status(pending: DataFrame, loaded: DataFrame, name: str, min_rows: int = 1000) -> DataFrame:
    """Q3: the run's status row ``(table, pending, n_rows, status)``: NO UPDATE when no
    release was waiting, otherwise SUCCESSFUL when the loaded table has more than
    ``min_rows`` rows, else FAILED.  Both counts come from one aggregate over a union
    of the two inputs' row markers (no join of one-row frames)."""
    marks = pending.select(F.lit(1).alias("p"), F.lit(0).alias("l")).unionByName(
        loaded.select(F.lit(0).alias("p"), F.lit(1).alias("l")))
    agg = marks.agg(F.coalesce(F.sum("p"), F.lit(0)).cast("long").alias("pending"),
                    F.coalesce(F.sum("l"), F.lit(0)).cast("long").alias("n_rows"))
    status = (F.when(F.col("pending") == 0, F.lit(NO_UPDATE))
              .when(F.col("n_rows") > min_rows, F.lit(SUCCESSFUL)).otherwise(F.lit(FAILED)))
    return agg.select(F.lit(name).alias("table"), "pending", "n_rows", status.alias("status"))


def table_present(spark: SparkSession, name_or_path: str) -> bool:
    """Q2: catalog table or readable path exists (driver-side metadata check)."""
    if "/" not in name_or_path and spark.catalog.tableExists(name_or_path):
        return True
    try:
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(name_or_path)
        return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    except Exception:
        return False


def status_record(spark: SparkSession, job: str, status: str, as_of: _dt.date, detail: str = "") -> DataFrame:
    """Q3: one audit row to append to the run-log table."""
    return spark.createDataFrame([(job, status, as_of, detail)], "job string, status string, as_of date, detail string")
