"""Session helpers: one place for the settings every job relies on.

The library never creates a session behind the user's back; ``build_session`` is for
scripts, tests and the bench.  Jobs call ``checkpoint_dir`` / ``materialize`` when they
must cut lineage (range-partitioned row numbering, fan-out writes).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "landframe", extra: dict | None = None) -> SparkSession:
    """Session with AQE (coalescing + skew-join splitting) and a pinned UTC clock."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        # checkpoint files of frames no longer referenced are removed by the context cleaner
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only a session on a local master may leave the setting out: its own warehouse folder
    is used then.  On a cluster the setting must point at shared storage, so a missing
    value there is an error; no machine-local temporary folder is ever used.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at shared storage")
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: data written to the shared checkpoint folder, lineage cut.

    Survives executor loss (unlike a local checkpoint or a cache) and pins results of
    sampled steps such as range partitioning so later reads see the same rows.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
