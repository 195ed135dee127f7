"""S10 on Structured Streaming: gated ingest of release files, each release exactly once.

The file source's checkpointed log picks every file up once; ``trigger(availableNow=True)``
runs the stream as a scheduled job that takes what has arrived and stops.  Each batch goes
through the release gate (wanted product, updated on the run's date or on the backfill list,
not yet published) and the row gate (Q2), and what passes is committed together with the
batch's number and status rows in one manifest (``sources.versions``): a batch that is
replayed finds its number and changes nothing.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landframe.operators.quality import FAILED, NO_UPDATE, SUCCESSFUL
from landframe.session import checkpoint_dir, materialize
from landframe.sources import versions
from landframe.sources.files import text_schema
from landframe.sources.release import releases_to_ingest


def stream_headerless(spark: SparkSession, folder: str, names: Sequence[str], sep: str = ",") -> DataFrame:
    """Streaming S1: new headerless files in ``folder`` as all-text rows + source path."""
    df = (spark.readStream.schema(text_schema(names)).option("header", False).option("sep", sep)
          .csv(folder))
    return df.withColumn("file", F.col("_metadata.file_path"))


def ingest_available(spark: SparkSession, folder: str, names: Sequence[str], out: str, job: str,
                     transform: Callable[[DataFrame], DataFrame] = lambda d: d,
                     partition_by: Sequence[str] = ()) -> None:
    """Process every file not yet ingested, append the result to ``out`` (Parquet), stop.  No
    gate: for folders that hold nothing but wanted files."""
    src = transform(stream_headerless(spark, folder, names))
    ckpt = f"{checkpoint_dir(spark).rstrip('/')}/streams/{job}"
    w = src.writeStream.format("parquet").option("checkpointLocation", ckpt).outputMode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.trigger(availableNow=True).start(out)
    q.awaitTermination()


def wanted_releases(announced: DataFrame, as_of: _dt.date, product: str, backfill: Sequence[str], done: Sequence[str]) -> DataFrame:
    """Announced releases (``release, product, update_date``) of the product, updated on
    ``as_of`` or on the backfill list, that are not ``done``."""
    spark = announced.sparkSession
    known = spark.createDataFrame([(r,) for r in done], "release string")
    due = releases_to_ingest(announced, as_of, product, known).select("release")
    late = announced.filter(F.contains("product", F.lit(product)) & F.col("release").isin(list(backfill))).join(known, "release", "left_anti")
    return due.unionByName(late.select("release")).distinct()


def publish_batch(rows: DataFrame, batch_id: int, announced: DataFrame, root: str, job: str, as_of: _dt.date, product: str,
                  backfill: Sequence[str] = (), min_rows: int = 1000, release_pattern: str = r"(\d{6})") -> None:
    """One batch of ``rows`` (with their ``file``, whose name holds the release) through the gates.

    Of the releases that are due, those with more than ``min_rows`` rows are published
    (SUCCESSFUL), the others are not (FAILED, and due again when delivered anew); a batch
    without a due release is logged as NO UPDATE.  A batch already committed is left alone.
    """
    spark = rows.sparkSession
    state = versions.current_manifest(spark, root)
    if batch_id <= state["batches"].get(job, -1):
        return
    stamped = rows.withColumn("release", F.regexp_extract(F.element_at(F.split("file", "/"), -1), release_pattern, 1)).drop("file")
    due = wanted_releases(announced, as_of, product, backfill, list(state["releases"]))
    # written once: counted, then published
    kept = materialize(stamped.join(F.broadcast(due), "release", "left_semi"))
    counts = {r["release"]: r["n"] for r in kept.groupBy("release").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a release
    good = [r for r, n in sorted(counts.items()) if n > min_rows]
    log = [{"job": job, "batch": batch_id, "release": r, "n_rows": n, "status": SUCCESSFUL if r in good else FAILED} for r, n in sorted(counts.items())]
    log = log or [{"job": job, "batch": batch_id, "release": None, "n_rows": 0, "status": NO_UPDATE}]
    out = kept.filter(F.col("release").isin(good)) if good else None
    versions.commit(out, root, "release", batch=(job, batch_id), log=log)


def ingest_gated(spark: SparkSession, folder: str, names: Sequence[str], announced: Callable[[], DataFrame], root: str, job: str,
                 as_of: _dt.date, product: str, backfill: Sequence[str] = (), min_rows: int = 1000) -> None:
    """Every release file not yet seen through ``publish_batch``, then stop."""
    def each(batch: DataFrame, batch_id: int) -> None:
        publish_batch(batch, batch_id, announced(), root, job, as_of, product, backfill, min_rows)

    w = stream_headerless(spark, folder, names).writeStream.foreachBatch(each)
    w = w.option("checkpointLocation", f"{checkpoint_dir(spark).rstrip('/')}/streams/{job}")
    w.trigger(availableNow=True).start().awaitTermination()


def ingest_log(spark: SparkSession, root: str) -> DataFrame:
    """Q3: the status rows of all batches: ``job, batch, release, n_rows, status``."""
    rows = [(e["job"], e["batch"], e["release"], e["n_rows"], e["status"]) for e in versions.current_manifest(spark, root)["log"]]
    return spark.createDataFrame(rows, "job string, batch long, release string, n_rows long, status string")
