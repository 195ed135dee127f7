"""Versioned tables (S6, S9): immutable data folders and a manifest written last.

A commit first writes its rows to a folder of its own, ``data/commit=<id>/release=<r>``, and
then one small manifest, ``manifests/<number>.json``, that names the folder of every release.
Readers take the latest complete manifest, so they never see half a version; a writer that
fails before its manifest leaves folders that nothing names.  Manifests are created
exclusively: of two writers that started from the same version, the later one takes the
other's manifest as its base and tries again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: release of a table that has none
WHOLE = "whole"


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _numbers(spark: SparkSession, root: str) -> list[int]:
    fs, folder = _path(spark, f"{root}/manifests")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _manifest(spark: SparkSession, root: str, number: int) -> dict | None:
    """A manifest, or None if its writer has not finished it."""
    fs, path = _path(spark, f"{root}/manifests/{number:08d}.json")
    stream = fs.open(path)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        found = json.loads(text)
    except json.JSONDecodeError:
        return None
    return found if found.get("complete") else None


def current_manifest(spark: SparkSession, root: str) -> dict:
    """The latest complete manifest; version 0 of a table never written is empty."""
    for number in reversed(_numbers(spark, root)):
        if (found := _manifest(spark, root, number)) is not None:
            return found
    return {"version": 0, "releases": {}, "schema": None, "batches": {}, "log": []}


def _create_manifest(spark: SparkSession, root: str, manifest: dict) -> bool:
    """Write a manifest unless another writer has taken its number."""
    fs, path = _path(spark, f"{root}/manifests/{manifest['version']:08d}.json")
    try:
        out = fs.create(path, False)
    except Exception:  # the file exists: the only failure that is no error
        if fs.exists(path):
            return False
        raise
    out.write(bytearray(json.dumps({**manifest, "complete": True}), "utf-8"))
    out.close()
    return True


def commit(df: DataFrame | None, root: str, release_col: str | None = None, removed: Sequence[str] = (), batch: tuple[str, int] | None = None,
           log: Sequence[dict] = (), keep_others: bool = True) -> int:
    """Make ``df``'s rows the content of their releases (one release, ``whole``, without
    ``release_col``) and return the new version.  Other releases stay unless ``keep_others`` is
    false; ``removed`` ones go.  ``batch`` (job, number) and ``log`` go into the same manifest, so
    they are committed with the data or not at all; ``df`` None commits only those.

    A release without rows in ``df`` is not touched (name it in ``removed`` to empty it)."""
    spark = df.sparkSession if df is not None else SparkSession.active()
    name, releases, schema = uuid.uuid4().hex, [], None
    if df is not None:
        rows = df.withColumn("release", F.col(f"`{release_col}`").cast("string") if release_col else F.lit(WHOLE))
        rows.write.partitionBy("release").parquet(f"{root}/data/commit={name}")
        schema = rows.schema
        written = spark.read.schema(T.StructType([T.StructField("release", T.StringType())])).parquet(f"{root}/data/commit={name}")
        releases = [r["release"] for r in written.select("release").distinct().collect()]
    while True:
        base = current_manifest(spark, root)
        taken = max([base["version"], *_numbers(spark, root)])
        kept = {r: c for r, c in base["releases"].items() if keep_others and r not in removed}
        manifest = {**base, "version": taken + 1, "releases": {**kept, **dict.fromkeys(releases, name)},
                    "log": [*base["log"], *log], "batches": {**base["batches"], **({batch[0]: batch[1]} if batch else {})}}
        if schema is not None:
            manifest["schema"] = schema.json()
        if _create_manifest(spark, root, manifest):
            return taken + 1


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The table at a version (the latest by default), with its ``release``."""
    found = current_manifest(spark, root) if version is None else _manifest(spark, root, version)
    if found is None or found["schema"] is None:
        raise ValueError(f"no version {version or ''} of {root}")
    schema = T.StructType.fromJson(json.loads(found["schema"]))
    folders = [f"{root}/data/commit={c}/release={r}" for r, c in sorted(found["releases"].items())]
    if not folders:
        return spark.createDataFrame([], schema)
    table = T.StructType([*schema.fields, T.StructField("commit", T.StringType())])
    return spark.read.schema(table).option("basePath", f"{root}/data").parquet(*folders).drop("commit").select(*[f"`{f.name}`" for f in schema])


def unnamed_commits(spark: SparkSession, root: str) -> list[str]:
    """Data folders that no manifest names: of writers that failed, or have not finished."""
    named = {c for n in _numbers(spark, root) for c in ((_manifest(spark, root, n) or {"releases": {}})["releases"].values())}
    fs, folder = _path(spark, f"{root}/data")
    if not fs.exists(folder):
        return []
    commits = [s.getPath().getName().removeprefix("commit=") for s in fs.listStatus(folder)]
    return sorted(c for c in commits if c not in named)
