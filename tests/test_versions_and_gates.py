"""Versioned commits and the gated stream: readers see whole versions, batches count once."""

import datetime as dt
import os
import uuid

import pytest

from landframe.session import checkpoint_dir
from landframe.sources import versions
from landframe.streaming.ingest import ingest_gated, ingest_log, publish_batch


def local(path):
    return path[len("file:"):] if path.startswith("file:") else path


@pytest.fixture()
def root(spark):
    return f"{local(checkpoint_dir(spark)).rstrip('/')}/versions-{uuid.uuid4().hex}"


def table(spark, rows):
    return spark.createDataFrame(rows, "id long, month string")


def content(spark, root, version=None):
    return sorted((r.id, r.release) for r in versions.read_version(spark, root, version).collect())


def test_releases_are_replaced_as_a_whole(spark, root):
    assert versions.commit(table(spark, [(1, "201701"), (2, "201702")]), root, "month") == 1
    assert versions.commit(table(spark, [(3, "201702"), (4, "201703")]), root, "month") == 2
    assert content(spark, root) == [(1, "201701"), (3, "201702"), (4, "201703")]
    assert content(spark, root, 1) == [(1, "201701"), (2, "201702")]  # earlier versions stay readable
    versions.commit(None, root, removed=["201701"])
    assert content(spark, root) == [(3, "201702"), (4, "201703")]
    versions.commit(table(spark, [(9, "x")]), root, keep_others=False)
    assert content(spark, root) == [(9, "whole")]


def test_a_writer_that_fails_before_its_manifest_changes_nothing(spark, root, monkeypatch):
    versions.commit(table(spark, [(1, "a")]), root, "month")
    create = versions._create_manifest

    def fail(*_):
        raise OSError("lost")

    monkeypatch.setattr(versions, "_create_manifest", fail)
    with pytest.raises(OSError):
        versions.commit(table(spark, [(2, "a")]), root, "month")
    assert content(spark, root) == [(1, "a")] and len(versions.unnamed_commits(spark, root)) == 1
    monkeypatch.setattr(versions, "_create_manifest", create)
    assert versions.commit(table(spark, [(2, "a")]), root, "month") == 2 and content(spark, root) == [(2, "a")]


def test_a_manifest_cut_short_is_no_version(spark, root):
    versions.commit(table(spark, [(1, "a")]), root, "month")
    with open(f"{root}/manifests/00000002.json", "w") as f:
        f.write('{"version": 2, "releases": {"a"')
    assert content(spark, root) == [(1, "a")]
    assert versions.commit(table(spark, [(5, "b")]), root, "month") == 3 and content(spark, root) == [(1, "a"), (5, "b")]


def test_of_two_writers_both_get_in(spark, root, monkeypatch):
    versions.commit(table(spark, [(1, "a")]), root, "month")
    create, raced = versions._create_manifest, []

    def late(spark_, root_, manifest):
        if not raced:  # another writer is faster with the same number
            raced.append(versions._manifest)
            assert create(spark_, root_, {**versions.current_manifest(spark_, root_), "version": manifest["version"], "log": [{"other": 1}]})
        return create(spark_, root_, manifest)

    monkeypatch.setattr(versions, "_create_manifest", late)
    assert versions.commit(table(spark, [(2, "b")]), root, "month") == 3
    assert versions.current_manifest(spark, root)["log"] == [{"other": 1}] and content(spark, root) == [(1, "a"), (2, "b")]


def test_table_never_written(spark, root):
    with pytest.raises(ValueError):
        versions.read_version(spark, root)
    assert versions.unnamed_commits(spark, root) == []


def announced(spark):
    return spark.createDataFrame([("201704", "Address Plus", "3 April 2017"), ("201703", "Address Plus", "1 March 2017"),
                                  ("201702", "Address Plus", "1 February 2017"), ("201701", "Address Core", "3 April 2017")],
                                 "release string, product string, update_date string")


def batch(spark, *deliveries):
    rows = [(str(i), f"/in/addresses_{release}_{k}.csv") for release, n in deliveries for k in range(2) for i in range(n // 2)]
    return spark.createDataFrame(rows, "UPRN string, file string")


def test_gates_of_a_batch(spark, root):
    args = (announced(spark), root, "job", dt.date(2017, 4, 3), "Plus", ["201703"], 10)
    publish_batch(batch(spark, ("201704", 40), ("201703", 10), ("201702", 40), ("201701", 40), ("209901", 40)), 0, *args)
    log = [(r.release, r.n_rows, r.status) for r in ingest_log(spark, root).orderBy("release").collect()]
    assert log == [("201703", 10, "FAILED"), ("201704", 40, "SUCCESSFUL")]
    assert {r.release for r in versions.read_version(spark, root).collect()} == {"201704"}
    before = versions.current_manifest(spark, root)
    publish_batch(batch(spark, ("201704", 80)), 0, *args)  # replayed
    assert versions.current_manifest(spark, root) == before
    publish_batch(batch(spark, ("201704", 80), ("201703", 12)), 1, *args)  # the small one again, complete
    assert versions.read_version(spark, root).groupBy("release").count().orderBy("release").collect() == [("201703", 12), ("201704", 40)]
    publish_batch(batch(spark, ("201701", 80)), 2, *args)
    assert [r.status for r in ingest_log(spark, root).orderBy("batch").collect()][-1] == "NO UPDATE"


def test_stream_takes_each_release_once(spark, root):
    os.makedirs(f"{root}/in")

    def deliver(name, n):
        with open(f"{root}/in/{name}.csv", "w") as f:
            f.write("".join(f"{i},{i}\n" for i in range(n)))

    def run():
        ingest_gated(spark, f"{root}/in", ["UPRN", "X"], lambda: announced(spark), f"{root}/out", f"gated-{root[-32:]}", dt.date(2017, 4, 3), "Plus", min_rows=5)

    deliver("addresses_201704", 20)
    deliver("addresses_201701", 20)
    run()
    run()
    assert versions.read_version(spark, f"{root}/out").count() == 20
    deliver("more_201704", 50)  # published already
    run()
    assert versions.read_version(spark, f"{root}/out").count() == 20
    assert [(r.release, r.status) for r in ingest_log(spark, f"{root}/out").orderBy("batch").collect()] == [("201704", "SUCCESSFUL"), (None, "NO UPDATE")]
