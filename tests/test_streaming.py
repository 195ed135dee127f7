"""S10 on Structured Streaming: each release file is ingested exactly once."""

import os
import uuid

from landframe.session import checkpoint_dir
from landframe.streaming.ingest import ingest_available


def _local(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def test_ingest_each_file_once(spark):
    root = f"{_local(checkpoint_dir(spark)).rstrip('/')}/test-stream-{uuid.uuid4().hex}"
    src, out = f"{root}/in", f"{root}/out"
    os.makedirs(src)
    names = ["UPRN", "X", "Y"]

    def drop(name, rows):
        with open(f"{src}/{name}.csv", "w") as f:
            f.write("".join(",".join(r) + "\n" for r in rows))

    drop("a", [("1", "10", "20"), ("2", "11", "21")])
    drop("b", [("3", "12", "22")])
    ingest_available(spark, src, names, out, job=f"t-{uuid.uuid4().hex}")
    assert spark.read.parquet(out).count() == 3
    job = f"t2-{uuid.uuid4().hex}"
    out2 = f"{root}/out2"
    ingest_available(spark, src, names, out2, job=job)
    drop("c", [("4", "13", "23")])
    ingest_available(spark, src, names, out2, job=job)
    got = sorted(r.UPRN for r in spark.read.parquet(out2).collect())
    assert got == ["1", "2", "3", "4"]
