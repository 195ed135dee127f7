import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from landframe.plans import load_all
    from landframe.session import build_session
    load_all()
    folder = str(tmp_path_factory.mktemp("checkpoints"))
    s = build_session(master="local[*]", shuffle_partitions=8, extra={"spark.checkpoint.dir": folder})
    yield s
    s.stop()
