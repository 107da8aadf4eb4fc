import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from ledgerline.session import build_session

    shared = tmp_path_factory.mktemp("shared")
    places = {"spark.checkpoint.dir": f"{shared}/checkpoints", "spark.sql.warehouse.dir": f"{shared}/warehouse"}
    session = build_session(master="local[*]", shuffle_partitions=8, extra=places)
    yield session
    session.stop()
