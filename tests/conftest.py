import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from parcelstream.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    s.conf.set("spark.sql.streaming.stateStore.providerClass",
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield s
    s.stop()


@pytest.fixture()
def scratch(tmp_path_factory):
    return str(tmp_path_factory.mktemp("run"))
