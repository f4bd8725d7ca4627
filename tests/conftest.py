import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from stratum.session import checkpoint_dir, local_session

    shared = {"spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints"))}  # stands for the shared folder
    s = local_session(4, shuffle_partitions=8, app="stratum-tests", conf=shared)
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


@pytest.fixture(scope="session")
def taxi():
    from stratum import manifest as mf

    return mf.builtin("taxi")
