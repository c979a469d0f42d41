import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join([sys.path[0], os.environ.get("PYTHONPATH", "")])

from tessera.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    os.environ.setdefault("BENCH_CPUS", "4")
    s = get_spark("tests", cpus="4", memory="6g", shuffle=4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
