import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("SESSIONLAB_SCRATCH", tempfile.mkdtemp(prefix="sessionlab-tests-"))
    from sessionlab.session import get_spark
    s = get_spark("local[4]", 8, app_name="sessionlab-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmp_out():
    return tempfile.mkdtemp(prefix="sessionlab-out-")


# Rounds and trees of quick tests; the registered queries use the whole configuration.
QUICK_ROUNDS = {"gbt": 10, "rf": 20}


def reduced(config: dict) -> dict:
    import copy
    out = copy.deepcopy(config)
    for spec in out.values():
        name = "maxIter" if spec["kind"] == "gbt" else "numTrees"
        spec[name] = min(spec[name], QUICK_ROUNDS[spec["kind"]])
    return out
