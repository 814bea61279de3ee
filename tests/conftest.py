import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"

SF = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from prefmill.session import build

    s = build("tests", cpus=4, partitions=4, driver_memory="3g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    if not SF.exists():
        pytest.skip("the driver's tables are not here")
    return str(SF)
