import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from veilspark.session import build_session

    base = tempfile.mkdtemp(prefix="veilspark-test-")
    s = build_session(
        "local[4]",
        app="veilspark-tests",
        shuffle_partitions=4,
        conf={
            "spark.sql.warehouse.dir": f"{base}/warehouse",
            "spark.checkpoint.dir": f"{base}/checkpoints",
            "spark.driver.memory": "4g",
        },
    )
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
