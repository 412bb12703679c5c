from __future__ import annotations

import sys
import time
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerloom.session import local_session

    s = local_session(cores=4, shuffle_partitions=4, app="ledgerloom-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def sf_small():
    if not Path(SF_SMALL).is_dir():
        pytest.skip("benchmark tables not available")
    return SF_SMALL


@pytest.fixture
def shuffles_left(spark):
    """Bytes of the shuffle files that are there and were not when the test began, once they are at most ``most``: they are
    removed some moments after they are given up."""

    def files():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {n for n in blocks.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in n}

    before = files()

    def left(most=0):
        for _ in range(50):
            size = sum(Path(n).stat().st_size for n in files() - before if Path(n).exists())
            if size <= most:
                break
            time.sleep(0.1)
        return size

    return left
