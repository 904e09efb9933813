import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from evenledger.session import session

    made = session("tests", master="local[8]", shuffle_partitions=8)
    made.sparkContext.setLogLevel("OFF")
    return made


@pytest.fixture(scope="session")
def tables(spark):
    """Loads a test table at sf0.001."""
    return lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
