import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from playtrail.plans.session import local_session

    session = local_session(cores="*", shuffle_partitions=8, app="playtrail-tests")
    yield session
    session.stop()
