from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from geoledger.session import local_session  # noqa: E402

TABLES = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(cpus=8, partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return str(TABLES)
