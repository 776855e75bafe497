"""One local session for all tests."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lexstrata.functions.runtime import ship_package
    from lexstrata.session import build_session

    session = build_session("local[4]", 4, **{"spark.driver.memory": "3g", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints"))})
    ship_package(session)
    return session


@pytest.fixture(scope="session")
def data():
    return "/root/testdata/sf0.001"
