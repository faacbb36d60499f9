"""Every registered query against its expected SQL result."""

from __future__ import annotations

from pathlib import Path

import pytest

from checks.compare import difference, duck
from checks.registry import CHECKS

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def connection():
    with duck(SF_DIR) as open_connection:
        yield open_connection


@pytest.mark.parametrize("name", list(CHECKS))
def test_query(spark, connection, name):
    assert difference(spark, connection, SF_DIR, name) == ""


def test_every_query_states_its_result():
    assert all(check.sql for check in CHECKS.values())
