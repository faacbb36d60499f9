from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from checks.compare import local_session  # noqa: E402
from martloom import schemas  # noqa: E402

TENANT = 1


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    """Build source tables from short rows; every table not given is empty. Dates and amounts may be texts."""

    def build(**rows_by_table):
        out = {}
        for name, columns in {**schemas.RAW, **schemas.EXTERNAL}.items():
            rows = rows_by_table.get(name.replace(".", "__"), [])
            defaults = {"_tenant_id": TENANT, "active": 1}
            values = [
                tuple(None if (v := {**defaults, **row}.get(c)) is None else str(v) for c in columns) for row in rows
            ]
            text = spark.createDataFrame(values, ", ".join(f"`{c}` string" for c in columns))
            out[name] = schemas.conform(text, columns)
        return out

    return build
