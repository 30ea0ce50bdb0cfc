"""One local session for all tests."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lodestone.session import local_session, share_package  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4)
    share_package(session)
    return session


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def duck(sf_dir):
    import duckdb

    connection = duckdb.connect()
    for name in os.listdir(sf_dir):
        connection.sql(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{sf_dir}/{name}'")
    return connection
