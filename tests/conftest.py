import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from granary.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # A warehouse of its own: tables that a killed run left behind do not matter.
    session = local_session(8, 2, str(tmp_path_factory.mktemp("warehouse")))
    yield session
    session.stop()


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{tmp_path.name}".replace("[", "_").replace("]", "_").replace("-", "_").lower()
    spark.sql(f"CREATE DATABASE `{name}` LOCATION '{tmp_path}/db'")
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")
