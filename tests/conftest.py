import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from matchlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = build_session(
        "matchlake-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.sql.maxMetadataStringLength": "10000",
            "spark.checkpoint.dir": str(home / "shared"),
            "spark.sql.warehouse.dir": str(home / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    before = {}

    def change(**settings):
        for key, value in settings.items():
            key = key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
