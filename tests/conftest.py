import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from core_helpers import TESTDATA  # noqa: E402
from roadlens.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_spark("tests", "local[8]", {
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "4g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return TESTDATA


@pytest.fixture(scope="session")
def tables(spark, sf, tmp_path_factory):
    """The derived incident tables, written once."""
    from roadlens.plans import incident_tables as T
    root = tmp_path_factory.mktemp("incidents")
    for name in ("raw", "filtered", "unique"):
        getattr(T, name)(spark, sf).write.parquet(f"{root}/{name}")
    return {name: spark.read.parquet(f"{root}/{name}") for name in ("raw", "filtered", "unique")}
