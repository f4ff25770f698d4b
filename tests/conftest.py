import os
import sys
import tempfile
import uuid
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lakemart.session import build_spark  # noqa: E402

DATA = Path(os.environ.get("TESTDATA", "/root/testdata"))


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="lakemart-tests-")
    session = build_spark(
        master="local[4]",
        shuffle_partitions=4,
        conf={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": f"{scratch}/warehouse",
            "spark.checkpoint.dir": f"{scratch}/shared",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tiny() -> str:
    return str(DATA / "sf0.001")


@pytest.fixture(scope="session")
def small() -> str:
    return str(DATA / "sf0.01")


@pytest.fixture
def new_name():
    """Makes names for namespaces that no other test uses."""
    return lambda prefix="ns": f"{prefix}_{uuid.uuid4().hex}"
