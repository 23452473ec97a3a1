import os
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from tablewright.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    home = tempfile.mkdtemp(prefix="tablewright-tests-")
    session = build_session("tests", f"local[{os.cpu_count() or 4}]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "6g", "spark.sql.warehouse.dir": f"{home}/warehouse"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def folder(spark):
    from tablewright.session import work_folder

    return lambda label="test": work_folder(spark, label)


@pytest.fixture()
def database(spark):
    from tablewright.session import work_database

    return work_database(spark, "test")
