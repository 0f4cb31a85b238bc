import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from kinweave.session import build_session  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def case(spark):
    from checks.catalog import Case

    return Case(spark, SF)


@pytest.fixture(scope="session")
def duck():
    from checks.compare import duckdb_connection

    return duckdb_connection(SF)


@pytest.fixture
def rows():
    def sorted_rows(df, *columns):
        table = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in table.collect()), key=repr)

    return sorted_rows
