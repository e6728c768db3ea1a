import datetime as dt

import pytest

from tidemark.session import build_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session(
        "tidemark-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "2",
            # Compiling and re-planning a stage costs more than running it on a few rows; the query
            # tests, the checker and the bench run with both on.
            "spark.sql.codegen.wholeStage": "false",
            "spark.sql.adaptive.enabled": "false",
            "spark.sql.sources.parallelPartitionDiscovery.parallelism": "2",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(shared),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def run_at():
    return dt.datetime(2026, 7, 28, 6, 30)
