import pytest

from tidemark.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tidemark-tests",
        master="local[8]",
        settings={
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(base / "scratch"),
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(spark, tmp_path):
    from uuid import uuid4

    from tidemark.lake import Lake
    from tidemark.sinks import create_database

    made = Lake(str(tmp_path / "lake"), f"lake_{uuid4().hex[:10]}")
    create_database(spark, made.database)
    return made
