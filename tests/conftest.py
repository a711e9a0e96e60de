import pytest

from wardlog.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", master="local[8]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "3", "spark.driver.memory": "6g",
        "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Build a frame from tuples and a DDL schema."""
    return lambda data, schema: spark.createDataFrame(data, schema)
