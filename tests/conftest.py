import pytest

from wattline.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "wattline-tests",
        master="local[4]",
        shuffle_partitions=4,
        settings={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.sql.debug.maxToStringFields": "1000",
            "spark.sql.maxMetadataStringLength": "5000",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def out(tmp_path):
    return str(tmp_path / "out")
