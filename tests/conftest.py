import pathlib
import sys

import pytest
from pyspark.sql import SparkSession

HERE = pathlib.Path(__file__).parent
sys.path[:0] = [str(HERE), str(HERE.parent)]


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
        # Inputs are tiny, so compiling code for each plan costs more than it saves.
        .config("spark.sql.codegen.wholeStage", "false")
        .config("spark.sql.codegen.factoryMode", "NO_CODEGEN")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def zone(tmp_path):
    from stillwell.sinks.zone import Zone
    return Zone(str(tmp_path / "zone"))
