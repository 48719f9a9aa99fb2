import pathlib
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

SCALE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .config("spark.checkpoint.dir", str(folder / "shared"))
        .config("spark.sql.session.timeZone", "America/New_York")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def found(spark):
    from airtrack.lineage import pin
    from airtrack.sources import fixtures

    return pin(fixtures.detections(spark, SCALE))


@pytest.fixture(scope="session")
def messages(found):
    from airtrack.sources import fixtures

    return fixtures.jm_messages(found)


@pytest.fixture(scope="session")
def nodes(found):
    from airtrack.lineage import pin
    from airtrack.operators import kinematics

    return pin(kinematics.node_features(found))


@pytest.fixture(scope="session")
def clusters(nodes):
    from airtrack.lineage import pin
    from airtrack.operators import components

    return pin(components.clustered(nodes))
