import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from triagelake import configure

    folder = tmp_path_factory.mktemp("shared")
    session = (
        SparkSession.builder.master("local[8]").appName("triagelake-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .config("spark.checkpoint.dir", str(folder))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def texts(spark):
    """Rows of (id, text) for a list of strings."""
    def build(values):
        return spark.createDataFrame(list(enumerate(values)), "id int, text string").repartition(4)

    return build
