import pytest
from pyspark.sql import SparkSession

from tidemark.session import prepare


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )
    yield prepare(session)


@pytest.fixture
def home(tmp_path):
    return str(tmp_path)
