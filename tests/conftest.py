import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gleanrank.session import tuned  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        tuned(SparkSession.builder.master("local[8]"))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def docs(spark):
    """A few documents: a tie (1 and 2), an empty text, repeated words."""
    return spark.createDataFrame(
        [
            (1, "red fox"),
            (2, "Red fox!"),
            (3, "blue whale, blue sea"),
            (4, ""),
            (5, "red red red whale"),
            (6, "state-of-the-art fox"),
        ],
        "id bigint, text string",
    )
