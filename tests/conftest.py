import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from corpusloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", f"local[{os.environ.get('TEST_CPUS', '8')}]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.default.parallelism": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "6g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Evaluate a column function over a list of strings."""
    from pyspark.sql import functions as F

    def run(fn, values):
        df = spark.createDataFrame(list(enumerate(values)), "i int, t string").coalesce(2)
        return [r[1] for r in sorted(df.select("i", fn(F.col("t")).alias("o")).collect())]

    return run
