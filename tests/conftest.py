import sys
import tempfile
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parents[1])]


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    conf = {"spark.sql.shuffle.partitions": "4", "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
            "spark.checkpoint.dir": "file://" + tempfile.mkdtemp(prefix="spark-")}
    s = SparkSession.builder.master("local[8]").config(map=conf).getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
