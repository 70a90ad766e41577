import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    conf = {
        "spark.master": "local[8]", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "6g", "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC", "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}",
    }
    session = SparkSession.builder.config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
