import os
import sys
from pathlib import Path

import pytest

REPO = str(Path(__file__).resolve().parents[1])
os.environ["PYTHONPATH"] = os.pathsep.join(x for x in (REPO, os.environ.get("PYTHONPATH", "")) if x)
sys.path.insert(0, REPO)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    conf = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))}
    s = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
