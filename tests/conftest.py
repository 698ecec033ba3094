import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g").config("spark.ledgertone.inputPartitions", "8")
        .config("spark.checkpoint.dir", str(base / "checkpoints"))
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
