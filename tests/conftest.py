from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SF_DIR = "/root/testdata/sf0.001"


def make_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]").appName("moodtide-tests")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="moodtide-tests-")).getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    return make_session()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
