from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="spark-")
    conf = {"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g", "spark.local.dir": scratch, "spark.sql.warehouse.dir": f"{scratch}/warehouse", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.session.timeZone": "UTC"}
    session = SparkSession.builder.master("local[8]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
