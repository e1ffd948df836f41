import os
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    shared = tempfile.mkdtemp(prefix="spark-tests-")
    session = (
        SparkSession.builder.master(f"local[{os.environ.get('TEST_CPUS', '4')}]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false").config("spark.checkpoint.dir", f"file://{shared}").config("spark.sql.warehouse.dir", f"{shared}/warehouse").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
