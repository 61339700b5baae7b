import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    os.environ.setdefault("PYARROW_IGNORE_TIMEZONE", "1")
    from pyspark.sql import SparkSession

    from callsift.session import apply_defaults

    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("stage")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield apply_defaults(session)
    session.stop()


@pytest.fixture
def make(spark):
    """Small tables from rows and a schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)
