import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    shared = tmp_path_factory.mktemp("shared")
    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "3").config("spark.sql.codegen.wholeStage", "false").config("spark.sql.codegen.factoryMode", "NO_CODEGEN").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").config("spark.checkpoint.dir", f"file://{shared}").config("spark.sql.warehouse.dir", f"file://{shared}/warehouse").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
