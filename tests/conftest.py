import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from pulsemill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "pulsemill-tests",
        master="local[8]",
        shuffle_partitions=4,
        extra={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.host": "127.0.0.1",
            "spark.driver.bindAddress": "127.0.0.1",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def raw(spark):
    """Documents given as (json text, load time, file, place) to a RAW frame."""
    from pyspark.sql import functions as F

    def make(*documents):
        frame = spark.createDataFrame(list(documents), "text string, at string, source_file string, tie_breaker long")
        return frame.select(
            F.parse_json("text").alias("raw_data"),
            F.col("at").cast("timestamp").alias("loaded_at"),
            "source_file",
            "tie_breaker",
        )

    return make
