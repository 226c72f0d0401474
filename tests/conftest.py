import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from playmart.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").appName("playmart-tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


def tuples(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


def at(seconds=0, day=1):
    return datetime(2024, 1, day, 12, 0, 0) + timedelta(seconds=seconds)


PLAY_DDL = ("track_id string, track_name string, artist string, played_at timestamp, "
            "duration_ms bigint")


def plays(spark, rows):
    return spark.createDataFrame(rows, PLAY_DDL)
