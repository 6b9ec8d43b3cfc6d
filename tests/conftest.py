import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("fleetlens-tests")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def readouts(spark):
    return spark.createDataFrame(
        [(1, 0.0, 10.0, 0.0, 100.0), (1, 1.0, 12.0, 1.0, 105.0), (2, 0.0, 20.0, 0.0, 200.0),
         (2, 1.0, 22.0, 2.0, 210.0), (3, 0.0, 5.0, 1.0, 50.0), (3, 1.0, 6.0, 1.5, 52.0)],
        "vehicle_id long, time_step double, `397_0` double, `397_1` double, `459_0` double",
    )


@pytest.fixture(scope="session")
def specs(spark):
    return spark.createDataFrame([(1, "A", "X"), (2, "B", "Y"), (3, "A", "X")], "vehicle_id long, Spec_0 string, Spec_1 string")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 100.0), (2, 0, 100.0), (3, 0, 100.0)],
        "vehicle_id long, in_study_repair int, length_of_study_time_step double",
    )


@pytest.fixture(scope="session")
def long_of(spark):
    """Long readouts of vehicle 1, sensor 397_0, from values and times."""

    def build(values, times=None, vehicle=1, sensor="397_0"):
        times = times or range(len(values))
        rows = [(vehicle, float(t), sensor, v) for t, v in zip(times, values)]
        return spark.createDataFrame(rows, "vehicle_id long, time_step double, sensor string, value double")

    return build
