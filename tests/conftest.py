import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kerbside.schema import OBS_SCHEMA  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[8]").appName("kerbside-tests")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.driver.memory", "8g")
               .config("spark.driver.host", "127.0.0.1")
               .config("spark.driver.bindAddress", "127.0.0.1")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.codegen.hugeMethodLimit", "8000")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


DEFAULTS = dict(session_id="20240101_000000_Town01_ClearNoon", tick=1, vehicle_id=1, speed=30.0,
                acceleration=1.0, x=0.0, y=0.0, z=0.0, yaw=0.0, traffic_density=5, weather=0,
                weather_name="ClearNoon", town="Town01", hour=12, congestion_label="Medium")


@pytest.fixture
def make_obs(spark):
    """Observations from partial rows; each row gets its own vehicle unless it names one."""
    def make(*rows):
        full = [{**DEFAULTS, "vehicle_id": i, **row} for i, row in enumerate(rows)]
        return spark.createDataFrame([tuple(r[f] for f in OBS_SCHEMA.fieldNames()) for r in full],
                                     OBS_SCHEMA)
    return make


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
