import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from furrow.session import build_session

    SparkSession.builder.config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g").config(
        "spark.ui.enabled", "false"
    ).config("spark.sql.shuffle.partitions", "4").master("local[4]").getOrCreate()
    session = build_session("furrow-tests", "local[4]", 4)
    session.sparkContext.setLogLevel("OFF")
    yield session


@pytest.fixture
def curated_toy(spark):
    rows = [
        ("Kenya", "Maize", 2000, 10000, 500.0, 20.0, 5.0),
        ("Kenya", "Maize", 2001, 12000, None, 21.0, 6.0),
        ("Kenya", "Maize", 2002, 11000, 600.0, None, 7.0),
        ("Uganda", "Maize", 2002, 9000, 550.0, 19.0, None),
    ]
    shape = "area string, crop string, year int, yield_hg_ha long, rainfall_mm double, avg_temp_c double, pesticides_tonnes double"
    return spark.createDataFrame(rows, shape)
