import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def people(spark):
    """200 rows in the shape of a marketing table: dotted names, nulls, text and numbers."""
    rows = []
    for i in range(200):
        age = None if i % 17 == 0 else 20 + (i * 7) % 50
        rate = round(-3 + (i % 11) * 0.5, 1)
        job = None if i % 13 == 0 else ["admin", "blue-collar", "student", "unknown"][i % 4]
        rows.append((i, age, rate, float(i % 9), job, ["mar", "may", "sep"][i % 3],
                     "yes" if (rate > -0.5) != (i % 10 == 0) else "no"))
    return spark.createDataFrame(
        rows, "id bigint, age int, `emp.var.rate` double, pdays double, job string, month string, y string")
