from pathlib import Path

import pytest


@pytest.fixture(scope="session", autouse=True)
def workers_find_the_package(spark):
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
