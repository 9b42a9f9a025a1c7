import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from keyscout.llm.common import ship_package  # noqa: E402


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    return ship_package(spark)


@pytest.fixture(scope="session")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")
