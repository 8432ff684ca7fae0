from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

TEXT = "doc_id long, text string, lang string, _key string, n long, row string, kept string"


@pytest.fixture(scope="session")
def documents(spark: SparkSession):
    """Makes a documents table; further columns bear names that operators use inside."""

    def make(rows):
        return spark.createDataFrame([(*r, *["x"] * (3 - len(r)), "k", 7, "r", "z") for r in rows], TEXT)

    return make
