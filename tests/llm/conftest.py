import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_cases import DOCS, edge_rows  # noqa: E402


@pytest.fixture(scope="session")
def edges(spark):
    """Edge rows with further columns whose names operators may use themselves."""
    rows = spark.createDataFrame(edge_rows(), DOCS).repartition(5)
    clashing = "fp component_id part doc body spans shard slot size epoch host u v kind value point __x".split()
    return rows.withColumns({c: F.lit(7) for c in clashing})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)
