"""A shared local session and a helper for small invented tables."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from casemill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "tests")


@pytest.fixture(scope="session")
def rows(spark):
    """rows("a string, b bigint", (..), (..)) -> DataFrame."""

    def make(schema, *data):
        return spark.createDataFrame(list(data), schema)

    return make


@pytest.fixture(scope="session")
def values(rows):
    """values(column_function, [inputs]) -> outputs in order."""
    from pyspark.sql import functions as F

    def run(fn, inputs, kind="string"):
        df = rows(f"i int, c {kind}", *enumerate(inputs))
        return [r.out for r in df.select("i", fn(F.col("c")).alias("out")).orderBy("i").collect()]

    return run
