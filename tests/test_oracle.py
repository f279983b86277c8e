"""Every registered query against its SQL on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from casemill.registry import all_queries, all_sql  # noqa: E402
from tools.check_oracle import check, connect  # noqa: E402

SF = "/root/testdata/sf0.001"
ROWS_ONLY = set()


@pytest.fixture(scope="session")
def db():
    return connect(SF)


def test_all_but_the_iterative_ones_have_sql():
    assert set(all_queries()) - set(all_sql()) == ROWS_ONLY


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, db, name):
    assert check(spark, db, name, SF) is None
