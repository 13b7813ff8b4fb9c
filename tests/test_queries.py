import os
import subprocess
import sys
from pathlib import Path

import pytest

from glyphlane.plans import load_queries

from .compare import differences, duck

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(load_queries()))
def test_query_equals_check_sql(spark, con, name):
    assert differences(spark, con, FOLDER, name) == []


def test_queries_load_without_a_session():
    code = "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).resolve().parents[1], timeout=120)
