"""Every registered query next to its SQL, on the smallest driver tables."""

import pytest

import __spark_entry__ as entry
import oracle
from helpers import TESTDATA
from tidelog.plans import registry

RUNS, SQLS = registry.load()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(TESTDATA)


@pytest.mark.parametrize("name", sorted(RUNS))
def test_query(spark, con, name):
    said = oracle.compare(spark, con, TESTDATA, name, RUNS[name], SQLS.get(name))
    assert said.startswith("ok") and "width" not in said, said


def test_every_query_has_sql():
    runs, sqls = registry.load()
    assert set(sqls) == set(runs)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
