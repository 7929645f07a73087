"""Every registered query against its SQL counterpart; the others must run and give rows."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import __spark_entry__ as driver  # noqa: E402
import oracle  # noqa: E402

SQL = driver.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return oracle.connect(sf)


@pytest.mark.parametrize("name", list(driver.queries()))
def test_query(spark, sf, con, name):
    found = oracle.spark_side(driver.queries()[name](spark, sf))
    if name in SQL:
        assert oracle.difference(found, oracle.sql_side(con, SQL[name])) is None
    else:
        assert found[1] > 0


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(driver.queries())
