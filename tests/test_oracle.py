"""Every job that has SQL gives the rows of the SQL."""

import pytest

import __spark_entry__ as entry
from heronlake.registry import JOBS, ORACLE
from tests.oracle import differences


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_same_as_sql(key, spark, sf_dir, con):
    verdict, _, _ = differences(JOBS[key](spark, sf_dir), con, ORACLE[key])
    assert verdict == "ok"


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
