"""Every clinical query against its SQL on the smallest tables."""

import pytest
from oracle_check import difference

from wardlake.plans import dashboards, intake, sourcing, upkeep, warehouse  # noqa: F401
from wardlake.plans.catalogue import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    assert difference(spark, "/root/testdata/sf0.001", QUERIES[name], ORACLE_SQL[name]) == ""


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 62
