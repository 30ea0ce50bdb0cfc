"""Every query over the given tables against its SQL."""

from __future__ import annotations

import pytest
from oracle import assert_same

from lodestone.plans import facts_lane, source_lane, table_lane

ALL = table_lane.QUERIES | facts_lane.QUERIES | source_lane.QUERIES
SQL = table_lane.ORACLES | facts_lane.ORACLES | source_lane.ORACLES


@pytest.mark.parametrize("name", sorted(ALL))
def test_query_agrees_with_its_sql(spark, sf_dir, duck, name):
    assert_same(ALL[name](spark, sf_dir), duck, SQL[name])


def test_entry_has_rows(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == len(table_lane.RELATIONS)
    assert set(ALL) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
