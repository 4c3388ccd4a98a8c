"""Every registered query against its SQL on the small tables."""

import pytest

from tests.compare import difference
from tests.conftest import SMALL
from winback import session
from winback.plans import all_queries, all_sql

QUERIES, SQL = all_queries(), all_sql()


# Nodes that would leave the JVM, or pair every row with every other.
UNWANTED = (
    "CartesianProduct", "NestedLoop", "ArrowEvalPython", "BatchEvalPython", "MapInPandas",
    "FlatMapGroups",
)


# Trees are explained by an Arrow function, batch by batch.
ALLOWED = {
    "explain_tree_contributions": {"ArrowEvalPython"},
    "rounds_stored_tables": {"ArrowEvalPython"},
}


def plan_of(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql_by_a_clean_plan(spark, con, name):
    """The plan that is returned and every plan that ran before it, as one is as good as another."""
    plans = []
    watch = lambda df: plans.append(plan_of(df))
    session.watchers.append(watch)
    try:
        found = QUERIES[name](spark, SMALL)
    finally:
        session.watchers.remove(watch)
    unwanted = set(UNWANTED) - ALLOWED.get(name, set())
    assert not [node for node in unwanted for plan in [*plans, plan_of(found)] if node in plan]
    assert difference(con, found, SQL[name]) in (None, "no rows")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    found = entry.entry(spark)
    assert found.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
