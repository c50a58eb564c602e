import pytest
from conftest import DATA, same

from driftwell import plans


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    same(plans.queries()[name](spark, DATA), duck, plans.oracle_sql()[name])


def test_every_query_has_sql():
    assert set(plans.queries()) == set(plans.oracle_sql())


def test_grouped_plan_has_few_exchanges_and_no_python(spark):
    plan = plans.queries()["features_grouped"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan
    assert plan.count("Exchange hashpartitioning") <= 4
