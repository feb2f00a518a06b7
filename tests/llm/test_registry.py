import pytest

from tributary.llm.registry import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(same, name):
    same(QUERIES[name], ORACLE[name])


@pytest.mark.parametrize("name", ["op1_sharding", "op4_pii", "op5_chat_formatting", "op9_quality_rules"])
def test_native_plans(spark, name):
    import re

    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)
