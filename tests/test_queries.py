import pytest

import __spark_entry__ as contract
import check
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def db():
    return check.connect(SMALL)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_equals_its_sql(spark, db, name):
    frame = contract.queries()[name](spark, SMALL)
    if name in contract.oracle_sql():
        assert check.compare(frame, db.sql(contract.oracle_sql()[name])) == ""
    else:
        assert frame.count() > 0
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["skill", "count", "pct"] and frame.count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_tagging_runs_once_per_query(spark):
    """The total is read from the same shuffle as the counts."""
    frame = contract.queries()["skill_frequency"](spark, SMALL)
    frame.collect()
    assert "ReusedExchange" in frame._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    plan = contract.queries()["scan_listings"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(n_chars,500)" in plan
    assert "ReadSchema: struct<doc_id:bigint,lang:string,source:string,n_chars:bigint>" in plan
    plan = contract.queries()["filter_multi"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "In(lang, [" in plan.split("PushedFilters")[1]


@pytest.mark.parametrize("name", ["skill_frequency", "itemsets_orders", "group_profiles", "ingest_summary", "top_skills_per_group"])
def test_results_do_not_depend_on_partitioning(spark, name):
    def rows():
        return sorted(map(str, contract.queries()[name](spark, SMALL).collect()))

    expected = rows()
    try:
        for partitions in ("1", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            assert rows() == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
