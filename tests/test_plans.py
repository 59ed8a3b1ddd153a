"""What the physical plans must and must not contain."""

import re

import pytest

from tidemark.plans.queries import BATCH

FOLDER = "/root/testdata/sf0.001"


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(BATCH))
def test_no_pair_joins_and_no_python(spark, name):
    plan = plan_of(BATCH[name](spark, FOLDER))
    assert not re.search("CartesianProduct|NestedLoop|EvalPython|InPandas|InArrow|CollectLimit|SinglePartition", plan)


@pytest.mark.parametrize("name", ["seq_in_order", "seq_emissions"])
def test_distinct_messages_are_shuffled_once(spark, name):
    frame = BATCH[name](spark, FOLDER)
    frame.collect()
    final = plan_of(frame).split("Initial Plan")[0]
    dealt = [line for line in final.splitlines() if re.search(r"Exchange hashpartitioning\(channel#\d+L?, _range#", line)]
    assert len(dealt) == 2 and sum("ReusedExchange" in line for line in dealt) == 1
    assert "BroadcastHashJoin" in final and "SortMergeJoin" not in final


def test_scans_read_only_what_is_needed(spark):
    plan = plan_of(BATCH["scan_project"](spark, FOLDER))
    assert re.search("ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double,o_orderpriority:string>", plan)
    plan = plan_of(BATCH["seq_book"](spark, FOLDER))
    assert "l_extendedprice" not in plan
