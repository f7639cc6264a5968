"""Code tables are sent to the tasks; details are dealt to as many tasks as their rows ask for."""

import re

from suite import bindings as B
from tallyworks.plans.costing import classify


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_processes_are_not_a_reason_to_shuffle_entries(spark):
    rows = spark.createDataFrame([(f"r{i}", f"o{i % 5}", "EXTRUSION DE LAMINA") for i in range(20)], "row_id string, order_id string, op_text string")
    plan = _plan(classify.main_process(rows, B.processes(spark)))
    assert re.search(r"hashpartitioning\(order_id#\d+, _slot#\d+, \d+\), REPARTITION_BY_NUM", plan)
    dealt = re.findall(r"hashpartitioning\((.*?), \d+\), ENSURE_REQUIREMENTS", plan)
    assert any("_group_slot" in d for d in dealt) and not any("_slot#" in d and "_group_slot" not in d for d in dealt)
    assert "hashpartitioning(prefix5" not in plan and "hashpartitioning(coalesce(prefix5" not in plan
    assert B.processes(spark).collect()[1].asDict() == {"prefix5": "TERMO", "process": "TERMOFORMADO", "rank": "9"}
