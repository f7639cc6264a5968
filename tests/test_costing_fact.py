"""The bucketed fact: its entries are not shuffled again, and days dealt to slots give the same rows."""

import re

from suite import bindings as B
from suite import costing, load_all
from tallyworks.plans.costing import fact

FOLDER = "/root/testdata/sf0.001"
load_all()


def made(spark, **more):
    return fact.costing_fact(B.job_entries(spark, FOLDER), B.job_movements(spark, FOLDER), costing._fact_masters(spark, FOLDER), **more)


def above(plan, mark):
    """Operators between the scan of a table and the first join above it, from a plan's text."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if mark in line)
    depth = len(re.match(r"[\s:|+\-]*", lines[at]).group())
    out = []
    for line in reversed(lines[:at]):
        d = len(re.match(r"[\s:|+\-]*", line).group())
        if d < depth:
            depth = d
            out.append(line.strip(" :+-|*"))
            if "Join" in line:
                break
    return out


def test_entries_meet_their_combinations_bucket_by_bucket(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        usual = made(spark)
        plan = usual._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    path = above(plan, "costing_fact_")
    assert "SortMergeJoin" in path[-1] and not [x for x in path if "Exchange" in x]
    columns = ["row_id", "order_id", "parent_process", "day", "period", "mark", "hours", "std_hours", "nc_kg", "kg_scrap", "kg_used", "kg_cake"]

    def rows(df):
        return sorted((tuple(round(x, 6) if isinstance(x, float) else str(x) for x in r) for r in df.select(*columns).collect()), key=str)

    assert rows(made(spark, hot_rows=2)) == rows(usual)
