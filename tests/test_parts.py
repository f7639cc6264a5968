"""Steps that hold rows in memory: as many parts as the input asks for."""

import datetime as dt

from tallyworks.operators import groups as G
from tallyworks.plans.costing import distribute as D

ENTRY = "row_id string, order_id string, reference string, parent_process string, op_text string, day date, hours double, qty_rejected double"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _entries(spark, n):
    return spark.createDataFrame([(f"r{i}", f"o{i % 5}", "R", "P", "T", dt.date(2024, 1, 1 + i % 9), 1.0, 0.0) for i in range(n)], ENTRY)


def test_parts_follow_the_rows(spark):
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert G.parts_for(spark.range(10), 100) == least
    assert G.parts_for(spark.range(1001), 100) == max(least, 11)


def test_calendar_is_dealt_by_its_rows(spark, monkeypatch):
    rows = D.weigh(_entries(spark, 60), D.BOTH_WEIGHTS)
    moved = rows.limit(0).select(*D.PLACE_KEYS, "day")
    usual = D.calendar(rows, moved, [], D.BOTH_WEIGHTS)
    monkeypatch.setattr(D, "parts_for", lambda df: G.parts_for(df, 5))
    finer = D.calendar(rows, moved, [], D.BOTH_WEIGHTS)
    assert "hashpartitioning(order_id" in _plan(finer) and ", 12), REPARTITION_BY_NUM" in _plan(finer)
    assert sorted(map(str, usual.collect())) == sorted(map(str, finer.collect()))


def test_sums_are_dealt_to_their_order_once(spark):
    sums = D.weigh(_entries(spark, 60), D.BOTH_WEIGHTS).groupBy(*D.PLACE_KEYS, "day", "_w").agg({"hours": "sum", "qty_rejected": "sum", "row_id": "count"})
    sums = sums.withColumnsRenamed({"sum(hours)": "hours", "sum(qty_rejected)": "qty_rejected", "count(row_id)": "_rows"}).localCheckpoint()
    moved = sums.limit(0).select(*D.PLACE_KEYS, "day").localCheckpoint()
    out = D.calendar(sums, moved, [], D.BOTH_WEIGHTS)
    assert _plan(out).count("Exchange hashpartitioning") == 1
    assert sum(r["_rows_1"] for r in out.collect()) == 60
