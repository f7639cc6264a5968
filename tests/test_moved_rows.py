"""What the larger jobs move: rows go only where their own rules ask for it."""

from __future__ import annotations

import contextlib
import datetime
import io
import re

from pyspark.sql import functions as F

from tallyworks.plans.costing import standard_hours as S

SCHEMA = ("row_id string, order_id long, period string, op_text string, group_id string, mount_order string, day date, parent_process string,"
          " process string, specific_process string, prefix12 string, hours double, base_hours double, abs_base_hours double, base_qty double,"
          " qty_done double, qty_rejected double, qty_scrap double")
DAY = datetime.date(2024, 1, 2)


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def entry(row_id, op, group, specific, prefix, hours, order=1):
    return (row_id, order, "202401", op, group, "M0", DAY, "TERMOFORMADO", "TERMOFORMADO", specific, prefix, hours, 2.0, 2.0, 10.0, 40.0, 1.0, 0.0)


def entries(spark):
    mount, tune, short, inter = S.MOUNTING_PREFIX, S.TUNING_PREFIX, S.SHORT_SET_UP, S.INTER_OPERATION
    return spark.createDataFrame([
        entry("a", "corte", "G1", None, "OTRA", 3.0), entry("a", "corte", "G1", None, "OTRA", 3.0), entry("b", "corte", None, None, mount, 1.0),
        entry("c", "monta", "G1", "ALISTAMIENTO", mount, 2.0), entry("d", "monta", "G1", "ALISTAMIENTO", tune, 4.0),
        entry("e", "corto", "G1", short, "OTRA", 5.0), entry(None, "entre", "G1", inter, "OTRA", 6.0), entry(None, "entre", "G1", inter, mount, 7.0),
        entry("f", None, "G1", None, mount, 8.0), entry("g", "corto", "G2", short, "OTRA", 0.5), entry("h", "corte", "G1", None, "OTRA", 1.0, None),
        entry("i", "nada", "G1", "ALISTAMIENTO", "OTRA", 1.0)], SCHEMA)


def test_hours_meet_their_entries_by_one_shuffle_of_row_ids(spark):
    rows = entries(spark)
    got = S.entries_with_standard_hours(rows, ["order_id"])
    wanted = S.with_standard_hours(rows.select("row_id", "order_id"), S.standard_hours(rows))

    def values(df):
        return sorted(map(repr, df.withColumn("std_hours", F.round("std_hours", 9)).select("row_id", "order_id", "std_hours").collect()))

    assert values(got) == values(wanted)
    assert [r["n"] for r in got.groupBy("row_id").agg(F.count("*").alias("n")).orderBy(F.col("row_id").asc_nulls_first()).collect()][:2] == [6, 4]
    assert plan_of(got).count("hashpartitioning(row_id") == 1


def test_segment_sums_stay_small_enough_to_be_compiled(spark):
    from suite import bindings as B
    from tallyworks.plans.costing import movements as M

    sums = M.segment_sums(B.movements(spark, "/root/testdata/sf0.001"))
    out = io.StringIO()
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # an adaptive plan shows its code only after it ran
    try:
        with contextlib.redirect_stdout(out):
            sums.explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize: ?(\d+)", out.getvalue())]
    assert sizes and max(sizes) < 8000  # bytes; larger methods are not compiled by the Java machine


def test_lines_are_not_shuffled_to_learn_how_their_split_begins(spark, tmp_path):
    from tallyworks.sources import split_records as R

    (tmp_path / "a.csv").write_text('1,"x\ny",2\n3,z,4\n')
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        records = R.split_records(spark, str(tmp_path), ",")
        assert "SortMergeJoin" not in plan_of(records)
        assert sorted(r["text"] for r in records.collect()) == ['1,"x\ny",2', "3,z,4"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
