"""Costing operators on small fixtures with expected values worked out by hand, and properties."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyworks.operators import groups as G
from tallyworks.operators import joins as J
from tallyworks.operators import ranking as R
from tallyworks.operators.nearest import asof_totals
from tallyworks.plans.costing import classify, distribute, downtime, masters, quantities, rates, standard_hours

ENTRY = ("row_id string, order_id bigint, op_text string, centre string, centre_code string, method string, reference string, "
         "day date, period string, hours double, base_hours double, abs_base_hours double, qty_done double, qty_rejected double, "
         "base_qty double, qty_scrap double, process string, parent_process string, prefix12 string, specific_process string, "
         "group_id string, mount_order string, std_hours double")
NAMES = [c.split()[0] for c in ENTRY.split(", ")]


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def entry(**kw):
    base = dict(order_id=1, op_text="OP", reference="R", day=day(0), period="202401", hours=1.0, qty_done=1.0, qty_rejected=0.0,
                qty_scrap=0.0, base_qty=1.0, process="P", parent_process="P", centre="C", method="Estandar")
    base.update(kw)
    return tuple(base.get(n) for n in NAMES)


def entries(spark, rows):
    return spark.createDataFrame([entry(row_id=str(i), **r) if "row_id" not in r else entry(**r) for i, r in enumerate(rows)], ENTRY)


def rows_of(df, *names):
    return sorted(tuple(r) for r in df.select(*names).collect())


@pytest.mark.parametrize("hot_rows", [1, 3, 10**6])
def test_attach_is_the_same_for_hot_and_cold_groups(spark, hot_rows):
    rng = random.Random(3)
    data = [(i, rng.choice([1, 1, 1, 2, 3, None]), float(rng.randint(0, 9))) for i in range(60)]
    df = spark.createDataFrame(data, "i int, k int, v double")
    got = {r.i: r.t for r in G.attach_group_values(df, ["k"], [F.sum("v").alias("t")], hot_rows).collect()}
    sums = {}
    for _, k, v in data:
        sums[k] = sums.get(k, 0) + v
    assert got == {i: (None if k is None else sums[k]) for i, k, _ in data}
    sizes = G.sized_groups(df, ["k"], [], keep_missing=True)
    names = spark.createDataFrame([(1, "a"), (None, "n")], "k int, name string")
    slotted = G.attach(df, names, ["k"], "inner", null_safe=True, hot_rows=hot_rows, sizes=sizes)
    assert {r.i: r.name for r in slotted.collect()} == {i: {1: "a", None: "n"}[k] for i, k, _ in data if k in (1, None)}


def test_prorated_parts_add_up(spark):
    df = spark.createDataFrame([("a", 1.0, 9.0), ("a", 3.0, 9.0), ("b", 0.0, 5.0), (None, 2.0, 5.0)], "k string, h double, m double")
    assert sorted(G.prorate(df, ["k"], "h", "m", "part").select("k", "part").collect(), key=str) == sorted(
        [("a", 2.25), ("a", 6.75), ("b", None), (None, None)], key=str)


def test_override_and_last_wins(spark):
    df = spark.createDataFrame([("1", "x", None), ("2", None, "u"), (None, "z", "w")], "k string, a string, b string")
    fix = spark.createDataFrame([("1", None, "B"), (None, "A", None)], "key string, na string, nb string")
    assert sorted(map(str, J.override(df, fix, [("k", "key")], {"a": "na", "b": "nb"}).collect())) == sorted(map(str, [
        ("1", "x", "B"), ("2", None, "u"), (None, "A", "w")])) or rows_of(
        J.override(df, fix, [("k", "key")], {"a": "na", "b": "nb"}).na.fill("-"), "k", "a", "b") == [
        ("-", "A", "w"), ("1", "x", "B"), ("2", "-", "u")]
    dim = spark.createDataFrame([("k", "old", 1), ("k", "new", 2)], "c string, v string, i int")
    assert J.last_per_key(dim, ["c"], ["v"], F.col("i")).first().v == "new"


def test_records_are_numbered_across_blocks(spark):
    df = spark.createDataFrame([(i * 7,) for i in range(50)], "id bigint").repartition(5)
    got = {r.id: r.record_number for r in R.number_records(df, "id", block=20).collect()}
    assert got == {i * 7: i + 1 for i in range(50)}


def test_top_and_bottom(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", 9.0), ("c", 1.0), ("d", 5.0)], "p string, s double")
    assert rows_of(R.top_and_bottom(df, "s", "p", 2), "list", "place", "p") == [
        ("bottom", 1, "c"), ("bottom", 2, "d"), ("top", 1, "b"), ("top", 2, "a")]


def test_main_process_takes_the_lowest_number_not_the_first_text(spark):
    df = entries(spark, [dict(op_text="MOLIDO X"), dict(op_text="EXTRUSION Y"), dict(op_text="OTRA", order_id=2)]).drop(
        "process", "parent_process")
    dim = spark.createDataFrame([("MOLID", "MOLIDO", "10"), ("EXTRU", "EXTRUSION LAMINA", "9")], "prefix5 string, process string, rank string")
    got = rows_of(classify.main_process(df, dim).na.fill("-"), "order_id", "op_text", "parent_process", "main_operation")
    assert got == [(1, "EXTRUSION Y", "EXTRUSION LAMINA", "EXTRUSION Y"), (1, "MOLIDO X", "EXTRUSION LAMINA", "EXTRUSION Y"),
                   (2, "OTRA", "-", "-")]


def test_second_level_prefers_supplementary_then_method_then_centre(spark):
    df = entries(spark, [dict(centre="C1"), dict(method="Alterno"), dict(centre=None, order_id=2), dict(centre="C2", order_id=2),
                         dict(centre="ACTIVIDADES SUPLEMENTARIAS", order_id=3), dict(method="Alterno", order_id=3),
                         dict(process="Q", order_id=4), dict(method=None, order_id=5)])
    got = dict(classify.second_level(df).select("order_id", "second_level").distinct().collect())
    assert got == {1: "Alterno", 2: "C2", 3: "ACTIVIDADES SUPLEMENTARIAS", 4: None, 5: None}


def _near(spark, known, wanted, by_rejects=True):
    df = entries(spark, [dict(row_id=i, day=day(d), qty_rejected=q) for i, d, q in known])
    moved = spark.createDataFrame([(1, "R", day(d), "P", "OP") for d in wanted],
                                  "order_id bigint, reference string, day date, parent_process string, op_text string")
    return rows_of(distribute.nearest_entries(moved, df, "1", by_rejects), "row_id")


def test_nearest_day_prefers_earlier_and_keeps_ties(spark):
    assert _near(spark, [("a", 0, 0.0), ("b", 9, 0.0)], [5]) == [("a_1_20240106",)]
    assert _near(spark, [("a", 0, 0.0), ("b", 101, 0.0), ("c", 101, 0.0)], [100]) == [
        ("a_1_20240410",), ("b_1_20240410",), ("c_1_20240410",)]
    assert _near(spark, [("a", 4, None), ("b", 0, 1.0)], [5]) == [("b_1_20240106",)]
    assert _near(spark, [("a", 4, None), ("b", 0, 1.0)], [5], by_rejects=False) == [("a_1_20240106",)]
    assert _near(spark, [("a", 5, 0.0)], [5]) == []


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_nearest_day_against_all_pairs(spark, hot_rows):
    rng = random.Random(11)
    known = [(f"e{i}", rng.randint(0, 40), rng.choice([0.0, 1.0, None, -1.0])) for i in range(40)]
    wanted = rng.sample(range(0, 45), 15)
    df = entries(spark, [dict(row_id=i, day=day(d), qty_rejected=q) for i, d, q in known])
    moved = spark.createDataFrame([(1, "R", day(d), "P", "OP") for d in wanted],
                                  "order_id bigint, reference string, day date, parent_process string, op_text string")
    got = rows_of(distribute.nearest_entries(moved, df, "1", True, hot_rows), "row_id")
    want = []
    for w in wanted:
        if any(d == w for _, d, _ in known):
            continue
        cost = {i: (d - w) * (1 if q is not None and q >= 0 else 1000) for i, d, q in known}
        cost = {i: -c if c < 0 else c * 100 for i, c in cost.items()}
        want += [(f"{i}_1_{day(w):%Y%m%d}",) for i, c in cost.items() if c == min(cost.values())]
    assert got == sorted(want)


def test_segments_are_conserved(spark):
    df = entries(spark, [dict(hours=1.0), dict(hours=3.0), dict(day=day(2), hours=2.0)])
    moved = spark.createDataFrame(
        [(1, "R", day(0), "P", "OP", 8.0), (1, "R", day(5), "P", "OP", 6.0), (9, "R", day(0), "P", "OP", 4.0)],
        "order_id bigint, reference string, day date, parent_process string, op_text string, scrap_shaped double")
    for s in distribute.SEGMENTS[1:]:
        moved = moved.withColumn(s, F.lit(None).cast("double"))
    out = distribute.distribute_segments(moved, df)
    assert rows_of(out, "row_id", "part_scrap_shaped") == [("0", 2.0), ("1", 6.0), ("2_0_20240106", 6.0)]


def test_asof_totals(spark):
    rows = [dict(day=day(0), qty_rejected=1.0, process="Q"), dict(day=day(2), qty_rejected=2.0), dict(day=day(2), qty_rejected=None),
            dict(day=day(3), qty_rejected=4.0, process="Q"), dict(day=day(5), qty_rejected=8.0),
            dict(order_id=2, qty_rejected=3.0, process="Q"), dict(order_id=3, qty_rejected=3.0, qty_done=0.0)]
    for hot in (1, 10**6):
        got = rows_of(quantities.rejects_by_productive_day(entries(spark, rows), hot), "row_id", "day_rejected")
        assert got == [("0", 0.0), ("1", 7.0), ("2", 7.0), ("3", 0.0), ("4", 8.0), ("5", 0.0), ("6", 0.0)]


def test_asof_totals_conserve_the_rejects_of_orders_with_a_productive_day(spark):
    rng = random.Random(5)
    rows = [dict(order_id=rng.randint(1, 6), day=day(rng.randint(0, 9)), qty_rejected=float(rng.randint(0, 5)),
                 process=rng.choice(["P", "Q", None])) for _ in range(80)]
    df = entries(spark, rows)
    out = asof_totals(df, "order_id", "day", F.col("process") == "P", {"moved": "qty_rejected"})
    given = out.filter("process = 'P'").groupBy("order_id", "day").agg(F.max("moved").alias("m")).groupBy("order_id").agg(F.sum("m"))
    whole = df.join(df.filter("process = 'P'").select("order_id").distinct(), "order_id").groupBy("order_id").agg(F.sum("qty_rejected"))
    assert sorted(given.collect()) == sorted(whole.collect())


def test_costs_are_kept_spread_or_lost(spark):
    ledger = spark.createDataFrame([
        ("p", "MOD ESTANDAR", None, "1", "c1", -30.0), ("p", "MOD ESTANDAR", None, "2", "c2", -10.0),
        ("p", "MOD ESTANDAR", None, "301021", "cx", -7.0), ("p", "MOD REAL", None, "1", "c1", 50.0),
        ("p", "MOD REAL", "COSTO MOD HORAS EXTRA", "2", "c2", 5.0), ("p", "MOD REAL", None, "8", "c8", 40.0),
        ("p", "MOD REAL", None, "9", "c9", 20.0), ("p", "MOD REAL", None, "7", "c7", 12.0),
        ("p", "MOD REAL", None, "301021", "cx", 4.0), ("q", "MOD REAL", None, "8", "c8", 99.0)],
        "period string, type_nature string, labour_type string, centre string, description string, balance double")
    ledger = ledger.withColumn("ledger_id", F.monotonically_increasing_id())
    rules = spark.createDataFrame([("9", "2", "INCLUIDA"), ("9", "1", "EXCLUIDA"), ("7", "2", "EXCLUIDA")],
                                  "original_centre string, target_centre string, rule string")
    out = rates.allocate_costs(ledger, rules)
    got = rows_of(out.na.fill("-", ["original_centre"]), "original_centre", "centre", "balance", "cost_label")
    assert got == [("-", "1", 30.0, "MOD ESTANDAR"), ("-", "1", 50.0, "MOD REAL"), ("-", "2", 5.0, "COSTO MOD HORAS EXTRA REAL"),
                   ("-", "2", 10.0, "MOD ESTANDAR"), ("-", "301021", 7.0, "MOD ESTANDAR"), ("301021", "1", 3.0, "MOD REAL"),
                   ("301021", "2", 1.0, "MOD REAL"), ("7", "1", 12.0, "MOD REAL"), ("8", "1", 30.0, "MOD REAL"),
                   ("8", "2", 10.0, "MOD REAL"), ("9", "2", 20.0, "MOD REAL")]


def test_each_real_row_is_spread_on_its_own(spark):
    ledger = spark.createDataFrame([
        (1, "p", "MOD ESTANDAR", None, "1", "c1", -30.0), (2, "p", "MOD ESTANDAR", None, "2", None, -10.0),
        (3, "p", "MOD REAL", None, "8", None, 1000.0), (4, "p", "MOD REAL", None, "8", "c8", 4.0), (5, "p", "MOD REAL", None, None, "x", 40.0)],
        "ledger_id int, period string, type_nature string, labour_type string, centre string, description string, balance double")
    none = spark.createDataFrame([], "original_centre string, target_centre string, rule string")
    out = rates.allocate_costs(ledger, none).filter("share is not null")
    assert rows_of(out, "ledger_id", "centre", "balance", "original_balance", "base_total") == [
        (3, "1", 750.0, 1000.0, 40.0), (3, "2", 250.0, 1000.0, 40.0), (4, "1", 3.0, 4.0, 40.0), (4, "2", 1.0, 4.0, 40.0),
        (5, "1", 30.0, 40.0, 40.0), (5, "2", 10.0, 40.0, 40.0)]
    hours = spark.createDataFrame([("p", "1", 10.0)], "period string, cost_centre string, hours double")
    assert rates.split_labels(rates.hourly_rates(rates.allocate_costs(ledger, none), hours)) == (["MOD REAL"], ["MOD ESTANDAR"])


def test_a_mounting_without_a_day_earns_nothing_and_hides_nothing(spark):
    base = dict(prefix12="MONTAJE Y DE", group_id="g", mount_order="m", abs_base_hours=10.0)
    df = entries(spark, [dict(base, order_id=1, day=None, hours=1.0), dict(base, order_id=2, hours=1.0)])
    assert rows_of(standard_hours.mounting_awards(df), "group_id", "earned_hours", "mountings") == [("g", 10.0, 1)]
    assert rows_of(standard_hours.mounting_hours(df), "row_id", "std_hours") == [("0", 5.0), ("1", 5.0)]


def test_mounting_awards_first_order_and_late_real_work(spark):
    base = dict(prefix12="MONTAJE Y DE", group_id="g", mount_order="m", abs_base_hours=10.0)
    df = entries(spark, [dict(base, order_id=2, hours=1.0), dict(base, order_id=1, hours=3.0), dict(base, order_id=5, day=day(2), hours=20.0),
                         dict(base, order_id=6, day=day(3), hours=9.5), dict(base, order_id=7, day=day(4), hours=9.0)])
    assert rows_of(standard_hours.mounting_awards(df), "group_id", "earned_hours", "mountings") == [("g", 20.0, 2)]
    total = standard_hours.mounting_hours(df).agg(F.sum("std_hours")).first()[0]
    assert abs(total - 20.0) < 1e-9


def test_short_set_up_needs_half_of_the_base(spark):
    base = dict(specific_process="ALISTAMIENTO CORTA DURACION", group_id="g", abs_base_hours=10.0)
    df = entries(spark, [dict(base, hours=2.0), dict(base, hours=3.0), dict(base, op_text="OTRA", hours=4.9)])
    assert rows_of(standard_hours.short_set_up_hours(df), "row_id", "std_hours") == [("0", 4.0), ("1", 6.0)]


RULES = ("code string, downtime string, downtime_group string, rule string, column_1 string, data_1 string, column_2 string, "
         "data_2 string, column_3 string, data_3 string")


def _downtime(spark, rows):
    classes = spark.createDataFrame([
        ("7", "x", "G7", "TODOS", "parent_process", "P", None, None, None, None),
        ("8", "x", "G8", "INCLUIDOS", "parent_process", "P", "centre_code", "01-02", None, None),
        ("9", "x", "G9", "EXCLUIDOS", "parent_process", "P", "centre_code", "01", None, None)], RULES)
    stops = spark.createDataFrame(rows, "downtime_id bigint, order_id bigint, downtime string, downtime_hours string")
    return masters.downtime_records(stops, masters.downtime_rules(classes))


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_downtime_is_shared_by_hours_of_the_entries_its_rule_takes(spark, hot_rows):
    df = entries(spark, [dict(centre_code="01", hours=1.0), dict(centre_code="02", hours=3.0), dict(order_id=2, hours=4.0)])
    stops = _downtime(spark, [(1, 1, "8-A", "8"), (2, 1, "9-B", "6"), (3, 1, "4-Z", "5")])
    out = downtime.allocate_downtime(df, stops, ["parent_process", "centre_code"], hot_rows)
    assert rows_of(out.na.fill("-", ["code"]).na.fill(0.0, ["allocated_hours"]), "row_id", "code", "allocated_hours") == [
        ("0", "008", 2.0), ("1", "008", 6.0), ("1", "009", 6.0), ("2", "-", 0.0)]


def test_repeated_downtime_of_one_code_shares_the_same_total(spark):
    df = entries(spark, [dict(hours=4.0)])
    out = downtime.allocate_downtime(df, _downtime(spark, [(1, 1, "7-A", "2"), (2, 1, "7-B", "6")]), ["parent_process", "centre_code"])
    assert rows_of(out, "downtime", "allocated_hours") == [("7-A", 1.0), ("7-B", 3.0)]


def test_concepts_add_up_to_the_hours(spark):
    df = entries(spark, [dict(order_id=i, hours=h, std_hours=s) for i, (h, s) in enumerate([(5.0, 8.0), (8.0, 5.0), (8.0, 2.0), (6.0, 6.0)], 1)])
    stops = _downtime(spark, [(1, 1, "7-A", "1"), (2, 2, "7-A", "4"), (3, 3, "7-A", "4"), (4, 3, "7-B", "2")])
    allocated = downtime.allocate_downtime(df, stops, ["parent_process", "centre_code"])
    out = downtime.decompose_concepts(allocated)
    sums = dict(out.groupBy("row_id").agg(F.sum("concept_hours")).collect())
    assert sums == {"0": 5.0, "1": 8.0, "2": 8.0, "3": 6.0}
    third = {(r.concept[:3], r.concept_hours) for r in out.filter("row_id = '2'").collect()}
    assert third == {("000", 2.0), ("999", 3.0), ("7-A", 2.0), ("7-B", 1.0)}
    assert {r.downtime_group for r in out.filter("concept like '7-%'").collect()} == {"G7"}
