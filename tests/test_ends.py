"""Lists of the best and worst: scores are worked out once."""

from tallyworks.operators import ranking


def test_scores_of_both_lists_are_worked_out_once(spark):
    base = spark.createDataFrame([(i, f"p{i:02}") for i in range(40)], "s int, p string")
    ends = ranking.top_and_bottom(base.selectExpr("s * 2 AS s", "p"), "s", "p", 2)
    assert sorted((r["list"], r["place"], r["s"], r["p"]) for r in ends.collect()) == [
        ("bottom", 1, 0, "p00"), ("bottom", 2, 2, "p01"), ("top", 1, 78, "p39"), ("top", 2, 76, "p38")]
    assert "* 2" not in ends._jdf.queryExecution().optimizedPlan().toString()
