"""Numbers in input order over small splits, and positional records read back."""

import pytest
from pyspark.sql import functions as F

from tallyworks.operators.ranking import number_in_input_order
from tallyworks.sources import sinks


def test_numbers_over_splits_and_files(spark, tmp_path):
    texts = {"a": [f"r{i}" for i in range(40)], "b": [], "c": ["x", "y"], "d": [f"s{i}" for i in range(25)]}
    for name, lines in texts.items():
        (tmp_path / f"{name}.txt").write_text("".join(line + "\n" for line in lines))
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "11")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = number_in_input_order(spark.read.text(str(tmp_path)), start=5).collect()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    assert [r["value"] for r in sorted(got, key=lambda r: r["record_number"])] == [line for lines in texts.values() for line in lines]
    assert sorted(r["record_number"] for r in got) == list(range(5, 5 + len(got)))


def test_positional_records_with_breaks_inside(spark, tmp_path):
    rows = [(f"{i:04}", "ñ€ü\r\nx" if i % 3 else "plain ") for i in range(200)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "part.txt").write_bytes("".join(a + b + "\r\n" for a, b in rows).encode("cp1252"))
    got = sinks.read_fixed_width(spark, str(tmp_path / "in"), [("id", 1, 4), ("name", 5, 6)], 10)
    assert sorted(map(tuple, got.collect())) == rows
    (tmp_path / "in" / "part.txt").write_bytes(b"0001plain\r\n")
    with pytest.raises(ValueError, match="no multiple of 12"):
        sinks.read_fixed_width(spark, str(tmp_path / "in"), [("id", 1, 4)], 10)


def test_every_cp1252_character(spark):
    codes = [c for c in range(256) if c not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]
    one = spark.createDataFrame([(bytes([c]),) for c in codes], "b binary").select(sinks.from_cp1252(F.col("b")).alias("t")).collect()
    assert [r["t"] for r in one] == [bytes([c]).decode("cp1252") for c in codes]
