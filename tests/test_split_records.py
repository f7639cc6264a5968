"""Quoted records in splits of a few bytes against Python's csv."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from tallyworks.sources import split_records as R


def written(folder, texts):
    folder.mkdir()
    for i, t in enumerate(texts):
        (folder / f"f{i}.csv").write_bytes(t if isinstance(t, bytes) else t.encode())
    return str(folder)


def by_csv(text, sep):
    return [[str(f) for f in r] for r in csv.reader(io.StringIO(text, newline=""), delimiter=sep) if r]


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum") if spark.conf.get(k, None)}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.unset(k) if k not in before else spark.conf.set(k, before[k])


@pytest.mark.parametrize("seed, sep", [(1, ","), (2, ";"), (3, "\t"), (4, "|")])
def test_random_files_as_csv(spark, tmp_path, small_splits, seed, sep):
    rnd = random.Random(seed)
    texts = []
    for _ in range(12):
        if rnd.random() < 0.5:  # as a writer makes them
            out = io.StringIO()
            csv.writer(out, delimiter=sep, lineterminator=rnd.choice(["\n", "\r\n"])).writerows(
                [["".join(rnd.choice('ab" \n\r' + sep) for _ in range(rnd.randrange(9))) + "x" for _ in range(rnd.randrange(1, 4))] for _ in range(rnd.randrange(1, 7))])
            texts.append(out.getvalue())
        else:  # anything, with stray quotes
            texts.append("".join(rnd.choice('ab"""\n' + sep) for _ in range(rnd.randrange(60))))
    made = R.split_cells(R.split_records(spark, written(tmp_path / "in", texts), sep))
    got = {}
    for r in made.withColumn("i", F.regexp_extract("file", r"f(\d+)\.csv", 1).cast("int")).collect():
        got.setdefault(r["i"], []).append((r["record"], r["fields"]))
    for i, t in enumerate(texts):
        want = by_csv(t, sep)
        assert [f for _, f in sorted(got.get(i, []))] == want, t
        assert len({n for n, _ in got.get(i, [])}) == len(want)


def test_numbers_separators_and_encodings(spark, tmp_path, small_splits):
    texts = ['a;b\n' * 5 + '"1\n2";x\n\n"3""";y\n', "a,b\r\n1,2\r\n3,4", ("é;1\n" * 5 + '"ñ\nü";2\n').encode("latin-1"), "", 'x,"never\nclosed,1\n2,3']
    made = R.split_cells(R.split_records(spark, written(tmp_path / "in", texts)))
    got = sorted((int(r["file"][-5]), r["record"], r["fields"]) for r in made.collect())
    assert got == [*[(0, i, ["a", "b"]) for i in range(5)], (0, 5, ["1\n2", "x"]), (0, 7, ['3"', "y"]), (1, 0, ["a", "b"]), (1, 1, ["1", "2"]), (1, 2, ["3", "4"]),
                   *[(2, i, ["é", "1"]) for i in range(5)], (2, 5, ["ñ\nü", "2"]), (4, 0, ["x", "never\nclosed,1\n2,3"])]
