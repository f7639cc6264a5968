"""Profiling, sniffing and scoring on small fixtures."""

import os

from pyspark.sql import functions as F

from tallyworks.plans import profiling as PF
from tallyworks.plans import report as R
from tallyworks.plans import scoring as SC
from tallyworks.plans.rules import CODES, RULES, TOTAL_WEIGHT
from tallyworks.sources.cells import fields_of, file_cells, records_of
from tallyworks.sources import delimited, files, messages, sinks


def sep(spark, text):
    return spark.createDataFrame([(text,)], "t string").select(delimited.separator_of(F.col("t"))).first()[0]


def test_separator(spark):
    assert sep(spark, "a;b;c\n1;2;3\n") == ";"
    assert sep(spark, "a,b\n1,2") == "," and sep(spark, "") == "," and sep(spark, "solo\notro") == ","
    assert sep(spark, "a\tb\r\n1\t2\r\n") == "\t"
    assert sep(spark, "a,b;c,d\n1,2;3") == ";"
    assert sep(spark, "a|b,c\n\n1|2,3\n4|5,6,7") == "|"
    assert sep(spark, "a;b\n1;2\n3;4\n5;6\n7;8\nsexta,linea,rara") == ";"


def test_encoding(spark):
    df = spark.createDataFrame([(bytearray("año".encode()),), (bytearray("año".encode("latin-1")),)], "b binary")
    assert [r[0] for r in df.select(delimited.encoding_of(F.col("b"))).collect()] == ["utf-8", "latin-1"]


def test_read_delimited_pads_short_rows_and_skips_long_ones(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes('id;"nom;bre";x\n1;ñ;NA\n2;"a;b"\n\n3;a;b;c\n4;"l1\nl2";null\n'.encode("latin-1"))
    got = delimited.read_delimited(spark, str(path), sep=";").collect()
    assert sorted(tuple(r) for r in got) == [("1", "ñ", None), ("2", "a;b", None), ("4", "l1\nl2", None)]
    assert got[0].asDict().keys() == {"id", "nom;bre", "x"}


def test_read_delimited_utf8_split_by_lines(spark, tmp_path):
    path = tmp_path / "b.txt"
    path.write_text("a,b\n1,año\n2,N/A\n", encoding="utf-8")
    assert [tuple(r) for r in delimited.read_delimited(spark, str(path)).orderBy("a").collect()] == [("1", "año"), ("2", None)]


def test_inventory(spark, tmp_path):
    for name in ["a.CSV", "sub/dos/b.xlsx", "sub/~$b.xlsx", "c.msg", "d.pdf", ".csv"]:
        p = tmp_path / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(b"x" * 1536)
    got = sorted((r["name"], r.subfolder, r.kind, r.size_kb) for r in files.file_inventory(spark, str(tmp_path)).collect())
    assert got == [("a.CSV", ".", "datos", 1.5), ("b.xlsx", "sub/dos", "datos", 1.5), ("c.msg", ".", "correo", 1.5)]


def test_errors_with_sheets_are_scored(spark):
    df = spark.createDataFrame([("a", None, 0), ("b", "e", 0), ("c", "e", 2)], "path string, error string, num_sheets int")
    scored, errors = files.split_errors(df)
    assert {r.path for r in scored.collect()} == {"a", "c"} and {r.path for r in errors.collect()} == {"b"}


def test_attachments(spark):
    df = spark.createDataFrame([("m", "p", None, "", "d", [("X.CSV", bytearray(b"z" * 512)), (None, None), ("y.pdf", bytearray(b"1"))])],
                               "message string, path string, subject string, sender string, date string, "
                               "attachments array<struct<name:string,data:binary>>")
    rows = messages.attachment_rows(df)
    assert sorted((r.attachment, r.extension, r.size_kb, r.is_data, r.subject, r.sender) for r in rows.filter("size_kb is not null").collect()) == [
        ("X.CSV", ".csv", 0.5, True, "(sin asunto)", "?"), ("y.pdf", ".pdf", 0.0, False, "(sin asunto)", "?")]
    assert [r["name"] for r in messages.attachment_inputs(rows).collect()] == ["X.CSV"]


CELLS = "file string, sheet string, row bigint, col bigint, value string"


def cells(spark, sheet, grid):
    return spark.createDataFrame([("f", sheet, r, c, v) for r, line in enumerate(grid) for c, v in enumerate(line)], CELLS)


def test_header_after_blank_rows_and_blank_sheet(spark):
    grid = [[None, None, None]] * 3 + [["Id", " ", "Valor"], ["1", None, "2.5"], [None, None, None], ["2", None, "x"], [None, None, None]]
    both = cells(spark, "a", grid).unionByName(cells(spark, "vacia", [[None, None], [None, None]])).unionByName(
        cells(spark, "solo", [["Titulo", "Otro"]]))
    sheets, body = PF.promote_header(both, hot_rows=2)
    rows = {r.sheet: r for r in PF.sheet_summary(sheets, body).collect()}
    a = rows["a"]
    assert (a.is_blank, a.header_row, a.header_in_row1, a.num_columns, a.rows_with_data, a.rows_blank) == (False, 3, False, 3, 2, 1)
    assert a.columns == "Id | Col_1 | Valor" and a.mixed_columns == "Valor" and a.pct_clean == 100.0
    assert rows["vacia"].is_blank and rows["vacia"].header_row == 0 and rows["solo"].is_blank and rows["solo"].num_columns == 0
    types = {r.column: (r.type, r.pct_null) for r in PF.column_profile(sheets, body).filter("sheet = 'a'").collect()}
    assert types == {"Id": ("numérico", 33.3), "Col_1": ("vacío", 100.0), "Valor": ("mixto", 33.3)}


def test_types_need_more_than_four_fifths(spark):
    df = spark.createDataFrame([("1", "2024-01-01", "a", None)] * 4 + [("x", "no", "b", None)], "n string, d string, t string, e string")
    assert {r.column: r.type for r in PF.profile_types(df, infer=True).collect()} == {
        "n": "mixto", "d": "texto", "t": "texto", "e": "vacío"}
    more = df.unionByName(spark.createDataFrame([("1.5", "2024-01-02 10:00", "c", None)], df.schema))
    assert {r.column: r.type for r in PF.profile_types(more, infer=True).collect()} == {
        "n": "numérico", "d": "fecha", "t": "texto", "e": "vacío"}


def test_groups(spark):
    def group(path, folder, prefixes=()):
        return spark.createDataFrame([(path, folder)], "p string, s string").select(
            PF.infer_group(F.col("p"), F.col("s"), prefixes)).first()[0]

    assert group("/r/clientes/x.csv", "clientes\\enero") == "CLIENTES"
    assert group("/r/x.csv", "ims/co/1", [("ims/co", "IMS_CO")]) == "IMS_CO"
    assert group("/r/Ventas norte 2024-03-15.xlsx", ".") == "VENTAS_NORTE" and group("/r/2024-03.csv", ".") == "SIN_GRUPO"


def test_schema_consistency_counts_the_first_sheet(spark):
    df = spark.createDataFrame([("g", "a", ["x", "y"]), ("g", "b", ["x", "y"]), ("g", "c", ["x", "z"])], "g string, p string, columns array<string>")
    for hot in (1, 100):
        r = PF.schema_consistency(df, "g", ["p"], hot_rows=hot).first()
        assert r.sheets == 3 and abs(r.similarity - (1 + 1 + 1 / 3) / 3) < 1e-12


def test_membership_lists_fifteen_names(spark):
    df = spark.createDataFrame([("big", f"d/f{i:02}.csv") for i in range(17)] + [("one", "d/x.csv")], "group string, path string")
    rows = {r.group: r for r in PF.group_membership(df).collect()}
    assert rows["big"].files == 17 and rows["big"].evaluable and rows["big"].names.endswith("f14.csv...") and not rows["one"].evaluable


def scored(spark, **levels):
    row = {f"level_{c}": levels.get(c, levels.get("rest")) for c in CODES}
    return SC.score_files(spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} int" for k in row))).first()


def test_scores(spark):
    best = scored(spark, rest=0)
    # Fifteen rounded parts add up to 99.95.
    assert best.score == round(99.95, 1) == 100.0
    assert best.category.endswith("Automatizable") and best.blocked_by is None
    two = scored(spark, rest=0, G=10, E=10)
    assert two.score == 20.0 and two.blocked_by == "G" and two.points_G == 0.0
    none = scored(spark)
    assert none.score == 0.0 and none.category.endswith("No evaluable") and none.blocked_by is None
    part = scored(spark, B=0, A=4)
    assert part.score == round(round(12 / 113 * 100, 2) * (113 / 17), 1) and part.points_A == 0.0
    unusable_but_free = scored(spark, rest=0, L=10)
    assert unusable_but_free.points_L == 0.0 and unusable_but_free.blocked_by is None
    assert TOTAL_WEIGHT == 113 and len(RULES) == 15


def test_kpis_and_categories(spark):
    df = spark.createDataFrame([("a", 90.0, "🟢 Automatizable"), ("a", 45.5, "🟠 Automatizable con esfuerzo")], "group string, score double, category string")
    assert tuple(R.score_kpis(df).first()) == (67.8, 90.0, 45.5, 2)
    assert [r.files for r in R.category_distribution(df).orderBy("place").collect()] == [1, 0, 1, 0, 0, 0]
    assert tuple(R.score_kpis(df.filter("score < 0")).first()) == (0.0, 0.0, 0.0, 0)


def test_report_is_written_and_replaced(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "a int")
    for _ in range(2):
        paths = sinks.write_report({"uno": df, "dos": df}, str(tmp_path))
    assert spark.read.parquet(paths["dos"]).count() == 1 and os.path.isdir(paths["uno"])


def test_excerpt_counts_what_it_leaves_out(spark):
    first, beyond = R.excerpt(spark.range(60), ["id"])
    assert [r.id for r in first.collect()] == list(range(50)) and beyond.first().beyond == 10
    assert R.excerpt(spark.range(3), ["id"])[1].first().beyond == 0


def test_file_metrics_feed_both_scores(spark):
    grid = [["fecha", "qty", "x"], ["2024-01-01", "1", "a"], ["2024-01-02", "2", "7"], ["2024-01-03", "3", None]]
    both = cells(spark, "a", [[None] * 3] * 2 + grid).unionByName(cells(spark, "vacia", [[None, None]]))
    sheets, body = PF.promote_header(both)
    r = PF.file_metrics(PF.sheet_summary(sheets, body), PF.column_profile(sheets, body)).first()
    assert (r.sheets, r.blank_sheets, r.sheets_with_data, r.header_ok, r.leading_blank) == (2, 1, 1, 0, 2)
    assert (r.total_columns, r.mixed, r.has_date_column, r.columns) == (3, 1, True, ["fecha", "qty", "x"])
    assert abs(r.mean_null - 33.3 / 3) < 1e-9 and r.mean_clean == 100.0


def test_cells_of_mixed_files(spark):
    files = [("b", "año,b\n,\n1,2".encode("latin-1")), ("c", b""), ("d", None), ("e", b"q" * 50000 + b'\n"open'),
             ("f", b'"' * 3001)]
    df = spark.createDataFrame([(n, None if c is None else bytearray(c), 1) for n, c in files], "path string, content binary, value int")
    got = {}
    for r in file_cells(df).collect():
        got.setdefault(r["file"], {})[r["row"], r["col"]] = r["value"]
    assert got["b"] == {(0, 0): "año", (0, 1): "b", (1, 0): None, (1, 1): None, (2, 0): "1", (2, 1): "2"}
    assert "c" not in got and "d" not in got and got["e"][0, 0] == "q" * 50000 and got["e"][1, 0] == "open"
    even = spark.createDataFrame([("g", bytearray(b'x;"n""o;m"\n;1\n2;NA;9\n3;"l1\nl2"\r\nz'))], "path string, content binary")
    fields = even.select(F.transform(records_of(F.col("content").cast("string")), lambda r: fields_of(r, F.lit(";")))).first()[0]
    assert fields == [["x", 'n"o;m'], ["", "1"], ["2", "NA", "9"], ["3", "l1\nl2"], ["z"]]


def test_schema_consistency_of_wide_sheets_as_sets(spark):
    import random

    from tallyworks.plans.profiling import schema_consistency

    rnd = random.Random(8)
    wide = [f"c{i}" for i in range(10_000)]
    rows = [("a", i, rnd.sample(wide, rnd.choice([9_000, 10_000]))) for i in range(6)] + [("a", 9, ["x", "x", "c1"]), ("a", 10, ["x", "x", "c1"])]
    rows += [("b", 2, []), ("b", 1, []), ("c", 1, ["q", None]), ("c", 2, [None]), (None, 1, ["z"])]
    got = schema_consistency(spark.createDataFrame(rows, "g string, at int, columns array<string>"), "g", ["at"]).collect()
    for r in got:
        own = sorted(((at, set(c)) for g, at, c in rows if g == r["g"]), key=lambda x: x[0])
        want = [len(c & own[0][1]) / max(len(c | own[0][1]), 1) for _, c in own]
        assert r["sheets"] == len(own) and abs(r["similarity"] - sum(want) / len(want)) < 1e-12
    assert {r["g"] for r in got} == {"a", "b", "c", None}
