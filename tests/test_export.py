"""Fixed-width validation and rendering on small fixtures."""

import glob

import pytest
from pyspark.sql import functions as F

from tallyworks.plans import fixedwidth as X
from tallyworks.plans.matrix import MATRIX
from tallyworks.sources.sinks import write_fixed_width

GOOD = {"F_NUMERO_REG": "1", "F_TIPO_REG": "201", "F_SUBTIPO_REG": "0", "F_VERSION_REG": "2", "F_CIA": "1", "F_ACTUALIZA_REG": "1",
        "F201_ID_TERCERO": "800", "F201_ID_SUCURSAL": "001", "F201_IND_ESTADO_ACTIVO": "1", "F201_DESCRIPCION_SUCURSAL": "Tienda",
        "F201_ID_MONEDA": "COP", "F201_IND_CALIFICACION": "A", "F201_ID_TIPO_CLI": "CL", "F201_FECHA_INGRESO": "20240105",
        "f201_valida_cupo_despacho": "0", "f201_frecuencia_entrega": "1000001", "f201_ind_valida_cartera_des": "1"}


def customers(spark, *changes):
    names = sorted({n.lower() for n in GOOD} | {k.lower() for c in changes for k in c})
    rows = []
    for i, change in enumerate(changes):
        values = {k.lower(): v for k, v in {**GOOD, **change}.items()}
        rows.append((i + 2, *[values.get(n) for n in names]))
    return spark.createDataFrame(rows, "row_number bigint, " + ", ".join(f"{n} string" for n in names))


def errors(spark, **change):
    got = X.error_report(X.validate(customers(spark, change), "row_number")).collect()
    return [(r.field, r.message.split()[0]) for r in got]


def test_matrix_width():
    assert len(MATRIX) == 62 and sum(f.width for f in MATRIX) == 1118


def test_a_good_record_has_no_errors_and_the_full_width(spark):
    validated = X.validate(customers(spark, {}, {"F201_CUPO_CREDITO": "-12.5", "F201_PORC_MIN_MARGEN": "7.5"}), "row_number")
    lines = {r.row_number: r.line for r in X.render_validated(validated, "row_number").collect()}
    assert {len(v) for v in lines.values()} == {1118} and set(lines) == {2, 3}
    assert lines[2].startswith("000000102010002001" + "1" + "800            001") and "-000000000000012.5000" in lines[3]
    assert "0007.50" in lines[3]


@pytest.mark.parametrize("change, expected", [
    ({"F_CIA": " NaN "}, [("F_CIA", "El")]),
    ({"F_CIA": "12x4"}, [("F_CIA", "El"), ("F_CIA", "Debe")]),
    ({"F201_IND_CALIFICACION": "D"}, [("F201_IND_CALIFICACION", "Debe")]),
    ({"F201_FECHA_INGRESO": "2024-1-5"}, [("F201_FECHA_INGRESO", "Formato")]),
    ({"f201_frecuencia_entrega": "1000002"}, [("f201_frecuencia_entrega", "Formato")]),
    ({"F201_CUPO_CREDITO": "mil"}, [("F201_CUPO_CREDITO", "Formato"), ("F201_CUPO_CREDITO", "El")]),
    ({"F201_CUPO_CREDITO": "1e3"}, []),
    ({"F201_CUPO_CREDITO": "12345678901234567"}, [("F201_CUPO_CREDITO", "El")]),
    ({"F201_PORC_MIN_MARGEN": "diez"}, [("F201_PORC_MIN_MARGEN", "Formato")]),
    ({"f201_id_cia_cliente_corp": "1"}, [("F201_ID_CLIENTE_CORP", "Obligatorio"), ("F201_ID_SUCURSAL_CORP", "Obligatorio")]),
    ({"F201_ID_CLIENTE_CORP": "9"}, [("f201_id_cia_cliente_corp", "Obligatorio")]),
    ({"F015_ID_PAIS": "169"}, [("F015_ID_DEPTO", "Obligatorio")]),
    ({"F015_ID_DEPTO": "05"}, [("F015_ID_CIUDAD", "Obligatorio")]),
])
def test_errors(spark, change, expected):
    assert errors(spark, **change) == expected


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="F_CIA"):
        X.validate(customers(spark, {}).drop("f_cia"), "row_number")


def test_all_or_nothing(spark, tmp_path):
    assert X.export_validated(customers(spark, {}, {"F_CIA": "x"}), "row_number", str(tmp_path / "no")).count() == 1
    assert not (tmp_path / "no").exists()
    assert X.export_validated(customers(spark, {}, {}), "row_number", str(tmp_path / "si")).isEmpty()
    text = b"".join(open(f, "rb").read() for f in sorted(glob.glob(str(tmp_path / "si" / "part-*"))))
    assert text.count(b"\r\n") == 2 and len(text) == 2 * 1120


def fmt(spark, expr, value):
    return spark.createDataFrame([(value,)], "x string").select(expr).first()[0]


def test_layout_formats(spark):
    x = F.col("x")
    for value, want in [("-12.34567", "-000000000000012.3457"), (None, "+000000000000000.0000"), ("x", "+000000000000000.0000")]:
        assert fmt(spark, X.signed_decimal(x, 21), value) == want
    assert fmt(spark, X.percentage(x, 7), "5") == "0005.00" and fmt(spark, X.percentage(x, 7), "-5") == "-005.00"
    for value, width, want in [(None, 4, "0000"), (None, 5, "     "), ("-12", 5, "-0012"), ("abc", 3, "000"), ("n.123456", 4, "1234"),
                               ("--7", 4, "-007"), ("  ", 5, "00000")]:
        assert fmt(spark, X.plain_number(x, width), value) == want
    assert fmt(spark, X.plain_text(x, 4), " abcdef ") == "abcd"


def test_records_by_layout(spark):
    layout = spark.createDataFrame([("F_NUMERO_REG", "Numérico", "Si", "1", "3"), ("F_TIPO_REG", "Numérico", "Si", "4", "4"),
                                    (None, None, None, "1", "2"), ("Código", "Alfanumérico", "Si", "10", "5"), ("Título", None, None, None, None)],
                                   "name string, type string, mandatory string, start string, size string")
    places = X.read_layout(layout)
    assert [(p.name, p.start, p.width) for p in places] == [("F_NUMERO_REG", 1, 3), ("F_TIPO_REG", 4, 4), ("CODIGO", 10, 5)]
    rows = spark.createDataFrame([(1, "ab"), (2, None)], "number bigint, `código` string")
    out = {r.number: r for r in X.render_records(rows, places, "number").collect()}
    assert out[1].line == "0010201  ab   " and out[1].warnings == [] and out[2].warnings == ["Campo obligatorio vacío: Código"]
    overlap = [places[0], places[1]._replace(start=3)]
    assert {r.line for r in X.render_records(rows, overlap, "number").collect()} == {"000201"}


def test_blank_rows_are_dropped(spark):
    df = spark.createDataFrame([(" ", None), ("a", None), (None, None)], "a string, b string")
    assert X.drop_blank_rows(df).count() == 1


def test_cp1252_text(spark, tmp_path):
    write_fixed_width(spark.createDataFrame([("año “x” 5 € ",)], "line string"), str(tmp_path / "t"), "cp1252")
    text = b"".join(p.read_bytes() for p in (tmp_path / "t").glob("part-*"))
    assert text == "año “x” 5 € \r\n".encode("cp1252")
    with pytest.raises(Exception, match="not in cp1252"):
        write_fixed_width(spark.createDataFrame([("日本",)], "line string"), str(tmp_path / "u"), "cp1252")
