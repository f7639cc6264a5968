"""Fixed values of the file scoring: the fifteen rules, the eight criteria, the categories."""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    code: str
    description: str
    weight: int
    max_level: int
    ceiling: int | None  # set for blocking rules: the highest score a file at level 10 can reach
    measured: bool       # False: the level is an estimate to be checked by a person
    levels: dict[int, str]


RULES = (
    Rule("A", "Fecha de la fuente", 5, 4, None, True, {
        0: "Dentro del archivo", 1: "Nombre del archivo", 2: "Metadata del correo", 3: "Metadata del archivo OS",
        4: "No incorporada - requiere alteración o mapeo"}),
    Rule("B", "Cod cliente ERP Sold to", 12, 5, None, False, {
        0: "Campo con nombre y código interno del cliente", 1: "A partir del nombre del documento",
        2: "A partir de usuarios que reportan", 3: "A partir de coincidencias Regex",
        4: "Requiere mapeo de coincidencias", 5: "Requiere alterar el archivo base"}),
    Rule("C", "Periodo de la información", 7, 5, None, True, {
        0: "Campo identificable estándar", 1: "Campo identificable no estándar", 2: "Combinación de datos",
        3: "Nombre archivo (estándar)", 4: "Nombre archivo (modificado por usuario)",
        5: "Requiere alterar el archivo base"}),
    Rule("D", "Frecuencia de generación", 3, 2, None, False, {
        0: "Automático con calendario", 1: "Fuente estructurada, frecuencia por usuario",
        2: "Requiere transformación previa"}),
    Rule("E", "Nombres de columnas", 10, 3, 50, True, {
        0: "Siguen la estructura requerida para consolidación", 1: "Siempre los mismos nombres",
        2: "La mayoría de veces los mismos nombres",
        3: "Varían: a veces más/menos columnas o nombres distintos", 10: "Sin estructura mínima continuada"}),
    Rule("F", "Fuente del documento", 3, 3, None, False, {
        0: "Fuente centralizada (portal proveedores)", 1: "Proceso estándar (ERP / plantilla)",
        2: "Transformación por plantillas preconstruidas", 3: "Transformación particular para el propósito"}),
    Rule("G", "Integridad del documento", 8, 2, 20, True, {
        0: "Sin errores, con protección por contraseña", 1: "Sin errores al abrir",
        2: "Errores pero legible automáticamente", 5: "Errores; requiere persona para recuperar",
        10: "Archivo no recuperable"}),
    Rule("H", "Cantidad de hojas", 5, 4, None, True, {
        0: "Una sola hoja con la info requerida", 1: "Varias hojas con la info requerida",
        2: "Varias hojas con info extra no requerida", 3: "Info requerida fragmentada en varias hojas",
        4: "Hojas con nombres distintos cada vez"}),
    Rule("I", "Cantidad de elementos", 7, 3, 35, True, {
        0: "Tabular bajo Sheet", 1: "Tabular bajo Table", 2: "Tabular bajo PivotTable", 3: "Mezcla de elementos",
        10: "Sin estructura tabular en ningún elemento"}),
    Rule("J", "Limpieza del formato tabular", 14, 4, 40, True, {
        0: "Desde primera celda; todos los campos completos", 1: "Mayoría completos, parten de primera fila",
        2: "Requiere eliminar filas iniciales", 3: "Requiere eliminar filas iniciales e intermedias",
        4: "Requiere eliminar columnas y filas", 10: "Se consolida de formas no estándar"}),
    Rule("K", "Información Normalizada", 11, 5, 45, True, {
        0: "Cada campo = una dimensión", 1: "Algunos campos incumplen normalidad",
        2: "Un pivoteo logra la estructura normalizada", 3: "Combinación de elementos para normalizar",
        4: "Requiere cruces internos en el documento", 5: "Mapeo unificado y exclusivo por documento",
        10: "Requiere IA u análisis avanzado"}),
    Rule("L", "Referencias (producto)", 9, 4, None, False, {
        0: "Campo con referencia directa al código D56", 1: "Campo con código interno Abbott",
        2: "Referencia del cliente usable como clave única", 3: "Solo nombre del producto",
        4: "Código agrupado del cliente"}),
    Rule("M", "Unidades reportadas (Qty)", 7, 3, None, False, {
        0: "Campo identificable sin conversiones", 1: "En varias columnas (resultado de cálculo)",
        2: "Identificable pero requiere conversión de unidad", 3: "Campo identificable (nivel base)"}),
    Rule("N", "Propósito de la información", 5, 2, None, True, {
        0: "Claro: ventas o inventario", 1: "Identificable por nombres de columnas",
        2: "Solo por nombre archivo / hojas / correo"}),
    Rule("O", "Valor de ventas (Monetario)", 7, 3, None, False, {
        0: "Columna identificable, moneda clara", 1: "Varias columnas, moneda identificable",
        2: "Moneda no identificable, debe inferirse", 3: "Columna variable y moneda no inferible"}),
)
CODES = tuple(r.code for r in RULES)
TOTAL_WEIGHT = sum(r.weight for r in RULES)
UNUSABLE = 10

# Categories by least score, best first, and the one for a file without any rule level.
CATEGORIES = ((85, "🟢 Automatizable"), (65, "🟡 Automatizable con controladores"),
              (40, "🟠 Automatizable con esfuerzo"), (20, "🔴 Difícil"), (0, "⛔ No automatizable"))
NOT_EVALUABLE = "⛔ No evaluable"

# The eight-criteria model: weights and categories.
CRITERIA = {"structure": 20, "no_formulas": 15, "few_nulls": 20, "same_types": 15, "clean_names": 10,
            "one_table": 10, "no_blank_sheets": 5, "few_sheets": 5}
EIGHT_CATEGORIES = ((80, "🟢 Alta"), (55, "🟡 Media"), (30, "🟠 Baja"), (0, "🔴 Muy baja"))

# Thresholds of schema similarity and of clean names -> level of rule E.
SIMILARITY_LEVELS = ((0.95, 1), (0.80, 2), (0.50, 3))
CLEAN_LEVELS = ((80, 1), (40, 3))
