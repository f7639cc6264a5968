"""Keyword lists and text patterns of the file rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyworks.functions.strings import strip

# Keyword lists (regular expressions, tried without regard to case).
CLIENT_WORDS = ["cliente", "client", "sold", "customer", "cuenta", "farmacol", "audifarma", "copidrogas",
                "drogas", "distribuidor", "dealer"]
SALES_WORDS = ["venta", "sale", "sell", "sellout", "factura", "invoice", "revenue", "despacho", "pedido",
               "orden", "sell.out", "sell_out"]
STOCK_WORDS = ["inventario", "inventory", "stock", "bodega", "warehouse", "existencia", "saldo", "onhand",
               "on_hand"]
PURCHASE_WORDS = ["ims", "iqvia", "sell.in", "sellin", "sell_in", "compra", "purchase"]
PERIOD_WORDS = ["fecha", "date", "period", "mes", "month", "año", "year", "semana", "week", "trimestre",
                "quarter", "periodo"]
UNIT_WORDS = ["unidad", "unit", "qty", "cantidad", "cant", "uds", "piezas", "cajas", "box", "pieces",
              "units", "cantidad_vendida"]
VALUE_WORDS = ["valor", "value", "monto", "amount", "precio", "price", "venta", "amt", "total", "importe",
               "revenue", "sales"]
PRODUCT_WORDS = ["producto", "product", "item", "articulo", "sku", "cod", "codigo", "referencia", "ref",
                 "d56", "ndc", "gtin"]
CURRENCY_WORDS = ["usd", "cop", "eur", "clp", "mxn", "currency", "moneda", r"\$", "pesos", "dolares",
                  "dólares"]

# Date-like tokens of a file name.
DATE_IN_NAME = [r"\d{4}[-_]\d{2}[-_]\d{2}", r"\d{2}[-_]\d{2}[-_]\d{4}", r"\d{4}[-_]\d{2}(?!\d)",
                "(ene|feb|mar|abr|may|jun|jul|ago|sep|oct|nov|dic)",
                "(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)",
                r"q[1-4][-_]\d{4}", r"\d{4}q[1-4]"]

# Single patterns of the rules.
DATE_COLUMN = ["fecha", "date", "period", "mes", "month"]
OWN_PRODUCT_CODE = [r"\bd56\b"]
MAKER_PRODUCT_CODE = [r"(cod|ref|sku)[\s_]?(abbott|prod)"]
CLIENT_PRODUCT_CODE = ["cod", "ref", "sku", "item"]
UNIT_OF_MEASURE = ["uom", "unidad_medida", "unit_measure"]
LONG_DATE_IN_NAME = r"[\s_\-]?\d{4}[-_]?\d{0,2}"
FULL_DATE_IN_NAME = r"[\s_\-]?\d{4}[-_]?\d{0,2}[-_]?\d{0,2}"
NAME_OUTSIDE_CLEAN = r"[^a-zA-Z0-9áéíóúÁÉÍÓÚñÑüÜ _\-./()]"
PASSWORD_WORDS = ["password", "encrypted", "proteg", "contraseña", "decrypt", "workbook is encrypted"]

# Exact field formats.
EIGHT_DIGITS = r"^\d{8}$"
SEVEN_FLAGS = r"^[01]{7}$"
TWO_DECIMALS = r"^\d{1,4}\.\d{2}$"
SIGNED_CREDIT = r"^[+-]\d{15}\.\d{4}$"


# Joins names into one text so that one pass tests them all; no pattern above spans it.
NAME_MARK = "\x00"


def _plain(pattern: str) -> bool:
    return not any(c in pattern for c in r".\[](){}*+?|^$")


def any_sql(text: str, patterns: Sequence[str]) -> str:
    """SQL test whether any pattern occurs in a lower-case text.

    Plain words are searched as such, which is far cheaper than an alternation; a word containing
    another word of the list adds nothing. What remains is tried as one regular expression.
    """
    words = [p for p in patterns if _plain(p)]
    words = [w for w in words if not any(v != w and v in w for v in words)]
    tests = [f"contains({text}, '{w}')" for w in words]
    rest = [p for p in patterns if not _plain(p)]
    if rest:
        tests.append(f"{text} RLIKE r'({'|'.join(rest)})'")
    return "(" + " OR ".join(tests) + ")"


def mentions(text: str, patterns: Sequence[str]) -> Column:
    """Whether any pattern occurs in a lower-case text column; a missing text mentions nothing."""
    return F.expr(f"coalesce({any_sql(text, patterns)}, false)")


def count_mentions(names: str, patterns: Sequence[str]) -> Column:
    """How many texts of a column of lower-case lists mention any pattern."""
    return F.expr(f"greatest(size(filter({names}, n -> {any_sql('n', patterns)})), 0)")


def joined_names(names: Column) -> Column:
    """The names of a list as one lower-case text."""
    return F.lower(F.array_join(names, NAME_MARK))


def date_in_name(text: str) -> Column:
    return mentions(text, DATE_IN_NAME)


def is_clean_name(name: Column) -> Column:
    """Column name that is given, not generated, and uses plain characters only."""
    return ((strip(name) != "") & ~name.startswith("Unnamed") & ~name.rlike(NAME_OUTSIDE_CLEAN))


def is_password_error(message: str) -> Column:
    """Whether a lower-case error message speaks of a password."""
    return mentions(message, PASSWORD_WORDS)
