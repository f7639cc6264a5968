"""The field matrix of the customer record (type 201), widths adding up to 1,118."""

from __future__ import annotations

from typing import NamedTuple

NUMBER, TEXT, DECIMAL, CREDIT, DAY, FREQUENCY = (
    "Numérico", "Alfanumérico", "Decimal_4_2", "Cupo", "Fecha", "Frecuencia")
MANDATORY, OPTIONAL, DEPENDENT = "Si", "No", "Dep"


class Field(NamedTuple):
    name: str
    kind: str
    obligation: str
    width: int


MATRIX = tuple(Field(*f) for f in (
    ("F_NUMERO_REG", NUMBER, MANDATORY, 7),
    ("F_TIPO_REG", NUMBER, MANDATORY, 4),
    ("F_SUBTIPO_REG", NUMBER, MANDATORY, 2),
    ("F_VERSION_REG", NUMBER, MANDATORY, 2),
    ("F_CIA", NUMBER, MANDATORY, 3),
    ("F_ACTUALIZA_REG", NUMBER, MANDATORY, 1),
    ("F201_ID_TERCERO", TEXT, MANDATORY, 15),
    ("F201_ID_SUCURSAL", TEXT, MANDATORY, 3),
    ("F201_IND_ESTADO_ACTIVO", NUMBER, MANDATORY, 1),
    ("F201_DESCRIPCION_SUCURSAL", TEXT, MANDATORY, 40),
    ("F201_ID_MONEDA", TEXT, MANDATORY, 3),
    ("F201_ID_VENDEDOR", TEXT, OPTIONAL, 4),
    ("F201_IND_CALIFICACION", TEXT, MANDATORY, 1),
    ("F201_ID_COND_PAGO", TEXT, OPTIONAL, 3),
    ("F201_DIAS_GRACIA", NUMBER, OPTIONAL, 3),
    ("F201_CUPO_CREDITO", CREDIT, OPTIONAL, 21),
    ("F201_ID_CLIENTE_CORP", TEXT, DEPENDENT, 15),
    ("F201_ID_SUCURSAL_CORP", TEXT, DEPENDENT, 3),
    ("F201_ID_TIPO_CLI", TEXT, MANDATORY, 4),
    ("F201_ID_GRUPO_DSCTO", TEXT, OPTIONAL, 4),
    ("F201_ID_LISTA_PRECIO", TEXT, DEPENDENT, 3),
    ("F201_IND_PEDIDO_BACKORDER", NUMBER, DEPENDENT, 1),
    ("F201_PORC_EXCESO_VENTA", DECIMAL, DEPENDENT, 7),
    ("F201_PORC_MIN_MARGEN", DECIMAL, DEPENDENT, 7),
    ("F201_PORC_MAX_MARGEN", DECIMAL, DEPENDENT, 7),
    ("F201_IND_BLOQUEADO", NUMBER, DEPENDENT, 1),
    ("F201_IND_BLOQUEO_CUPO", NUMBER, DEPENDENT, 1),
    ("F201_IND_BLOQUEO_MORA", NUMBER, DEPENDENT, 1),
    ("F201_IND_FACTURA_UNIFICADA", NUMBER, DEPENDENT, 1),
    ("F201_ID_CO_FACTURA", TEXT, OPTIONAL, 3),
    ("F201_NOTAS", TEXT, OPTIONAL, 255),
    ("F015_CONTACTO", TEXT, OPTIONAL, 50),
    ("F015_DIRECCION1", TEXT, OPTIONAL, 40),
    ("F015_DIRECCION2", TEXT, OPTIONAL, 40),
    ("F015_DIRECCION3", TEXT, OPTIONAL, 40),
    ("F015_ID_PAIS", TEXT, OPTIONAL, 3),
    ("F015_ID_DEPTO", TEXT, DEPENDENT, 2),
    ("F015_ID_CIUDAD", TEXT, DEPENDENT, 3),
    ("F015_ID_BARRIO", TEXT, OPTIONAL, 40),
    ("F015_TELEFONO", TEXT, OPTIONAL, 20),
    ("F015_FAX", TEXT, OPTIONAL, 20),
    ("F015_COD_POSTAL", TEXT, OPTIONAL, 10),
    ("F015_EMAIL", TEXT, OPTIONAL, 255),
    ("F201_FECHA_INGRESO", DAY, MANDATORY, 8),
    ("F201_ID_CO_MOVTO_FACTURA", TEXT, OPTIONAL, 3),
    ("F201_ID_UN_MOVTO_FACTURA", TEXT, OPTIONAL, 20),
    ("F201_ID_PARAMETRO_EDI", TEXT, OPTIONAL, 4),
    ("F201_CODIGO_EAN", TEXT, OPTIONAL, 35),
    ("f201_fecha_cupo", DAY, OPTIONAL, 8),
    ("f201_porc_tolerancia", DECIMAL, OPTIONAL, 7),
    ("f201_dia_maximo_factura", NUMBER, OPTIONAL, 2),
    ("f201_id_motivo_bloqueo", TEXT, OPTIONAL, 3),
    ("f201_id_cobrador", TEXT, OPTIONAL, 4),
    ("f201_ind_compromiso_um_emp", NUMBER, OPTIONAL, 1),
    ("f201_ind_anticipo_terc_corp", NUMBER, OPTIONAL, 1),
    ("f015_celular", TEXT, OPTIONAL, 50),
    ("f201_valida_cupo_despacho", NUMBER, MANDATORY, 1),
    ("f201_id_portafolio_edi", TEXT, OPTIONAL, 10),
    ("f201_frecuencia_entrega", FREQUENCY, MANDATORY, 7),
    ("f201_id_cia_cliente_corp", NUMBER, DEPENDENT, 3),
    ("f201_ind_valida_cartera_des", NUMBER, MANDATORY, 1),
    ("f201_ind_exceso_venta_adic", NUMBER, OPTIONAL, 1),
))

# Field that must be filled when any of the named fields is, with the message.
DEPENDENCIES = (
    ("F201_ID_CLIENTE_CORP", ("f201_id_cia_cliente_corp",),
     "Obligatorio porque 'f201_id_cia_cliente_corp' tiene datos."),
    ("F201_ID_SUCURSAL_CORP", ("f201_id_cia_cliente_corp",),
     "Obligatorio porque 'f201_id_cia_cliente_corp' tiene datos."),
    ("f201_id_cia_cliente_corp", ("F201_ID_CLIENTE_CORP", "F201_ID_SUCURSAL_CORP"),
     "Obligatorio si se envía cliente o sucursal corporativa."),
    ("F015_ID_DEPTO", ("F015_ID_PAIS",), "Obligatorio porque existe el campo País."),
    ("F015_ID_CIUDAD", ("F015_ID_DEPTO",), "Obligatorio porque existe el campo Departamento."),
)

# Values one field is limited to.
RATING_FIELD, RATINGS = "F201_IND_CALIFICACION", ("A", "B", "C")

# Messages.
MSG_MANDATORY = "El campo es obligatorio."
MSG_LENGTH = "El tamaño supera el máximo permitido ({})."
MSG_NUMBER = "Debe ser un valor estrictamente numérico entero."
MSG_RATING = "Debe ser exactamente 'A', 'B' o 'C'."
MSG_DAY = "Formato de fecha inválido. Debe ser AAAAMMDD."
MSG_FREQUENCY = "Formato inválido. Deben ser 7 dígitos de unos y ceros (ej. 1000001)."
MSG_DECIMAL = "Formato decimal inválido. Debe ser (4 enteros + punto + 2 decimales: 0000.00)."
MSG_CREDIT = "Formato inválido. Debe ser signo + 15 enteros + punto + 4 decimales."
MSG_CREDIT_WIDTH = "El formato de Cupo de crédito procesado no cumple los 21 caracteres requeridos."
MSG_EMPTY_WARNING = "Campo obligatorio vacío: "

# The layout-driven export: record type and subtype, and the fields with a format of their own.
RECORD_NUMBER_FIELD = "F_NUMERO_REG"
CONSTANT_FIELDS = {"F_TIPO_REG": "201", "F_SUBTIPO_REG": "0"}
SIGNED_FIELDS = ("F201_CUPO_CREDITO",)
PERCENT_FIELDS = ("F201_PORC_EXCESO_VENTA", "F201_PORC_MIN_MARGEN", "F201_PORC_MAX_MARGEN", "F201_PORC_TOLERANCIA")
DATE_FIELDS = ("F201_FECHA_INGRESO", "F201_FECHA_CUPO")
CREDIT_WIDTH, CREDIT_DECIMALS, PERCENT_DECIMALS, SHORT_NUMBER = 21, 4, 2, 4
