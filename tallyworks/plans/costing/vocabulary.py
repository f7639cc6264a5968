"""Fixed values of the costing data: process, class and document names, codes, concept texts."""

# Processes.
EXTRUSION = "EXTRUSION LAMINA"
THERMOFORMING = "TERMOFORMADO"
DIE_CUTTING = "TROQUELADO"
DECONTAMINATION = "DESCONTAMINACION"
GRINDING = "MOLIDO"
SHAPED = (THERMOFORMING, DIE_CUTTING)
RECYCLED = (DECONTAMINATION, GRINDING)

# Work centres, methods and operation classes.
SUPPLEMENTARY = "ACTIVIDADES SUPLEMENTARIAS"
STANDARD_METHOD = "Estandar"
SET_UP = "ALISTAMIENTO"
SHORT_SET_UP = "ALISTAMIENTO CORTA DURACION"
INTER_OPERATION = "ALISTAMIENTO INTEROPERACIONAL"
SET_UP_PROCESSES = (SHORT_SET_UP, INTER_OPERATION, SET_UP)
EXTERNAL_OPERATION = "OPERACION EXTERNA"
OPERATION = "OPERACION"
MOUNTING_PREFIX = "MONTAJE Y DE"
TUNING_PREFIX = "PUESTA A PUN"

# Movements.
CLASS_EXTRUSION = "ENTREGA REAL EXTRUSION"
CLASS_SHAPED = "ENTREGA REAL KG TERMO TROQ"
CLASS_NONCONFORMING = "NO CONFORME"
CLASS_SCRAP = "RETAL"
CLASS_CAKE = "TORTA"
DELIVERIES = "ENTREGAS"
KILOGRAMS = "KGS"

# Cost.
NATURE_STANDARD = "ESTANDAR"
NATURE_REAL = "REAL"
OVERTIME = "COSTO MOD HORAS EXTRA"
OVERTIME_LABEL = "COSTO MOD HORAS EXTRA REAL"
CENTRE_NEVER_TARGET = "301021"
INCLUDED_CENTRE = "INCLUIDA"
EXCLUDED_CENTRE = "EXCLUIDA"

# Downtime rules and faults.
RULE_INCLUDED = "INCLUIDOS"
RULE_EXCLUDED = "EXCLUIDOS"
RULE_ALL = "TODOS"
FAULT_NOT_COUNTED = "MTS LINEALES"

# Concepts: (group, text).
CONCEPT_STANDARD = ("ESTANDAR", "000-HORAS ESTANDAR")
CONCEPT_ADJUSTMENT = ("AJUSTES", "997-AJUSTE REGISTRO DE PAROS SUP A LA DIFERENCIA EST VS REAL")
CONCEPT_EFFICIENCY = ("INCREMENTO DE EFICIENCIA", "998-INCREMENTO DE EFICIENCIA O ESTANDAR INCORRECTO")
CONCEPT_UNJUSTIFIED = ("INEFICIENCIA NO JUSTIFICADA", "999-INEFICIENCIA NO JUSTIFICADA")
