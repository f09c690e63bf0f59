"""Rule tables and fixed values.

Everything in the FIXED VALUES block must stay equal to the business rules of
the ticket process this package re-implements (labels, thresholds, word lists,
date formats).  They are data, not logic: operators read them from here.
Role maps further down are our own choice for the driver test tables.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the original process exactly)
# ---------------------------------------------------------------------------

# Tokens meaning "no value" in date columns (checked before trimming).
NULL_TOKENS = ["", "-", "no se registro ?"]

# Day-first date formats, tried in this order; the first one that parses wins.
# Python strptime spelling, then the Spark pattern used for the same format.
DATETIME_FORMATS = [
    ("%d/%m/%y %I:%M %p", "d/M/yy h:m a"),
    ("%Y-%m-%d %H:%M:%S", "yyyy-M-d H:m:s"),
    ("%d/%m/%y %H:%M:%S", "d/M/yy H:m:s"),
    ("%d/%m/%y", "d/M/yy"),
    ("%Y-%m-%d %H:%M", "yyyy-M-d H:m"),
    ("%d/%m/%Y %I:%M %p", "d/M/yyyy h:m a"),
    ("%d/%m/%Y %H:%M", "d/M/yyyy H:m"),
]

# Feed contracts: columns a work-order file must have (and is cut to), the key
# columns of the other feeds, and their renames.
WORK_ORDER_COLUMNS = [
    "Técnico", "ID Recurso", "Nro TOA", "Subtipo de Actividad", "Número de Petición", "Fecha de Cita", "SLA Inicio", "SLA Fin",
    "Localidad", "Dirección", "Direccion Polar X", "Direccion Polar Y", "Nombre Cliente", "Hora de asignación de actividad",
    "Fecha de Registro de actividad TOA", "Notas", "Código de Cliente", "Fecha Hora de Cancelación", "Empresa", "Bucket Inicial",
    "Usuario - Iniciado", "Nombre Distrito", "Sistema Origen", "ID del Ticket", "Quiebres", "Fecha de Inicio PINT",
    "Inicio PR1", "Fin PR1", "Fin PR2", "Inicio PR2", "Fin PR3", "Inicio PR3", "Fin PR4", "Inicio PR4",
    "Motivo PR1", "Motivo PR2", "Motivo PR3", "Motivo PR4", "Nombre Local", "Tipo de local", "Zona geográfica", "Zona", "Estado TOA",
]
PAUSE_REQUIRED = ["Order ID"]
TASK_REQUIRED = ["Task Id"]
TASK_RENAMES = {"Nro TOA": "Number_OS_SIOM"}
OLD_STATUS_MARKER = "(antiguo)"
SITE_KEY = "Codigo Unico"
SWAP_COLUMNS = ["Codigo Estacion", "Fecha Fin Swap", "Alarmas Activas Nodo"]
SWAP_RENAMES = {"Codigo Estacion": "Codigo Unico"}
TSS_RENAMES = {"Customer Site ID": "Codigo Unico"}
TSS_SUFFIX = "_Swap"

# The incident feed: its headings, the names they get, its dates, the groups kept.
INCIDENT_HEADINGS = [
    "ID de la incidencia*+", "Estado*", "Fecha de envío", "Fecha de cierre", "Fecha inicio incidente", "Fecha fin incidente",
    "Tipo de Afectación", "Resumen*", "Notas", "Grupo asignado*+",
]
INCIDENT_COLUMNS = [
    "ID_incidencia", "Estado", "Fecha_envio", "Fecha_cierre", "Fecha_inicio_incidente", "Fecha_fin_incidente", "Tipo_afectacion",
    "Resumen", "Notas", "Grupo_asignado",
]
INCIDENT_DATES = ["Fecha_envio", "Fecha_cierre", "Fecha_fin_incidente", "Fecha_inicio_incidente"]
VENDOR_GROUPS = ["FLM COMFICA", "FLM HUAWEI"]

# Output format of timestamps stored as text.
TS_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Task status priority for picking the best three tasks of a work order.
TASK_STATUS_PRIORITY = {"closed": 1, "completed": 2, "canceled": 4}
TASK_STATUS_PRIORITY_DEFAULT = 3
TASK_SLOTS = 3

# Cancel reasons that exclude a task (a null reason is kept).
EXCLUDED_CANCEL_REASONS = ["Duplicado", "Other", "Tarea de prueba", "Monitoreo"]

# Vendors, in precedence order, searched in the bucket text.
VENDORS = ["comfica", "huawei"]
VENDORS_UPPER = ["HUAWEI", "COMFICA"]

# Work-order status x first-task status -> label.
STATUS_CONFLICT_RULES = [
    ("Cancelado", ["accepted", "closed", "completed", "dispatched", "inprocess", "unscheduled"], "cruce incorrecto"),
    ("Completado", ["accepted", "canceled", "dispatched", "inprocess", "unscheduled"], "cruce incorrecto"),
    ("Pendiente", ["closed", "completed", "canceled"], "falta de revisión"),
    ("Pre cierre", ["closed", "completed", "canceled"], "falta de revisión"),
    ("Suspendido", ["closed", "completed", "canceled"], "falta de revisión"),
]

# Repeat detection window (days, inclusive) and the supply look-ahead (hours).
REPEAT_DAYS = 7
SUPPLY_WINDOW_HOURS = 48
CANDIDATE_WINDOW_HOURS = 6
CANDIDATE_SLOTS = 2

# SLA: containment target hours by site tier; persistence before the incident
# ticket and the tolerance band, both in hours.
TIER_TARGET_HOURS = {"Black": 2, "Oro": 8, "Plata": 10, "Clasico": 10}
PERSISTENCE_HOURS = 0.5
TOLERANCE_HOURS = 0.25
CANCEL_OUTLIER_HOURS = 96
CANCEL_BINS = [
    (0, 6, "00-06"), (6, 12, "06-12"), (12, 18, "12-18"), (18, 24, "18-24"),
    (24, 36, "24-36"), (36, 48, "36-48"), (48, 60, "48-60"), (60, 72, "60-72"),
]
CANCEL_BIN_REST = "72+"

# Age bands (hours) of open work orders for the published report.
AGE_GREEN_MIN = 0.000001
AGE_GREEN_MAX = 3
AGE_YELLOW_MAX = 6
ATTENTION_DAYS_BELOW = 8

# Text labels.
L_REPEAT = "Reiterada"
L_TEST = "TEST"
L_CONFIRMED = "SI"
L_SOFT_LAUNCH = "MB"
L_PROACTIVE = "Proactivo"
L_FLM = "FLM"
L_TDP = "TDP"
L_IN_RANGE = "en_rango"
L_NO_ORDER_IN_NOTES = "sin TOA en notas"
L_CORPORATE = "Caso Empresa"
L_HAS_ORDER = "Si tiene TOA"
L_ORDER_UNKNOWN = "TOA no identificado"
L_OTHER_OPERATOR_SITE = "Sitio corresponde a Telefonica"
L_ALARM_UNKNOWN = "alarma no identificada"
L_TYPE_UNKNOWN = "tipo no identificado"
L_AC_TYPE = "TOTAL"
L_SLA_NO_SITE = "Sin información Site ID"
L_SLA_NO_ORDER = "Sin información TOA"
L_SLA_EARLY = "< del tiempo esperado"
L_SLA_LATE = "> del tiempo esperado"
L_SLA_OK = "rango correcto"
L_CANCEL_NONE = "Ticket no cancelado"
L_CANCEL_OUTLIER = "Cancelamiento Outlier"
L_CANCEL_EARLY = "Cancelado antes de rango contención"
L_CANCEL_LATE = "Cancelado fuera de rango contención"
L_CANCEL_OK = "Cancelado en rango contención"
L_SWAP_NO_SITE = "Sin info de Sitio"
L_SWAP_AFTER = "Incidente post SWAP"
L_SWAP_UNRELATED = "Incidente no relacionado a SWAP"

# Test-ticket markers in notes and the note used for tickets from the error list.
TEST_MARKERS = ["test", "ticket de prueba"]
ERROR_LIST_NOTE = "Error al pasar de Autin"
PROACTIVE_WORD = "proactivo"
SUPPLY_CATEGORY_WORD = "abastecimiento"
CANCELED_STATUS = "canceled"
ORDER_DONE_STATUSES = ["Completado", "Cancelado"]
ORDER_CANCELED = "Cancelado"
AC_SPECIALITY = "ENERGIA"
AC_WORDS = ["failure", "fallo", "falla"]

# Regular expressions (Java syntax).  Detector patterns carry (?U) so that \w
# and \b treat accented Spanish letters as word characters.
RX_ALARM_SEGMENT = r"(?<=\|)([^|]+)(?=\||$)"
RX_ALARM_IN_NOTES = r"Alarma: ([^\n]*?)\n"
RX_SITE_CODE = r"((?!NC|CD|CR)[A-Z]{2}\d{5})"
RX_CORPORATE = r"CD\d{6}|CR\d{5}|Circuito:|CIRCUITO:"
RX_ORDER_IN_NOTES = r"(?i)(?:TOA:|SIOM:)([^\n]*?)(?:\n|$)"
ORDER_DIGITS = (8, 8)  # least and greatest length of an order number in the reference's feed
RX_INCIDENT_ID = r"^INC\d{7}"
RX_PETITION_SUFFIX = r"-\d{2}$"

RX_GE_NEGATION = (r"(?U)\b(?:no\s+(?:tiene|hay|existe)|sin|ningún(?:a)?|no\s*cuenta\s+con)"
                  r"\s+(?:grupo\s+electr[oó]geno|grupo|ge|g\.e\.?)\b")
RX_GE_VERB = r"(?U)\b(?:instal|encend|cambi|coloc|dej(?:a|o)|oper|funcion)\w*\b"
RX_GE_NOUN = r"(?U)\bgrupo\s+electr[oó]geno\b|\b(?:ge|g\.e\.?)\b|\bgrupo\b"
RX_BATTERY_VERB = r"(?U)\b(?:coloc|cambi|instal|mid|recarg|carg|respald|revis|verific)\w*\b"
RX_BATTERY_NOUN = r"(?U)\b(?:b{1,2}[aá]ter[ií]a(?:s)?)\b"
RX_ITM_VERB = r"(?U)\b(?:cambi|ajust|reajust|reposicion)\w*\b"
RX_ITM_NOUN = r"(?U)\bitm\b"
RX_BREAKER_VERB = r"(?U)\b(?:sub[ií]o|levant(?:o|a)|ajust(?:o|ó)|activ|arregl(?:o|ó))\w*\b"
RX_BREAKER_NOUN = (r"(?U)\b(?:breaker|breacker|breackers|braker|bracker|brackers|breker|breckers"
                   r"|braker|brackers|brackers)\b")

# (negation, verb, noun) per detector; a detector says SI when the text is not
# negated, has a verb and has a noun.
DETECTORS = {
    "ge": (RX_GE_NEGATION, RX_GE_VERB, RX_GE_NOUN),
    "baterias": (None, RX_BATTERY_VERB, RX_BATTERY_NOUN),
    "itm": (None, RX_ITM_VERB, RX_ITM_NOUN),
    "breakers": (None, RX_BREAKER_VERB, RX_BREAKER_NOUN),
}

# Literal that every match of a detector's noun pattern contains (derived from
# the patterns above); checked with a plain substring test before any regex.
DETECTOR_NOUN_LITERAL = {"baterias": "ter", "itm": "itm", "breakers": "br"}

# Column rename map of the consolidated report (source name -> published name).
REPORT_COLUMNS = {
    "Nro_TOA": "ID_TOA",
    "Fecha_de_Registro_de_actividad_TOA": "Creacion_TOA",
    "Fecha_Hora_de_Cancelación": "Cierre_TOA",
    "Subtipo_de_Actividad": "Tipo_Actividad",
    "Número_de_Petición": "Numero_Peticion",
    "ID_del_Ticket": "ID_Ticket",
    "SLA_Inicio": "SLA_Inicio",
    "SLA_Fin": "SLA_Fin",
    "Direccion_Polar_X": "Coordenada_X",
    "Direccion_Polar_Y": "Coordenada_Y",
    "Notas": "Notas",
    "Codigo_Unico": "Site_ID",
    "Nombre_Local_sitios": "Nombre_Local",
    "Empresa": "Empresa",
    "Bucket_Inicial": "Bucket",
    "Inicio_PR1": "Inicio_PR1",
    "Fin_PR1": "Fin_PR1",
    "Motivo_PR1": "Motivo_PR1",
    "Inicio_PR2": "Inicio_PR2",
    "Fin_PR2": "Fin_PR2",
    "Motivo_PR2": "Motivo_PR2",
    "Inicio_PR3": "Inicio_PR3",
    "Fin_PR3": "Fin_PR3",
    "Motivo_PR3": "Motivo_PR3",
    "Inicio_PR4": "Inicio_PR4",
    "Fin_PR4": "Fin_PR4",
    "Motivo_PR4": "Motivo_PR4",
    "Departamento": "Departamento",
    "Provincia": "Provincia",
    "Distrito": "Distrito",
    "Tipo_Local": "Tipo_Local",
    "Atencion": "Tipo_Atencion",
    "Zona_sitios": "Zona",
    "Tipo_Zona_FLM": "Tipo_Zona",
    "Tipo_Estacion": "Tipo_Estacion",
    "SLA": "SLA",
    "ubigeotoa": "Ubigeo_TOA",
    "Estado_TOA": "Estado_TOA",
    "Proactivo": "Proactivo",
    "Marcha_Blanca": "Marcha_Blanca",
    "Responsable": "Responsable",
    "TEST": "Test",
    "Fecha_Fin_Swap": "Fecha_Fin_Swap",
    "Alarmas_Activas_Nodo": "Alarmas_Activas",
    "SWAP_dias": "Dias_Swap",
    "Fecha_TSS": "Fecha_TSS",
    "TSS_dias": "Dias_TSS",
    "Task_Id_1": "Autin_ID_1",
    "Task_Status_1": "Estado_1",
    "Cancel_Reason_1": "Motivo_Cancel_1",
    "Hora_PR_1": "Hora_PR_1",
    "Motivo_PR_1": "Motivo_PR_1",
    "Estado_PR_1": "Estado_PR_1",
    "Task_Id_2": "Autin_ID_2",
    "Task_Status_2": "Estado_2",
    "Cancel_Reason_2": "Motivo_Cancel_2",
    "Hora_PR_2": "Hora_PR_2",
    "Motivo_PR_2": "Motivo_PR_2",
    "Estado_PR_2": "Estado_PR_2",
    "Task_Id_3": "Autin_ID_3",
    "Task_Status_3": "Estado_3",
    "Cancel_Reason_3": "Motivo_Cancel_3",
    "Hora_PR_3": "Hora_PR_3",
    "Motivo_PR_3": "Motivo_PR_3",
    "Estado_PR_3": "Estado_PR_3",
    "Tiempo_TOA_Autin": "Tiempo_TOA_Autin",
    "Task_Id_Abastecimiento_1": "Tarea_Abastecimiento",
    "Task_Status_Abastecimiento_1": "Estado_Abastecimiento",
    "Createtime_Abastecimiento_1": "Hora_Creacion_Abastecimiento",
    "Abastecimiento_dias_1": "Dias_Abastecimiento",
    "Reject_Counter_1": "Rechazos",
    "Com_Level_1_Aff_Equip_1": "Equipo_Afectado",
    "Duration_hours_1": "Duracion_Horas",
    "Reiteradas": "Reiteradas",
    "TOA_Reiterado": "TOA_Reiterdo",
}

# Columns left out of the per-vendor extracts.
VENDOR_EXTRACT_DROP = [
    "Tarea_Abastecimiento", "Estado_Abastecimiento", "Hora_Creacion_Abastecimiento",
    "Dias_Abastecimiento", "Rechazos", "Equipo_Afectado", "Duracion_Horas",
    "Reiteradas", "TOA_Reiterdo", "EN_TDE", "en_rango", "Proactivo", "Marcha_Blanca",
    "Responsable", "Test", "Fecha_Fin_Swap", "Alarmas_Activas", "Dias_Swap",
    "Fecha_TSS", "Dias_TSS", "Etiqueta",
]

# ---------------------------------------------------------------------------
# Role maps for the driver tables (our choice, not part of the original rules)
# ---------------------------------------------------------------------------

# orders.o_orderstatus -> work-order status
ORDER_STATUS_ROLE = {"F": "Completado", "O": "Pendiente", "P": "Cancelado"}
# lineitem.l_returnflag -> task status
TASK_STATUS_ROLE = {"R": "closed", "A": "completed", "N": "canceled"}
# customer.c_mktsegment -> site tier
SEGMENT_TIER_ROLE = {"AUTOMOBILE": "Black", "BUILDING": "Oro", "FURNITURE": "Plata", "HOUSEHOLD": "Clasico"}
# customer.c_mktsegment -> site provider (null for the rest)
SEGMENT_PROVIDER_ROLE = {"AUTOMOBILE": "HUAWEI", "BUILDING": "COMFICA", "FURNITURE": "HUAWEI"}

# Date forms of the incident feed (our choice: day-first, and ISO as it stands).
INCIDENT_DATE_FORMATS = [
    ("%d/%m/%Y %H:%M:%S", "d/M/yyyy H:m:s"), ("%d/%m/%Y %H:%M", "d/M/yyyy H:m"), ("%d/%m/%Y", "d/M/yyyy"),
    ("%Y-%m-%d %H:%M:%S", "yyyy-M-d H:m:s"), ("%Y-%m-%d %H:%M", "yyyy-M-d H:m"), ("%Y-%m-%d", "yyyy-M-d"),
]

# Contract types of the published report's columns that aren't text.
REPORT_CONTRACT = {
    **dict.fromkeys(["Rechazos", "Dias_Swap", "Dias_TSS", "Dias_Abastecimiento", "Alarmas_Activas"], "INTEGER"),
    **dict.fromkeys(["Tiempo_TOA_Autin", "Duracion_Horas"], "REAL"),
    **dict.fromkeys(["Creacion_TOA", "Cierre_TOA", "SLA_Inicio", "SLA_Fin", "Fecha_Fin_Swap", "Fecha_TSS", "Hora_Creacion_Abastecimiento"], "DATETIME"),
    **{f"{n}_PR{i}": "DATETIME" for n in ("Inicio", "Fin") for i in (1, 2, 3, 4)},
    **{f"Hora_PR_{i}": "DATETIME" for i in (1, 2, 3)},
}
