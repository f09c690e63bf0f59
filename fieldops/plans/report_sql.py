"""DuckDB oracle SQL for the report queries (independent formulation of the
role adapters in ``roles`` and the compositions in ``reports``)."""

from __future__ import annotations

from fieldops import config

OFF = 10_000_000


def _phrases() -> str:
    from fieldops.plans.roles import FIELD_PHRASES
    return "[" + ", ".join("'" + p.replace("'", "''") + "'" for p in FIELD_PHRASES) + "]"


def site_code(k: str) -> str:
    return (f"(CASE WHEN {k} >= 2600000 THEN 'SZ' || CAST({k} AS VARCHAR) ELSE 'S' || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ', CAST(floor({k} / 100000) % 26 + 1 AS INTEGER), 1)"
            f" || lpad(CAST({k} % 100000 AS VARCHAR), 5, '0') END)")


def case_map(col: str, mapping: dict[str, str]) -> str:
    return "CASE " + col + " " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


def conflict(o: str, t: str) -> str:
    parts = []
    for ostat, tstats, label in config.STATUS_CONFLICT_RULES:
        lst = ", ".join(f"'{x}'" for x in tstats)
        parts.append(f"WHEN {o} = '{ostat}' AND {t} IN ({lst}) THEN '{label}'")
    return "CASE " + " ".join(parts) + " ELSE '' END"


def days_pos(a: str, b: str) -> str:
    d = f"floor(date_diff('microsecond', {a}, {b}) / 86400000000.0::DOUBLE)"
    return f"CASE WHEN {d} > 0 THEN CAST({d} AS BIGINT) END"


PIVOT_COLS = ["Task_Id", "Task_Status", "Cancel_Reason", "Hora_PR", "Motivo_PR", "Estado_PR", "Createtime",
              "Task_Id_Abastecimiento", "Task_Status_Abastecimiento", "Createtime_Abastecimiento", "Abastecimiento_dias",
              "Reject_Counter", "Com_Level_1_Aff_Equip", "Duration_hours"]

CREATED = "Fecha_de_Registro_de_actividad_TOA"


def _pivot() -> str:
    items = []
    for i in (1, 2, 3):
        for c in PIVOT_COLS:
            items.append(f"max(CASE WHEN Orden = {i} THEN {c} END) AS {c}_{i}")
    return ",\n  ".join(items)


def _order_pauses() -> str:
    items = []
    for i in (1, 2, 3, 4):
        items += [f"CASE WHEN o_orderkey % 5 >= {i} THEN created + INTERVAL {60 * i} MINUTE END AS Inicio_PR{i}",
                  f"CASE WHEN o_orderkey % 5 >= {i} THEN created + INTERVAL {60 * i + 30} MINUTE END AS Fin_PR{i}",
                  f"CASE WHEN o_orderkey % 5 >= {i} THEN 'Motivo ' || CAST((o_orderkey + {i}) % 3 AS VARCHAR) END AS Motivo_PR{i}"]
    return ",\n    ".join(items)


def _report_select() -> str:
    return ",\n  ".join(f'"{src}" AS "{dst}"' for src, dst in config.REPORT_COLUMNS.items())


def consolidated_ctes() -> str:
    PHRASES = _phrases()
    excl = ", ".join(f"'{x}'" for x in config.EXCLUDED_CANCEL_REASONS)
    week = config.REPEAT_DAYS * 86_400_000_000
    return f"""
wo AS (
  SELECT CAST(o_orderkey + {OFF} AS VARCHAR) AS Nro_TOA,
    o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS BIGINT)) AS created,
    o_orderkey, o_orderstatus, o_orderpriority, o_totalprice, o_custkey
  FROM orders),
wo2 AS (
  SELECT Nro_TOA, created AS {CREATED},
    CASE WHEN o_orderstatus = 'P' THEN created + to_hours(CAST(o_orderkey % 50 + 30 AS BIGINT)) END
      AS "Fecha_Hora_de_Cancelación",
    o_orderpriority AS Subtipo_de_Actividad,
    'PET' || CAST(o_orderkey AS VARCHAR) || '-01' AS "Número_de_Petición",
    CASE WHEN o_orderstatus = 'F' THEN 'INC' || lpad(CAST(o_orderkey AS VARCHAR), CAST(greatest(7, length(CAST(o_orderkey AS VARCHAR))) AS INTEGER), '0')
         ELSE 'TT' || CAST(o_orderkey AS VARCHAR) END AS ID_del_Ticket,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'Mantenimiento proactivo'
         WHEN o_totalprice < 2000 THEN 'Ticket de prueba' END AS Notas,
    {site_code('o_custkey')} AS Codigo_Unico,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Bucket COMFICA Lima' WHEN '2-HIGH' THEN 'bucket huawei norte'
         WHEN '3-MEDIUM' THEN 'FLM comfica sur' ELSE 'TDP central' END AS Bucket_Inicial,
    {case_map('o_orderstatus', config.ORDER_STATUS_ROLE)} AS Estado_TOA,
    created AS SLA_Inicio,
    CASE WHEN o_orderstatus <> 'P' THEN created + to_hours(CAST(o_orderkey % 48 AS BIGINT)) END AS SLA_Fin,
    '-' || CAST(o_orderkey % 12 + 70 AS VARCHAR) || '.' || lpad(CAST(o_orderkey % 10000 AS VARCHAR), 4, '0')
      AS Direccion_Polar_X,
    '-' || CAST(o_orderkey % 18 AS VARCHAR) || '.' || lpad(CAST(o_orderkey % 7919 AS VARCHAR), 4, '0')
      AS Direccion_Polar_Y,
    CAST(o_orderkey % 4 AS BIGINT) AS Alarmas_Activas_Nodo,
    {_order_pauses()}
  FROM wo),
sw AS (SELECT user_id, ts AS Fecha_Fin_Swap FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
         FROM events WHERE event_type = 'purchase') q WHERE rn = 1),
tss AS (SELECT user_id, ts AS Fecha_TSS FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
         FROM events WHERE event_type = 'signup') q WHERE rn = 1),
s AS (SELECT {site_code('c.c_custkey')} AS Codigo_Unico, r.r_name AS Departamento, n.n_name AS Provincia,
         {case_map('c.c_mktsegment', config.SEGMENT_TIER_ROLE)} AS SLA, sw.Fecha_Fin_Swap, tss.Fecha_TSS,
         c.c_name AS Nombre_Local_sitios, 'Distrito ' || CAST(c.c_custkey % 43 AS VARCHAR) AS Distrito,
         CASE WHEN c.c_acctbal < 0 THEN 'Indoor' ELSE 'Outdoor' END AS Tipo_Local,
         CASE c.c_custkey % 2 WHEN 0 THEN 'Presencial' ELSE 'Remota' END AS Atencion,
         'Zona ' || r.r_name AS Zona_sitios,
         CASE c.c_custkey % 3 WHEN 0 THEN 'Urbana' WHEN 1 THEN 'Rural' END AS Tipo_Zona_FLM,
         lower(c.c_mktsegment) AS Tipo_Estacion,
         lpad(CAST(c.c_custkey AS VARCHAR), CAST(greatest(6, length(CAST(c.c_custkey AS VARCHAR))) AS INTEGER), '0') AS ubigeotoa
      FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
      LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
      LEFT JOIN sw ON sw.user_id = c.c_custkey LEFT JOIN tss ON tss.user_id = c.c_custkey),
sus AS (SELECT Nro_TOA, Notas, CAST(NULL AS VARCHAR) AS Confirmado, 1 AS src FROM wo2
        WHERE contains(lower(Notas), 'test') OR contains(lower(Notas), 'ticket de prueba')),
sh AS (SELECT CAST(doc_id + {OFF} AS VARCHAR), NULL, CASE WHEN quality = 1 THEN 'SI' ELSE 'NO' END, 2 FROM labels),
er AS (SELECT CAST(doc_id + {OFF} AS VARCHAR), 'Error al pasar de Autin', 'SI', 3 FROM labels WHERE toxic = 1),
tq AS (SELECT Nro_TOA, Confirmado FROM (
         SELECT *, row_number() OVER (PARTITION BY Nro_TOA ORDER BY src DESC) AS rn
         FROM (SELECT * FROM sus UNION ALL SELECT * FROM sh UNION ALL SELECT * FROM er) u) q WHERE rn = 1),
conf AS (SELECT Nro_TOA FROM tq WHERE Confirmado = 'SI'),
li AS (SELECT *, l_shipdate + to_minutes(CAST(l_partkey % 1440 AS BIGINT)) AS ct,
         (CASE WHEN l_linenumber % 3 = 0 THEN 'PLM' ELSE 'CM' END) || '-' || CAST(l_orderkey AS VARCHAR) || '-'
           || CAST(l_linenumber AS VARCHAR) AS Task_Id
       FROM lineitem),
t0 AS (SELECT Task_Id,
    CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN 'Abastecimiento'
         WHEN l_linenumber % 3 = 0 AND l_discount >= 0.05 THEN 'PROACTIVO' ELSE 'Correctivo' END AS Task_Category,
    ct AS Createtime,
    CASE WHEN l_discount = 0.0 THEN 'Duplicado' WHEN l_discount = 0.01 THEN 'Acceso denegado' END AS Cancel_Reason,
    {case_map('l_returnflag', config.TASK_STATUS_ROLE)} AS Task_Status,
    {site_code('l_suppkey')} AS Site_Id,
    'EQ' || CAST(l_partkey % 20 AS VARCHAR) AS Com_Level_1_Aff_Equip,
    CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_orderkey + {OFF} AS VARCHAR) || '.0'
         ELSE CAST(l_orderkey + {OFF} AS VARCHAR) END AS Number_OS_SIOM,
    CAST(trunc(l_quantity) AS INTEGER) % 3 AS Reject_Counter,
    CASE WHEN l_returnflag IN ('R', 'A') THEN ct + to_hours(CAST(trunc(l_quantity) AS BIGINT)) END AS Complete_Time,
    CASE WHEN l_returnflag = 'N' THEN ct + to_hours(CAST(l_partkey % 100 AS BIGINT)) END AS Cancel_Time,
    CASE WHEN l_tax > 0.02 THEN ct + INTERVAL 90 MINUTE END AS Arrive_Time,
    CASE WHEN l_linestatus = 'F' THEN 'ENERGIA' ELSE 'TRANSMISION' END AS Com_Fault_Speciality,
    CASE WHEN l_quantity > 25 THEN 'Falla AC' ELSE 'DC' END AS Com_Fault_Sub_Speciality,
    CASE WHEN l_partkey % 5 > 0 THEN 'Causa ' || CAST(l_partkey % 5 AS VARCHAR) END AS Com_Fault_Cause,
    {PHRASES}[l_partkey % 8 + 1] AS Leave_Observations,
    {PHRASES}[l_suppkey % 8 + 1] AS "Detalle_de_actuación_realizada",
    row_number() OVER (PARTITION BY Task_Id ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                       l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn
  FROM li),
t AS (SELECT * EXCLUDE (rn) FROM t0 WHERE rn = 1),
pz AS (SELECT Task_Id AS Order_ID, ct + INTERVAL 1 DAY AS Operation_Time,
         CASE WHEN l_tax >= 0.06 THEN 'Pause' ELSE 'Resume' END AS Pause_Time, 'Espera de acceso' AS Reason
       FROM li WHERE l_tax >= 0.04
       UNION ALL
       SELECT Task_Id, ct + INTERVAL 2 DAY, 'Pause - cliente', 'Cliente ausente' FROM li WHERE l_tax >= 0.07),
p AS (SELECT Order_ID, Operation_Time, Pause_Time, Reason FROM (
        SELECT *, row_number() OVER (PARTITION BY Order_ID, Operation_Time ORDER BY Pause_Time DESC, Reason DESC) AS rn
        FROM pz) q WHERE rn = 1),
sup AS (SELECT Site_Id, Task_Id AS sid, Task_Status AS sst, Createtime AS sct FROM t
        WHERE contains(lower(Task_Category), 'abastecimiento') AND NOT coalesce(Task_Status = 'canceled', false)),
f AS (SELECT * FROM t WHERE NOT coalesce(Cancel_Reason IN ({excl}), false)
        AND (contains(lower(Task_Id), 'cm')
             OR (contains(lower(Task_Id), 'plm') AND coalesce(Task_Category = 'PROACTIVO', false)))),
a AS (SELECT f.Task_Id, arg_max(struct_pack(id := s2.sid, st := s2.sst, c := s2.sct), struct_pack(c := s2.sct, i := s2.sid)) AS m
      FROM f JOIN sup s2 ON f.Site_Id = s2.Site_Id AND s2.sct < f.Createtime GROUP BY f.Task_Id),
fa AS (SELECT f.*, a.m.id AS Task_Id_Abastecimiento, a.m.st AS Task_Status_Abastecimiento,
         a.m.c AS Createtime_Abastecimiento FROM f LEFT JOIN a ON f.Task_Id = a.Task_Id),
fp AS (SELECT fa.*,
         CAST(floor(date_diff('microsecond', Createtime_Abastecimiento, Createtime) / 86400000000.0::DOUBLE) AS BIGINT)
           AS Abastecimiento_dias,
         p.Operation_Time AS Hora_PR, p.Pause_Time AS Estado_PR, p.Reason AS Motivo_PR
       FROM fa LEFT JOIN p ON fa.Task_Id = p.Order_ID),
fc AS (SELECT * REPLACE (
         CASE WHEN Number_OS_SIOM IS NULL OR Number_OS_SIOM = '' THEN NULL
              WHEN regexp_matches(Number_OS_SIOM, '^\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*$')
                THEN CAST(CAST(TRY_CAST(Number_OS_SIOM AS DOUBLE) AS BIGINT) AS VARCHAR)
              ELSE Number_OS_SIOM END AS Number_OS_SIOM) FROM fp),
fr AS (SELECT *, row_number() OVER (PARTITION BY Number_OS_SIOM
         ORDER BY CASE Task_Status WHEN 'closed' THEN 1 WHEN 'completed' THEN 2 WHEN 'canceled' THEN 4 ELSE 3 END,
                  Createtime NULLS LAST, Task_Id, Hora_PR NULLS LAST, Estado_PR NULLS LAST, Motivo_PR NULLS LAST) AS Orden
       FROM fc WHERE coalesce(length(Number_OS_SIOM) BETWEEN 8 AND 19, false)),
ft AS (SELECT *, CASE WHEN Complete_Time IS NOT NULL
                      THEN date_diff('microsecond', Createtime, Complete_Time) / 3600000000.0::DOUBLE END AS Duration_hours
       FROM fr WHERE Orden <= 3),
w AS (SELECT Number_OS_SIOM,
  {_pivot()}
  FROM ft GROUP BY Number_OS_SIOM),
x1 AS (SELECT o.*, s.Departamento, s.Provincia, s.SLA, s.Fecha_Fin_Swap, s.Fecha_TSS,
    s.Nombre_Local_sitios, s.Distrito, s.Tipo_Local, s.Atencion, s.Zona_sitios, s.Tipo_Zona_FLM, s.Tipo_Estacion, s.ubigeotoa,
    CASE WHEN o.Nro_TOA IN (SELECT Nro_TOA FROM conf) THEN 'TEST' ELSE '' END AS TEST,
    CASE WHEN contains(lower(Bucket_Inicial), 'comfica') THEN 'comfica'
         WHEN contains(lower(Bucket_Inicial), 'huawei') THEN 'huawei' ELSE '' END AS Empresa,
    CASE WHEN coalesce(s.Departamento = 'Puno', false) OR coalesce(s.Provincia = 'Cañete', false) THEN 'MB' ELSE ''
      END AS Marcha_Blanca,
    CASE WHEN contains(lower(coalesce(o.Notas, '')), 'proactivo') THEN 'Proactivo' ELSE '' END AS Proactivo,
    CASE WHEN contains(Bucket_Inicial, 'comfica') OR contains(Bucket_Inicial, 'huawei') THEN 'FLM' ELSE 'TDP' END
      AS Responsable,
    {days_pos('s.Fecha_Fin_Swap', 'o.' + CREATED)} AS SWAP_dias,
    {days_pos('s.Fecha_TSS', 'o.' + CREATED)} AS TSS_dias
  FROM wo2 o LEFT JOIN s ON o.Codigo_Unico = s.Codigo_Unico),
x3 AS (SELECT x1.* REPLACE (coalesce(x1.Notas, '') AS Notas), w.* EXCLUDE (Number_OS_SIOM),
         date_diff('microsecond', x1.{CREATED}, w.Createtime_1) / 60000000.0::DOUBLE AS Tiempo_TOA_Autin
       FROM x1 LEFT JOIN w ON x1.Nro_TOA = w.Number_OS_SIOM),
rv AS (SELECT Nro_TOA AS _rid, lag({CREATED}) OVER win AS _pts, lag(Nro_TOA) OVER win AS _pid FROM x3
       WHERE Codigo_Unico IS NOT NULL AND Codigo_Unico <> '' AND Com_Level_1_Aff_Equip_1 IS NOT NULL
         AND Com_Level_1_Aff_Equip_1 <> '' AND {CREATED} IS NOT NULL
       WINDOW win AS (PARTITION BY Codigo_Unico, Com_Level_1_Aff_Equip_1 ORDER BY {CREATED}, Nro_TOA)),
x4 AS (SELECT x3.*,
    CASE WHEN _pid IS NOT NULL AND date_diff('microsecond', _pts, x3.{CREATED}) <= {week} THEN 'Reiterada' ELSE '' END
      AS Reiteradas,
    CASE WHEN _pid IS NOT NULL AND date_diff('microsecond', _pts, x3.{CREATED}) <= {week} THEN _pid END AS TOA_Reiterado
  FROM x3 LEFT JOIN rv ON x3.Nro_TOA = rv._rid),
rep AS (SELECT
  {_report_select()}
  FROM x4),
ext AS (SELECT CAST(l_orderkey + {OFF} AS VARCHAR) AS a, l_shipdate AS tb FROM lineitem WHERE l_returnflag = 'R'),
cons AS (SELECT rep.*,
    CASE WHEN ID_TOA IN (SELECT a FROM ext) THEN 'SI' ELSE 'NO' END AS EN_TDE,
    CASE WHEN Creacion_TOA BETWEEN (SELECT min(tb) FROM ext) AND (SELECT max(tb) FROM ext) THEN 'en_rango' ELSE ''
      END AS en_rango,
    {conflict('Estado_TOA', 'Estado_1')} AS Etiqueta
  FROM rep)"""


def consolidated_sql() -> str:
    return "WITH " + consolidated_ctes() + "\nSELECT * FROM cons"


def published_sql(as_of: str) -> str:
    h = f"date_diff('microsecond', Creacion_TOA, TIMESTAMP '{as_of}') / 3600000000.0::DOUBLE"
    columns = ",\n  ".join(f'"{c}"' if c in _TS_COLS else f'{_blanked(c)} AS "{c}"' for c in ALL_COLS)
    return "WITH " + consolidated_ctes() + f""",
pub AS (SELECT *, CASE WHEN NOT coalesce(Estado_TOA IN ('Completado', 'Cancelado'), false) THEN {h} END AS Semaforo_horas
        FROM cons)
SELECT {columns}, Semaforo_horas,
  CASE WHEN Semaforo_horas BETWEEN 0.000001 AND 3 THEN 'verde'
       WHEN Semaforo_horas > 3 AND Semaforo_horas <= 6 THEN 'amarillo'
       WHEN Semaforo_horas > 6 THEN 'rojo' ELSE '' END AS Semaforo,
  coalesce(CAST(trunc(CAST(Rechazos AS DOUBLE)) AS BIGINT) > 0, false) AS alerta_rechazos,
  coalesce(CAST(trunc(CAST(Dias_Swap AS DOUBLE)) AS BIGINT) <> 0 AND CAST(trunc(CAST(Dias_Swap AS DOUBLE)) AS BIGINT) < 8, false)
    AS alerta_swap,
  coalesce(CAST(trunc(CAST(Dias_TSS AS DOUBLE)) AS BIGINT) <> 0 AND CAST(trunc(CAST(Dias_TSS AS DOUBLE)) AS BIGINT) < 8, false)
    AS alerta_tss,
  coalesce(contains(Estado_PR_1, 'Pause'), false) OR coalesce(contains(Estado_PR_2, 'Pause'), false)
    OR coalesce(contains(Estado_PR_3, 'Pause'), false) AS alerta_pausa
FROM pub"""


_TS_COLS = {"Creacion_TOA", "Cierre_TOA", "SLA_Inicio", "SLA_Fin", *[f"{n}_PR{i}" for i in (1, 2, 3, 4) for n in ("Inicio", "Fin")], "Hora_PR_1", "Hora_PR_2", "Hora_PR_3", "Fecha_Fin_Swap", "Fecha_TSS",
            "Hora_Creacion_Abastecimiento"}
_NUM_COLS = {"Tiempo_TOA_Autin", "Rechazos", "Dias_Swap", "Dias_TSS", "Dias_Abastecimiento", "Duracion_Horas", "Alarmas_Activas"}
ALL_COLS = list(config.REPORT_COLUMNS.values()) + ["EN_TDE", "en_rango", "Etiqueta"]


def _blanked(c: str) -> str:
    q = f'"{c}"'
    if c in _NUM_COLS:
        return f"CASE WHEN {q} IS NULL OR {q} = 0 THEN '' ELSE CAST({q} AS VARCHAR) END"
    if c in _TS_COLS:
        return f"CASE WHEN {q} IS NULL THEN '' ELSE CAST({q} AS VARCHAR) END"
    return f"CASE WHEN {q} IS NULL OR {q} IN ('nan', 'None') THEN '' ELSE {q} END"


def vendor_extracts_sql() -> str:
    exprs = [f'{_blanked(c)} AS "{c}"' for c in ALL_COLS if c not in config.VENDOR_EXTRACT_DROP]
    vendors = ", ".join(f"('{v}')" for v in config.VENDORS)
    return ("WITH " + consolidated_ctes() + f""",
ve AS (SELECT v.vendor, c.* FROM cons c JOIN (VALUES {vendors}) v(vendor) ON contains(lower(c.Bucket), v.vendor))
SELECT vendor, """ + ",\n  ".join(exprs) + "\nFROM ve")
