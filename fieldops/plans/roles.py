"""Role mapping: how the driver tables stand in for the process's feeds.

work order = orders, task = lineitem (parent l_orderkey), site = customer
(+ nation, region), incident = events of type 'error', supply / candidate work
order = events of type 'purchase' (site key user_id), notes = documents.text.
Everything is derived from the tables with Spark, so work grows with them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldops import config
from fieldops.functions.clean import zero_fill
from fieldops.session import table


def _map(c, mapping: dict[str, str]):
    out = None
    for k, v in mapping.items():
        out = F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v))
    return out


def incidents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").where(F.col("event_type") == "error").select("event_id", "user_id", "ts", "value")


def purchases(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts", "value")


def order_status(c):
    return _map(c, config.ORDER_STATUS_ROLE)


def task_status(c):
    return _map(c, config.TASK_STATUS_ROLE)


def tier(c):
    return _map(c, config.SEGMENT_TIER_ROLE)


def provider(c):
    return _map(c, config.SEGMENT_PROVIDER_ROLE)


def lineitem_order():
    """Total order of lineitem rows inside one order (rows equal on all of
    these are identical in every column that is published)."""
    return ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_linestatus"]


# --------------------------------------------------------------------------- feeds for the reports

TOA_OFFSET = 10_000_000  # order keys become work-order numbers of 8 digits, from key 90,000,000 on of more
TOA_DIGITS = (8, 19)  # least and greatest length of those numbers, for any bigint key

# Field-report phrases used as task observations (our fixture text).
FIELD_PHRASES = [
    "Se instaló el grupo electrógeno y quedó operativo",
    "No tiene grupo electrógeno, se revisó el rectificador",
    "Técnico cambió las baterías del banco",
    "Se ajustó el ITM principal",
    "Se levanta el breaker de la fase R",
    "Se arregló breakers del tablero",
    "Sin GE en sitio, se encendió grupo portátil",
    "Se coloca g.e. y se recargó batería",
]


def site_code(c):
    """Site code 'S' + letter + 5 digits from an integer key (the shape the
    notes pattern recognises); keys from 2.6 million on get 'SZ' and the whole
    key, unique but beyond that shape."""
    letter = F.substring(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (F.floor(c / 100000) % 26 + 1).cast("int"), 1)
    short = F.concat(F.lit("S"), letter, zero_fill((c % 100000).cast("string"), 5))
    return F.when(c < 2_600_000, short).otherwise(F.concat(F.lit("SZ"), c.cast("string")))


def toa_number(c):
    return (c + F.lit(TOA_OFFSET)).cast("string")


def bucket(priority):
    return (F.when(priority == "1-URGENT", F.lit("Bucket COMFICA Lima"))
            .when(priority == "2-HIGH", F.lit("bucket huawei norte"))
            .when(priority == "3-MEDIUM", F.lit("FLM comfica sur"))
            .otherwise(F.lit("TDP central")))


def work_orders(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    key = F.col("o_orderkey")
    created = F.timestamp_add("MINUTE", key % 1440, F.col("o_orderdate"))
    # an order has up to four pauses of its own, the i-th after i hours
    own_pauses = []
    for i in (1, 2, 3, 4):
        paused = key % 5 >= i
        own_pauses += [
            F.when(paused, F.timestamp_add("HOUR", F.lit(i), created)).alias(f"Inicio_PR{i}"),
            F.when(paused, F.timestamp_add("MINUTE", F.lit(60 * i + 30), created)).alias(f"Fin_PR{i}"),
            F.when(paused, F.concat(F.lit("Motivo "), ((key + i) % 3).cast("string"))).alias(f"Motivo_PR{i}"),
        ]
    return o.select(
        toa_number(F.col("o_orderkey")).alias("Nro_TOA"),
        created.alias("Fecha_de_Registro_de_actividad_TOA"),
        F.when(F.col("o_orderstatus") == "P", F.timestamp_add("HOUR", F.col("o_orderkey") % 50 + 30, created))
        .alias("Fecha_Hora_de_Cancelación"),
        F.col("o_orderpriority").alias("Subtipo_de_Actividad"),
        F.concat(F.lit("PET"), F.col("o_orderkey").cast("string"), F.lit("-01")).alias("Número_de_Petición"),
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("INC"), zero_fill(F.col("o_orderkey").cast("string"), 7)))
        .otherwise(F.concat(F.lit("TT"), F.col("o_orderkey").cast("string"))).alias("ID_del_Ticket"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("Mantenimiento proactivo"))
        .when(F.col("o_totalprice") < 2000, F.lit("Ticket de prueba")).alias("Notas"),
        site_code(F.col("o_custkey")).alias("Código_de_Cliente"),
        bucket(F.col("o_orderpriority")).alias("Bucket_Inicial"),
        order_status(F.col("o_orderstatus")).alias("Estado_TOA"),
        created.alias("SLA_Inicio"),
        F.when(F.col("o_orderstatus") != "P", F.timestamp_add("HOUR", key % 48, created)).alias("SLA_Fin"),
        F.concat(F.lit("-"), (key % 12 + 70).cast("string"), F.lit("."), zero_fill((key % 10000).cast("string"), 4))
        .alias("Direccion_Polar_X"),
        F.concat(F.lit("-"), (key % 18).cast("string"), F.lit("."), zero_fill((key % 7919).cast("string"), 4))
        .alias("Direccion_Polar_Y"),
        F.concat(F.lit("Local "), F.col("o_custkey").cast("string")).alias("Nombre_Local"),
        F.lit("Zona de la orden").alias("Zona"),
        (key % 4).cast("bigint").alias("Alarmas_Activas_Nodo"),
        *own_pauses,
    )


def _task_id():
    return F.concat(F.when(F.col("l_linenumber") % 3 == 0, F.lit("PLM")).otherwise(F.lit("CM")), F.lit("-"),
                    F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))


def _createtime():
    return F.timestamp_add("MINUTE", F.col("l_partkey") % 1440, F.col("l_shipdate"))


def tasks(spark: SparkSession, d: str) -> DataFrame:
    """Task state table: one row per Task_Id (lines repeating an id are later
    drops of the same task; the greatest line wins).  The raw line columns are
    de-duplicated first, so only narrow fixed-width rows go through the
    shuffle; the text columns are derived afterwards."""
    from fieldops.operators.state import latest_by_key
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                            "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                                            "l_shipdate")
    li = latest_by_key(li, ["l_orderkey", "l_linenumber"],
                       ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                        "l_returnflag", "l_linestatus"])
    created = _createtime()
    phrases = F.array(*[F.lit(p) for p in FIELD_PHRASES])
    return li.select(
        _task_id().alias("Task_Id"),
        F.when((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "N"), F.lit("Abastecimiento"))
        .when((F.col("l_linenumber") % 3 == 0) & (F.col("l_discount") >= 0.05), F.lit("PROACTIVO"))
        .otherwise(F.lit("Correctivo")).alias("Task_Category"),
        created.alias("Createtime"),
        F.when(F.col("l_discount") == 0.0, F.lit("Duplicado")).when(F.col("l_discount") == 0.01, F.lit("Acceso denegado"))
        .alias("Cancel_Reason"),
        task_status(F.col("l_returnflag")).alias("Task_Status"),
        site_code(F.col("l_suppkey")).alias("Site_Id"),
        F.concat(F.lit("EQ"), (F.col("l_partkey") % 20).cast("string")).alias("Com_Level_1_Aff_Equip"),
        F.when(F.col("l_linenumber") % 2 == 0, F.concat(toa_number(F.col("l_orderkey")), F.lit(".0")))
        .otherwise(toa_number(F.col("l_orderkey"))).alias("Number_OS_SIOM"),
        (F.col("l_quantity").cast("int") % 3).alias("Reject_Counter"),
        F.when(F.col("l_returnflag").isin("R", "A"), F.timestamp_add("HOUR", F.col("l_quantity").cast("int"), created))
        .alias("Complete_Time"),
        F.when(F.col("l_returnflag") == "N", F.timestamp_add("HOUR", F.col("l_partkey") % 100, created)).alias("Cancel_Time"),
        F.when(F.col("l_tax") > 0.02, F.timestamp_add("MINUTE", F.lit(90), created)).alias("Arrive_Time"),
        F.when(F.col("l_linestatus") == "F", F.lit("ENERGIA")).otherwise(F.lit("TRANSMISION")).alias("Com_Fault_Speciality"),
        F.when(F.col("l_quantity") > 25, F.lit("Falla AC")).otherwise(F.lit("DC")).alias("Com_Fault_Sub_Speciality"),
        F.when(F.col("l_partkey") % 5 > 0, F.concat(F.lit("Causa "), (F.col("l_partkey") % 5).cast("string"))).alias("Com_Fault_Cause"),
        F.element_at(phrases, (F.col("l_partkey") % 8 + 1).cast("int")).alias("Leave_Observations"),
        F.element_at(phrases, (F.col("l_suppkey") % 8 + 1).cast("int")).alias("Detalle_de_actuación_realizada"),
    )


def pauses(spark: SparkSession, d: str) -> DataFrame:
    """Pause rows per task (some tasks pause twice); de-duplicated on the
    composite key Order_ID + '_' + Operation_Time, last wins.  Dealt by Order_ID: a join
    on it needs no other shuffle, and the key is made behind this one."""
    from fieldops.functions.clean import composite_key
    from fieldops.operators.state import latest_by_key
    li = table(spark, d, "lineitem").where(F.col("l_tax") >= 0.04)
    created = _createtime()
    first = li.select(_task_id().alias("Order_ID"), F.timestamp_add("DAY", F.lit(1), created).alias("Operation_Time"),
                      F.when(F.col("l_tax") >= 0.06, F.lit("Pause")).otherwise(F.lit("Resume")).alias("Pause_Time"),
                      F.lit("Espera de acceso").alias("Reason"))
    second = li.where(F.col("l_tax") >= 0.07).select(
        _task_id().alias("Order_ID"), F.timestamp_add("DAY", F.lit(2), created).alias("Operation_Time"),
        F.lit("Pause - cliente").alias("Pause_Time"), F.lit("Cliente ausente").alias("Reason"))
    p = first.unionByName(second).repartition("Order_ID").withColumn("Index", composite_key("Order_ID", "Operation_Time"))
    return latest_by_key(p, ["Order_ID", "Operation_Time", "Index"], ["Pause_Time", "Reason"]).drop("Index")


def confirmed_tests(spark: SparkSession, d: str) -> DataFrame:
    """Confirmed test tickets (A12): suspects are work orders whose notes
    mention a test; the confirmation sheet and the error list come from the
    labels table (doc_id read as an order key)."""
    from fieldops.functions.rules import icontains
    from fieldops.operators.state import review_queue
    wo = work_orders(spark, d)
    cond = F.lit(False)
    for m in config.TEST_MARKERS:
        cond = cond | icontains("Notas", m)
    suspects = wo.where(cond).select("Nro_TOA", "Notas", F.lit(None).cast("string").alias("Confirmado"))
    lab = table(spark, d, "labels")
    sheet = lab.select(toa_number(F.col("doc_id")).alias("Nro_TOA"), F.lit(None).cast("string").alias("Notas"),
                       F.when(F.col("quality") == 1, F.lit("SI")).otherwise(F.lit("NO")).alias("Confirmado"))
    errors = lab.where(F.col("toxic") == 1).select(toa_number(F.col("doc_id")).alias("Nro_TOA"),
                                                   F.lit(config.ERROR_LIST_NOTE).alias("Notas"),
                                                   F.lit("SI").alias("Confirmado"))
    _merged, confirmed, _pending = review_queue(suspects, sheet, errors, "Nro_TOA")
    return confirmed.select("Nro_TOA")


def external_activity(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").where(F.col("l_returnflag") == "R")
    return li.select(toa_number(F.col("l_orderkey")).alias("activityId"), F.col("l_shipdate").alias("timeOfBooking"))


def sites(spark: SparkSession, d: str) -> DataFrame:
    from fieldops.plans.catalog import sites_table
    key = F.col("Codigo_Unico")
    s = sites_table(spark, d).withColumns({
        "Nombre_Local": F.col("c_name"),
        "Distrito": F.concat(F.lit("Distrito "), (key % 43).cast("string")),
        "Tipo_Local": F.when(F.col("c_acctbal") < 0, F.lit("Indoor")).otherwise(F.lit("Outdoor")),
        "Atencion": F.when(key % 2 == 0, F.lit("Presencial")).otherwise(F.lit("Remota")),
        "Zona": F.concat(F.lit("Zona "), F.col("Departamento")),
        "Tipo_Zona_FLM": F.when(key % 3 == 0, F.lit("Urbana")).when(key % 3 == 1, F.lit("Rural")),
        "Tipo_Estacion": F.lower("c_mktsegment"),
        "ubigeotoa": zero_fill(key.cast("string"), 6),
    })
    s = s.withColumn("Codigo_Unico", site_code(key))
    return s.withColumns({"SLA": tier(F.col("c_mktsegment")), "priorizacion": tier(F.col("c_mktsegment")),
                          "Proveedor_FLM": provider(F.col("c_mktsegment"))})


def incident_feed(spark: SparkSession, d: str) -> DataFrame:
    """Incidents (error events) written around the order whose key equals the
    event id: the incident starts 0.5-6.5 h before that order was registered,
    at the order's site.  A third carry the order's incident key as ticket id,
    a third name the order number in the notes, the rest must be found by
    time near the incident at the site."""
    e = table(spark, d, "events").where(F.col("event_type") == "error").select("event_id", "user_id", "ts")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    x = e.join(o, e.event_id == o.o_orderkey, "left")
    k = F.col("event_id")
    sel = k % 3
    created = F.timestamp_add("MINUTE", F.col("o_orderkey") % 1440, F.col("o_orderdate"))
    start = F.timestamp_add("MINUTE", -((k % 7) * 60 + 30), created)
    site = site_code(F.coalesce(F.col("o_custkey"), F.col("user_id")))
    resumen = F.concat(F.lit("INC | "), F.when(k % 4 == 0, F.lit("ac failure")).otherwise(F.lit("alarma de energia")),
                       F.lit(" | nodo"))
    notas = F.concat_ws("\n", F.concat(F.lit("Alarma: "), F.when(k % 2 == 0, F.lit("Falla de energia"))
                                       .otherwise(F.lit("Puerta abierta"))),
                        F.when(sel == 1, F.concat(F.lit("TOA: "), toa_number(k))),
                        F.concat(F.lit("Sitio "), site),
                        F.when(k % 7 == 0, F.lit("Circuito: 123")))
    return x.select(
        F.when(sel == 0, F.concat(F.lit("INC"), zero_fill(k.cast("string"), 7)))
        .otherwise(F.concat(F.lit("R"), k.cast("string"))).alias("ID_incidencia"),
        start.alias("Fecha_inicio_incidente"),
        F.timestamp_add("MINUTE", F.lit(20), start).alias("Fecha_envio"),
        resumen.alias("Resumen"), notas.alias("Notas"), F.col("user_id"),
        F.when(k % 5 == 0, F.lit("Cerrado")).otherwise(F.lit("Asignado")).alias("Estado"),
        F.when(k % 5 == 0, F.timestamp_add("HOUR", F.lit(9), start)).alias("Fecha_cierre"),
        F.when(k % 5 == 0, F.timestamp_add("HOUR", F.lit(8), start)).alias("Fecha_fin_incidente"),
        F.when(k % 2 == 0, F.lit("Total")).otherwise(F.lit("Parcial")).alias("Tipo_afectacion"),
        F.when(k % 2 == 0, F.lit("FLM COMFICA")).otherwise(F.lit("FLM HUAWEI")).alias("Grupo_asignado"))


def alarm_catalogue(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    return p.select(F.lower(F.col("p_name")).alias("Alarma"), F.col("p_type").alias("Tipo"))
