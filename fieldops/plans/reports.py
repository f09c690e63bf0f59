"""Report compositions (W3-W6): the consolidated work-order report, its
published form, and the incident SLA report.

Inputs use the feed's own column names (spaces already normalised to '_').
Every step is a DataFrame operator from this package; the plans are lazy and
Catalyst prunes the many unused feed columns down to the scans."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldops import config
from fieldops.functions import clean, rules, text
from fieldops.operators import joins, repeat, slots, state
from fieldops.sources.io import stage_table

HOUR = 3_600_000_000
SUPPLY_BUCKET = 30 * 24 * HOUR  # a site has a few tasks a month: by day, most buckets would hold one row and hand on one

TASK_PIVOT_COLS = [
    "Task_Id", "Task_Status", "Cancel_Reason", "Hora_PR", "Motivo_PR", "Estado_PR", "Createtime",
    "Task_Id_Abastecimiento", "Task_Status_Abastecimiento", "Createtime_Abastecimiento", "Abastecimiento_dias",
    "Reject_Counter", "Com_Level_1_Aff_Equip", "Duration_hours",
]
SUPPLY_COLS = TASK_PIVOT_COLS[7:11]  # of the latest open supply task
#: What W3 reads of the task table.
TASK_COLS = ["Task_Id", "Task_Category", "Createtime", "Cancel_Reason", "Task_Status", "Site_Id", "Com_Level_1_Aff_Equip",
             "Number_OS_SIOM", "Reject_Counter", "Complete_Time"]


# --------------------------------------------------------------------------- W3

def order_number(c: str = "Number_OS_SIOM") -> Column:
    """The work-order number that a task refers to."""
    return clean.canon_id(c, width=0)


def classify_tasks(tasks: DataFrame, pauses: DataFrame, k: int = config.TASK_SLOTS,
                   digits: tuple[int, int] = config.ORDER_DIGITS, only: DataFrame | None = None,
                   wanted: Collection[str] | None = None, stored: bool = True) -> DataFrame:
    """One row per work-order reference with its best ``k`` tasks wide.

    tasks: ``TASK_COLS`` (one row per Task_Id -- the state table).
    pauses: Order_ID, Operation_Time, Pause_Time, Reason.
    digits: least and greatest length of an order number; other references are left out.
    only: with it, only these order numbers (column ``Number_OS_SIOM``, distinct) are worked out.
    wanted: with it, only these columns are of interest (default: all).

    Supply tasks are looked up for the slots: what that needs is the order, site and time of a
    slot, so no whole task goes through the as-of join.  The slots are ``stored`` before; a caller that
    reads no supply column needs it not, as the optimizer drops the lookup."""
    names = [f"{c}_{i}" for i in range(1, k + 1) for c in TASK_PIVOT_COLS]
    names = names if wanted is None else [c for c in names if c in wanted]
    t = tasks.select(*TASK_COLS)
    supply = t.where(rules.supply_task("Task_Category", "Task_Status")).select(
        "Site_Id", F.col("Task_Id").alias("Task_Id_Abastecimiento"),
        F.col("Task_Status").alias("Task_Status_Abastecimiento"),
        F.col("Createtime").alias("Createtime_Abastecimiento"))
    t = t.where(rules.exclude_values("Cancel_Reason") & rules.eligible_task("Task_Id", "Task_Category"))
    if only is not None:
        t = t.withColumn("_os", order_number()).join(only.select(F.col("Number_OS_SIOM").alias("_os")), "_os", "left_semi").drop("_os")
        supply = supply.join(t.select("Site_Id").distinct(), "Site_Id", "left_semi")
    t = t.drop("Task_Category").withColumn("Number_OS_SIOM", order_number())
    t = t.where(F.coalesce(clean.fixed_length("Number_OS_SIOM", *digits), F.lit(False)))
    pr = pauses.select(F.col("Order_ID").alias("Task_Id"), F.col("Operation_Time").alias("Hora_PR"),
                       F.col("Pause_Time").alias("Estado_PR"), F.col("Reason").alias("Motivo_PR"))
    t = joins.enrich(t, pr, "Task_Id")  # a task with several pauses fans out (kept: slots compact later)
    t = t.withColumn("Prioridad", slots.priority("Task_Status"))
    order = [F.col("Prioridad"), F.col("Createtime").asc_nulls_last(), F.col("Task_Id"),
             F.col("Hora_PR").asc_nulls_last(), F.col("Estado_PR").asc_nulls_last(), F.col("Motivo_PR").asc_nulls_last()]
    t = slots.top_k(t, "Number_OS_SIOM", order, k=k, rank_col="Orden")
    t = t.withColumn("Duration_hours", F.when(F.col("Complete_Time").isNotNull(),
                                              rules.hours_between("Createtime", "Complete_Time")))
    wide = slots.pivot_slots(t, "Number_OS_SIOM", "Orden", [*[c for c in TASK_PIVOT_COLS if c not in SUPPLY_COLS], "Site_Id"], k=k,
                             apart=[["Hora_PR", "Motivo_PR", "Estado_PR"], ["Createtime", "Site_Id"], ["Reject_Counter", "Com_Level_1_Aff_Equip", "Duration_hours"]])
    supplied = [i for i in range(1, k + 1) if any(f"{c}_{i}" in names for c in SUPPLY_COLS)]
    at_site = {f"{c}_{i}" for c in ("Site_Id", "Createtime") for i in supplied}
    wide = wide.select("Number_OS_SIOM", *[c for c in wide.columns if c in names or c in at_site])
    wide = stage_table(wide, "slots") if stored else wide
    if not supplied:
        return wide.select("Number_OS_SIOM", *names)
    # latest open supply task of the same site created strictly before the task
    at = wide.select("Number_OS_SIOM", F.explode(F.array(*[
        F.struct(F.lit(i).alias("Orden"), F.col(f"Site_Id_{i}").alias("Site_Id"), F.col(f"Createtime_{i}").alias("Createtime")) for i in supplied])).alias("_t"))
    at = at.select("Number_OS_SIOM", "_t.*").where(F.col("Site_Id").isNotNull() & F.col("Createtime").isNotNull())
    at = joins.asof_join(at, supply, "Site_Id", "Createtime", "Createtime_Abastecimiento",
                         ["Task_Id_Abastecimiento", "Task_Status_Abastecimiento", "Createtime_Abastecimiento"],
                         right_tiebreak=["Task_Id_Abastecimiento"], strict=True, bucket_micros=SUPPLY_BUCKET)
    at = at.withColumn("Abastecimiento_dias", rules.whole_days("Createtime_Abastecimiento", "Createtime"))
    # one row per order: where no supply column is asked for, the optimizer drops the join
    found = slots.pivot_slots(at, "Number_OS_SIOM", "Orden", SUPPLY_COLS, k=k).withColumnRenamed("Number_OS_SIOM", "_os")
    return wide.join(found, F.col("Number_OS_SIOM") == F.col("_os"), "left").select("Number_OS_SIOM", *names)


# --------------------------------------------------------------------------- W4

def consolidate(orders: DataFrame, tasks: DataFrame, pauses: DataFrame, sites: DataFrame, confirmed_tests: DataFrame,
                external: DataFrame, digits: tuple[int, int] = config.ORDER_DIGITS) -> DataFrame:
    """The consolidated report, one row per work order (times the fan-out
    of duplicated site rows, which the site state table prevents).

    orders: Nro_TOA, Fecha_de_Registro_de_actividad_TOA, Fecha_Hora_de_Cancelación,
    Subtipo_de_Actividad, Número_de_Petición, ID_del_Ticket, Notas,
    Código_de_Cliente, Bucket_Inicial, Estado_TOA.
    sites: Codigo_Unico, Departamento, Provincia, SLA, Fecha_Fin_Swap, Fecha_TSS, ...
    confirmed_tests: Nro_TOA of confirmed test tickets.
    external: activityId, timeOfBooking."""
    # the task slots feed both the report and repeat detection: W3 stores them once
    wide = classify_tasks(tasks, pauses, digits=digits, wanted={*config.REPORT_COLUMNS, "Createtime_1"})
    ext = external.select(F.col("activityId").cast("string").alias("_a"), F.col("timeOfBooking").alias("_tb"))
    bounds = ext.agg(F.struct(F.min("_tb").alias("lo"), F.max("_tb").alias("hi"))).scalar()
    return assemble(orders, wide, repeats(repeat_keys(orders, wide)), sites, confirmed_tests, ext.select(F.col("_a").alias("activityId")),
                    bounds["lo"], bounds["hi"])


CREATED = "Fecha_de_Registro_de_actividad_TOA"


def repeat_keys(orders: DataFrame, wide: DataFrame) -> DataFrame:
    """What repeat detection looks at, one row per order: keys from the orders and
    their slots alone (no site or test join is evaluated for it)."""
    o = orders.select(clean.strip(F.col("Nro_TOA").cast("string")).alias("Nro_TOA"), F.col("Código_de_Cliente").alias("Codigo_Unico"), CREATED)
    w = wide.select(F.col("Number_OS_SIOM").alias("_os"), "Com_Level_1_Aff_Equip_1")
    return o.join(w, F.col("Nro_TOA") == F.col("_os"), "left").drop("_os")


def repeats(keys: DataFrame) -> DataFrame:
    """``repeat_keys`` with Reiteradas and TOA_Reiterado."""
    return repeat.repeat_within(keys, ["Codigo_Unico", "Com_Level_1_Aff_Equip_1"], CREATED, "Nro_TOA", days=config.REPEAT_DAYS)


def assemble(orders: DataFrame, wide: DataFrame, repeated: DataFrame, sites: DataFrame, confirmed_tests: DataFrame, activities: DataFrame,
             lo: Column, hi: Column) -> DataFrame:
    """The report's rows of ``orders`` from their slots and repeats.  ``activities``:
    activityId; ``lo`` and ``hi``: the range of booking times."""
    o = orders.withColumnRenamed("Código_de_Cliente", "Codigo_Unico")
    o = o.withColumn("Nro_TOA", clean.strip(F.col("Nro_TOA").cast("string")))
    x = joins.join_suffix(o, sites, "Codigo_Unico", suffix="_sitios")
    x = joins.flag_in(x, "Nro_TOA", confirmed_tests.select(F.col("Nro_TOA").cast("string").alias("_t")), "_t",
                      "TEST", yes=config.L_TEST, no="")
    x = x.withColumns({
        "Empresa": rules.vendor("Bucket_Inicial"),
        "Marcha_Blanca": rules.soft_launch("Departamento", "Provincia"),
        "Notas": F.coalesce(F.col("Notas"), F.lit("")),
    })
    x = x.withColumns({
        "Proactivo": rules.proactive("Notas"),
        "Responsable": rules.responsible("Bucket_Inicial"),
        "SWAP_dias": rules.days_since("Fecha_Fin_Swap", CREATED),
        "TSS_dias": rules.days_since("Fecha_TSS", CREATED),
    })
    x = x.join(wide.withColumnRenamed("Number_OS_SIOM", "_os"), F.col("Nro_TOA") == F.col("_os"), "left").drop("_os")
    x = x.withColumn("Tiempo_TOA_Autin", rules.minutes_between(CREATED, "Createtime_1"))
    # joined back on the (unique) order number
    x = x.join(repeated.select("Nro_TOA", "Reiteradas", "TOA_Reiterado"), "Nro_TOA", "left")
    report = clean.project_as(x, config.REPORT_COLUMNS)
    report = joins.flag_in(report, "ID_TOA", activities.select(F.col("activityId").cast("string").alias("_a")), "_a", "EN_TDE")
    report = report.withColumn("en_rango", rules.in_range_flag("Creacion_TOA", lo, hi))
    return report.withColumn("Etiqueta", rules.status_conflict("Estado_TOA", "Estado_1"))


def vendor_extracts(report: DataFrame) -> DataFrame:
    """S9 on the report: one row per vendor named in the bucket, internal
    columns dropped, placeholders blanked; write with
    ``sources.io.write_vendor_extracts`` (partitioned by vendor)."""
    from fieldops.sources.io import vendor_rows
    x = vendor_rows(report, "Bucket", config.VENDORS)
    x = clean.drop_if(x, config.VENDOR_EXTRACT_DROP)
    return clean.blank_placeholders(x, [c for c in x.columns if c != "vendor"])


# --------------------------------------------------------------------------- W6

def published_report(report: DataFrame, as_of: Column, contract: Mapping[str, str] = config.REPORT_CONTRACT) -> DataFrame:
    """Age of open work orders as of ``as_of`` with its colour band, and
    the attention flags the workbook highlighted (rejections, recent swap /
    TSS, paused slots) beside every column of the report, whose placeholders
    (0, NULL, 'nan', 'None') are blanked but for times, which keep their type; newest orders first (O1).
    Cell colours themselves are presentation.  Columns that aren't of their
    ``contract`` type (a report read back from text) are cast first (C4)."""
    report = clean.ensure_contract(report, contract)
    times = {f.name for f in report.schema.fields if f.dataType.typeName().startswith("timestamp")}
    blanked = [c for c in report.columns if c not in times]
    # sorted by the published values, but before the rows become wider and all text
    report = state.order_out(report, [clean.blanked(report, c) if c in blanked else F.col(c) for c in ("Creacion_TOA", "ID_TOA")], [True, True])
    x = report.withColumn("Semaforo_horas", rules.open_age_hours("Creacion_TOA", "Estado_TOA", as_of))
    x = x.withColumn("Semaforo", rules.age_band("Semaforo_horas"))
    x = x.withColumns({
        "alerta_rechazos": rules.attention_positive("Rechazos"),
        "alerta_swap": rules.attention_below("Dias_Swap"),
        "alerta_tss": rules.attention_below("Dias_TSS"),
        "alerta_pausa": rules.attention_paused("Estado_PR_1") | rules.attention_paused("Estado_PR_2")
        | rules.attention_paused("Estado_PR_3"),
    })
    return clean.blank_placeholders(x, blanked)


# --------------------------------------------------------------------------- W5

def task_slots(tasks: DataFrame, pauses: DataFrame, digits: tuple[int, int] = config.ORDER_DIGITS) -> DataFrame:
    """The task slots of every work order as the consolidated report names
    them (ID_TOA, Autin_ID_i, Estado_i, Motivo_Cancel_i) -- straight from W3,
    without building the rest of the report."""
    w = classify_tasks(tasks, pauses, digits=digits, stored=False)
    return w.select(F.col("Number_OS_SIOM").alias("ID_TOA"),
                    *[F.col(f"{src}_{i}").alias(f"{dst}_{i}")
                      for src, dst in (("Task_Id", "Autin_ID"), ("Task_Status", "Estado"),
                                       ("Cancel_Reason", "Motivo_Cancel")) for i in (1, 2, 3)])


def incident_report(incidents: DataFrame, orders: DataFrame, tasks: DataFrame, sites: DataFrame,
                    alarms: DataFrame, report: DataFrame, cutoff: str,
                    digits: tuple[int, int] = config.ORDER_DIGITS) -> DataFrame:
    """One row per incident, matched to work orders by key, by the order
    number written in the notes and by time near the incident at its site;
    with SLA bands, cancellation timing, swap relation, supply tasks and
    text-derived action flags.

    incidents: ID_incidencia, Fecha_envio, Fecha_inicio_incidente, Resumen, Notas; others pass.
    orders: Nro_TOA, ID_del_Ticket, Número_de_Petición, Fecha_de_Registro_de_actividad_TOA,
    Código_de_Cliente, Fecha_Hora_de_Cancelación, Estado_TOA.
    tasks: Task_Id, Task_Category, Createtime, Task_Status, Site_Id, Cancel_Time,
    Complete_Time, Arrive_Time, Com_Fault_Speciality, Com_Fault_Sub_Speciality, Com_Fault_Cause,
    Leave_Observations, Detalle_de_actuación_realizada.
    sites: Codigo_Unico, Proveedor_FLM, priorizacion, Tipo_Estacion, Fecha_Fin_Swap.
    alarms: Alarma, Tipo.  report: the consolidated report, or just its slot
    columns (``task_slots``)."""
    created = "Fecha_de_Registro_de_actividad_TOA"
    inc = incidents.where(rules.since("Fecha_inicio_incidente", cutoff))
    inc = text.identify_alarms(inc, "Resumen", "Notas", text.alarm_catalogue(alarms))
    site_keys = sites.select(F.col("Codigo_Unico").cast("string").alias("_code"))
    inc = inc.withColumn("_codes", text.site_codes("Notas"))
    inc = joins.first_known(inc, "ID_incidencia", "_codes", site_keys, "_code", "ID_Sitio").drop("_codes")
    inc = inc.withColumns({"_corp": text.corporate_case("Notas"), "TOA_notas": text.order_in_notes("Notas", digits)})

    toa = orders.select(
        clean.canon_id("Nro_TOA").alias("Nro_TOA"), clean.strip("ID_del_Ticket").alias("ID_del_Ticket"),
        clean.strip_suffix("Número_de_Petición").alias("Número_de_Petición"), created,
        F.col("Código_de_Cliente").cast("string").alias("Código_de_Cliente"), "Fecha_Hora_de_Cancelación",
        "Estado_TOA")
    toa = toa.withColumn("Clave_Remedy", clean.incident_key("ID_del_Ticket", "Número_de_Petición"))
    cols = ["Nro_TOA", "ID_del_Ticket", "Número_de_Petición", created, "Código_de_Cliente",
            "Fecha_Hora_de_Cancelación", "Estado_TOA"]
    inc = inc.withColumn("ID_incidencia", clean.strip("ID_incidencia"))
    x = joins.coalesce_join(inc, toa, ("ID_incidencia", "Clave_Remedy"), ("TOA_notas", "Nro_TOA"), cols,
                            second_order=[created, "Nro_TOA"],
                            second_when=F.col("TOA_notas") != config.L_NO_ORDER_IN_NOTES, needed="Nro_TOA")
    x = x.withColumn("ID_Sitio", F.coalesce(F.col("ID_Sitio"), F.col("Código_de_Cliente")))
    # row key after the (possible) fan-out of the key match; deterministic, so
    # a recomputed partition gets the same keys
    x = x.withColumn("_rk", F.concat_ws("|", F.col("ID_incidencia"), F.coalesce(F.col("Nro_TOA"), F.lit(""))))
    st = sites.select(F.col("Codigo_Unico").cast("string").alias("ID_Sitio"), "Proveedor_FLM", "priorizacion",
                      "Tipo_Estacion", "Fecha_Fin_Swap")
    x = x.join(st, "ID_Sitio", "left")
    x = x.withColumn("Razones_Sin_TOA", rules.no_order_reason("_corp", "Nro_TOA", "Proveedor_FLM", "ID_Sitio"))
    # matched incidents are read by the candidate search, the slot lookups and
    # the supply interval join: store them once (cuts the lineage too)
    x = stage_table(x, "incidents_matched")

    # candidate work orders near the incident for incidents without one
    used = x.select("Nro_TOA")
    need = x.where(F.col("Nro_TOA").isNull() & F.col("ID_Sitio").isNotNull()).select("_rk", "ID_Sitio", "Fecha_envio")
    w = config.CANDIDATE_WINDOW_HOURS * HOUR
    near = toa.select("Nro_TOA", "Número_de_Petición", F.col("Código_de_Cliente").alias("ID_Sitio"), created)
    near = joins.in_reach(near, need, "ID_Sitio", "Fecha_envio", created, w, w)
    cand = joins.interval_candidates(
        need, joins.anti(near, used, "Nro_TOA"), "ID_Sitio", "_rk", "Fecha_envio",
        created, w, w, "Nro_TOA", ["Número_de_Petición"], k=config.CANDIDATE_SLOTS, prefix="cand")
    x = x.join(cand.drop("ID_Sitio", "Fecha_envio"), "_rk", "left")

    # SLA
    x = x.withColumn("Tiempo_de_Contencion", rules.target_hours("priorizacion"))
    x = x.withColumns({
        "Cumplimiento_de_Contencion": rules.compliance("Tiempo_de_Contencion", "Fecha_inicio_incidente", created),
        "Tiempo_de_envio": rules.hours_between("Fecha_inicio_incidente", created),
    })

    # task slots of the matched order, compacted, then one task lookup for all slots
    sl = report.select(F.col("ID_TOA").cast("string").alias("Nro_TOA"),
                       *[F.col(f"{c}_{i}") for c in ("Autin_ID", "Estado", "Motivo_Cancel") for i in (1, 2, 3)])
    sl = slots.compact_slots(sl, ["Autin_ID_1", "Autin_ID_2", "Autin_ID_3"],
                             [["Estado_1", "Estado_2", "Estado_3"], ["Motivo_Cancel_1", "Motivo_Cancel_2", "Motivo_Cancel_3"]])
    x = joins.left_join_known(x, sl.withColumnRenamed("Nro_TOA", "_sl"), "Nro_TOA", "_sl", ["_rk"]).drop("_sl")
    # one lookup of the task table for all three slots: both end times from every
    # task, field observations only from corrective (CM) tasks
    obs_cols = ["Arrive_Time", "Com_Fault_Speciality", "Com_Fault_Sub_Speciality", "Com_Fault_Cause", "Leave_Observations",
                "Detalle_de_actuación_realizada"]
    is_cm = F.coalesce(F.col("Task_Id").contains("CM"), F.lit(False))
    dim = tasks.select("Task_Id", "Complete_Time", "Cancel_Time", *[F.when(is_cm, F.col(c)).alias(c) for c in obs_cols])
    x = slots.join_slots(x, "_rk", ["Autin_ID_1", "Autin_ID_2", "Autin_ID_3"], dim, "Task_Id",
                         ["Complete_Time", "Cancel_Time", *obs_cols])
    start = "Fecha_inicio_incidente"
    hours = [f"Tiempo_cancelacion_Autin_{i}" for i in (1, 2, 3)] + ["Tiempo_cancelacion_TOA"]
    x = x.withColumns({
        hours[0]: rules.hours_between(start, "Cancel_Time_1"),
        hours[1]: rules.hours_between(start, "Cancel_Time_2"),
        hours[2]: rules.hours_between(start, "Cancel_Time_3"),
        hours[3]: F.when(F.col("Estado_TOA") == config.ORDER_CANCELED,
                         rules.hours_between(start, "Fecha_Hora_de_Cancelación")),
    })
    x = x.withColumn("Tiempo_cancelacion_minimo", rules.bounded_min(hours))
    x = x.withColumn("Error_Contencion", rules.cancel_outcome("Tiempo_de_Contencion", "Tiempo_cancelacion_minimo", hours))
    x = x.withColumn("rango_de_cancelacion", rules.cancel_bin("Tiempo_cancelacion_minimo", "Error_Contencion"))
    x = x.withColumn("Clasificacion_SWAP", rules.swap_relation("ID_Sitio", start, "Fecha_Fin_Swap"))

    # supply tasks of the site within 48 h after the work order
    supply = tasks.where(rules.supply_task("Task_Category", "Task_Status")).select(
        F.col("Site_Id").cast("string").alias("ID_Sitio"), F.col("Task_Id").alias("_sid"),
        F.col("Createtime").alias("_sts"))
    x = joins.interval_collect(x, supply, "ID_Sitio", "_rk", created, "_sts", 0,
                               config.SUPPLY_WINDOW_HOURS * HOUR, "_sid",
                               count_col="Cantidad_Tickets_Abastecimiento", list_col="Lista_Abastecimiento")
    x = x.withColumns({
        "Hubo_Abastecimiento": rules.yes_no(F.col("Cantidad_Tickets_Abastecimiento") > 0, "Si", "No"),
        "Lista_Abastecimiento": F.array_join("Lista_Abastecimiento", ", "),
    })

    # observations and text flags
    x = x.withColumns({
        "Tecnico_llego": rules.any_present("Arrive_Time_1", "Arrive_Time_2", "Arrive_Time_3"),
        "Fallo_AC": rules.ac_fault([f"Com_Fault_Speciality_{i}" for i in (1, 2, 3)],
                                   [f"Com_Fault_Sub_Speciality_{i}" for i in (1, 2, 3)]),
        "Texto_Comb": text.combined_text([f"{c}_{i}" for i in (1, 2, 3)
                                          for c in ("Leave_Observations", "Detalle_de_actuación_realizada")]),
    })
    x = x.withColumns({f"Accion_{n}": text.detector(n, "Texto_Comb") for n in config.DETECTORS})
    return x.withColumn("Detectamos_atencion", rules.any_true(
        F.col("Hubo_Abastecimiento") == "Si", F.col("Tecnico_llego") == "Si", F.col("Fallo_AC") == "Si",
        *[F.col(f"Accion_{n}") == "SI" for n in config.DETECTORS])).drop("_corp", "_rk")
