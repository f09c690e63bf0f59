"""Query catalogue: name -> (Spark query, DuckDB oracle SQL).

Each query reads the driver tables in ``sf_dir`` whole and returns a lazy
DataFrame.  The oracle SQL is an independent formulation of the same result
for DuckDB (tables pre-registered as views); names and types of the output
columns agree.  Queries without SQL (streaming) are checked on row counts and
by unit tests."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldops import config
from fieldops.functions import rules
from fieldops.functions.clean import zero_fill
from fieldops.operators import joins, repeat, slots, state
from fieldops.plans import report_sql, roles
from fieldops.session import table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


HOUR = 3_600_000_000
DAY = 24 * HOUR

# Shared SQL fragments ---------------------------------------------------------

SQL_PRIO = "CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 WHEN 'N' THEN 4 ELSE 3 END"
SQL_LINE_ORDER = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus"
SQL_TOP3 = f"""
SELECT l_orderkey, Orden, Prioridad, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_shipdate FROM (
  SELECT *, {SQL_PRIO} AS Prioridad,
         row_number() OVER (PARTITION BY l_orderkey
                            ORDER BY {SQL_PRIO}, l_shipdate NULLS LAST, {SQL_LINE_ORDER}) AS Orden
  FROM lineitem) t
WHERE Orden <= 3"""
SQL_PIVOT = f"""
SELECT l_orderkey,
  max(CASE WHEN Orden = 1 THEN l_partkey END) AS l_partkey_1,
  max(CASE WHEN Orden = 1 THEN l_returnflag END) AS l_returnflag_1,
  max(CASE WHEN Orden = 1 THEN l_shipdate END) AS l_shipdate_1,
  max(CASE WHEN Orden = 2 THEN l_partkey END) AS l_partkey_2,
  max(CASE WHEN Orden = 2 THEN l_returnflag END) AS l_returnflag_2,
  max(CASE WHEN Orden = 2 THEN l_shipdate END) AS l_shipdate_2,
  max(CASE WHEN Orden = 3 THEN l_partkey END) AS l_partkey_3,
  max(CASE WHEN Orden = 3 THEN l_returnflag END) AS l_returnflag_3,
  max(CASE WHEN Orden = 3 THEN l_shipdate END) AS l_shipdate_3
FROM ({SQL_TOP3}) s GROUP BY l_orderkey"""
SQL_ERR = "SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'error'"
SQL_PUR = "SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'purchase'"
SQL_ASOF = f"""
SELECT e.event_id, e.user_id, e.ts, p.event_id AS supply_id, p.ts AS supply_ts
FROM ({SQL_ERR}) e ASOF LEFT JOIN ({SQL_PUR}) p ON e.user_id = p.user_id AND e.ts > p.ts"""


# A1 ---------------------------------------------------------------------------

@register("latest_by_key", """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) t WHERE rn = 1""")
def q_latest_by_key(spark: SparkSession, d: str) -> DataFrame:
    ev = table(spark, d, "events")
    return state.latest_by_key(ev, ["user_id", "event_type"], ["ts", "event_id"])


# A2 / O4 ------------------------------------------------------------------------

@register("upsert_state", """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type
                               ORDER BY event_id % 2 DESC, ts DESC, event_id DESC) AS rn
  FROM events) t WHERE rn = 1""")
def q_upsert_state(spark: SparkSession, d: str) -> DataFrame:
    """Stored table = even event ids, new drop = odd event ids; the new drop
    wins per key whatever its time."""
    ev = table(spark, d, "events")
    base = ev.where(F.col("event_id") % 2 == 0)
    new = ev.where(F.col("event_id") % 2 == 1)
    return state.upsert(base, new, ["user_id", "event_type"], ["ts", "event_id"])


# A3 / A4 / O2 -------------------------------------------------------------------

def top3(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    li = li.withColumn("Prioridad", slots.priority(roles.task_status(F.col("l_returnflag"))))
    order = [F.col("Prioridad"), F.col("l_shipdate").asc_nulls_last()] + [F.col(c) for c in roles.lineitem_order()]
    top = slots.top_k(li, "l_orderkey", order, k=config.TASK_SLOTS, rank_col="Orden")
    return top.select("l_orderkey", "Orden", "Prioridad", "l_partkey", "l_suppkey", "l_linenumber",
                      "l_returnflag", "l_shipdate")


register("top3_slots", SQL_TOP3)(top3)


# A5 ---------------------------------------------------------------------------

def pivot3(spark: SparkSession, d: str) -> DataFrame:
    return slots.pivot_slots(top3(spark, d), "l_orderkey", "Orden", ["l_partkey", "l_returnflag", "l_shipdate"])


register("pivot_slots", SQL_PIVOT)(pivot3)


# A6 ---------------------------------------------------------------------------

@register("compact_slots", f"""
WITH p AS ({SQL_PIVOT}),
f AS (SELECT l_orderkey,
        coalesce(l_returnflag_1, '') AS i1, coalesce(l_returnflag_2, '') AS i2, coalesce(l_returnflag_3, '') AS i3,
        coalesce(CAST(l_partkey_1 AS VARCHAR), '') AS c1, coalesce(CAST(l_partkey_2 AS VARCHAR), '') AS c2,
        coalesce(CAST(l_partkey_3 AS VARCHAR), '') AS c3 FROM p),
m AS (SELECT *, i3 = i2 AS m3, i2 = i1 AS m2 FROM f)
SELECT l_orderkey,
  i1 AS l_returnflag_1,
  CASE WHEN m2 THEN (CASE WHEN NOT m3 THEN i3 END) ELSE i2 END AS l_returnflag_2,
  CASE WHEN m2 OR m3 THEN NULL ELSE i3 END AS l_returnflag_3,
  c1 AS l_partkey_1,
  CASE WHEN m2 THEN (CASE WHEN NOT m3 THEN c3 END) ELSE c2 END AS l_partkey_2,
  CASE WHEN m2 OR m3 THEN NULL ELSE c3 END AS l_partkey_3
FROM m""")
def q_compact_slots(spark: SparkSession, d: str) -> DataFrame:
    p = pivot3(spark, d).select("l_orderkey", "l_returnflag_1", "l_returnflag_2", "l_returnflag_3",
                                "l_partkey_1", "l_partkey_2", "l_partkey_3")
    return slots.compact_slots(p, ["l_returnflag_1", "l_returnflag_2", "l_returnflag_3"],
                               [["l_partkey_1", "l_partkey_2", "l_partkey_3"]])


# A7 ---------------------------------------------------------------------------

def _sql_repeat(tbl: str, keys: list[str], ts: str, rid: str, cols: list[str], micros: int, where: str = "") -> str:
    part = ", ".join(keys)
    valid = " AND ".join(f"{k} IS NOT NULL AND CAST({k} AS VARCHAR) <> ''" for k in keys)
    return f"""
WITH b AS (SELECT {', '.join(cols)} FROM {tbl} {where}),
v AS (SELECT {rid} AS _rid, lag({ts}) OVER w AS _pts, lag({rid}) OVER w AS _pid
      FROM b WHERE {valid} AND {ts} IS NOT NULL
      WINDOW w AS (PARTITION BY {part} ORDER BY {ts}, {rid}))
SELECT b.*,
  CASE WHEN _pid IS NOT NULL AND date_diff('microsecond', _pts, b.{ts}) <= {micros} THEN 'Reiterada' ELSE '' END AS Reiteradas,
  CASE WHEN _pid IS NOT NULL AND date_diff('microsecond', _pts, b.{ts}) <= {micros} THEN _pid END AS TOA_Reiterado
FROM b LEFT JOIN v ON b.{rid} = v._rid"""


@register("repeat_orders", _sql_repeat("orders", ["o_custkey"], "o_orderdate", "o_orderkey",
                                       ["o_orderkey", "o_custkey", "o_orderdate"], 7 * DAY))
def q_repeat_orders(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return repeat.repeat_within(o, ["o_custkey"], "o_orderdate", "o_orderkey", days=config.REPEAT_DAYS)


@register("repeat_events", _sql_repeat("events", ["user_id", "event_type"], "ts", "event_id",
                                       ["event_id", "user_id", "event_type", "ts"], 1 * DAY))
def q_repeat_events(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", "ts")
    return repeat.repeat_within(e, ["user_id", "event_type"], "ts", "event_id", days=1)


# J3 / D2 ------------------------------------------------------------------------

def asof_supply(spark: SparkSession, d: str) -> DataFrame:
    inc = roles.incidents(spark, d).select("event_id", "user_id", "ts")
    sup = roles.purchases(spark, d).select("user_id", F.col("event_id").alias("supply_id"), F.col("ts").alias("supply_ts"))
    return joins.asof_join(inc, sup, "user_id", "ts", "supply_ts", payload=["supply_id", "supply_ts"],
                           right_tiebreak=["supply_id"], strict=True)


@register("asof_supply", f"""
SELECT *, CAST(floor(date_diff('microsecond', supply_ts, ts) / 86400000000.0::DOUBLE) AS BIGINT) AS supply_days
FROM ({SQL_ASOF}) a""")
def q_asof_supply(spark: SparkSession, d: str) -> DataFrame:
    return asof_supply(spark, d).withColumn("supply_days", rules.whole_days("supply_ts", "ts"))


# J4 / J10 -----------------------------------------------------------------------

@register("interval_candidates", f"""
WITH e AS ({SQL_ERR}), p AS ({SQL_PUR}),
used AS (SELECT supply_id FROM ({SQL_ASOF}) a WHERE supply_id IS NOT NULL),
c AS (SELECT * FROM p WHERE event_id NOT IN (SELECT supply_id FROM used)),
pairs AS (
  SELECT e.event_id AS lid, c.event_id AS cid, c.value AS cval,
         row_number() OVER (PARTITION BY e.event_id ORDER BY c.ts, c.event_id) AS rk
  FROM e JOIN c ON e.user_id = c.user_id
   AND c.ts BETWEEN e.ts - INTERVAL 6 HOUR AND e.ts + INTERVAL 6 HOUR)
SELECT e.event_id, e.user_id, e.ts,
  max(CASE WHEN rk = 1 THEN cid END) AS cand_event_id_1, max(CASE WHEN rk = 1 THEN cval END) AS cand_value_1,
  max(CASE WHEN rk = 2 THEN cid END) AS cand_event_id_2, max(CASE WHEN rk = 2 THEN cval END) AS cand_value_2
FROM e LEFT JOIN pairs ON e.event_id = pairs.lid
GROUP BY e.event_id, e.user_id, e.ts""")
def q_interval_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Incidents without a work order look for purchases of the same user
    within +-6 h that no incident has claimed yet (claimed = the as-of match)."""
    inc = roles.incidents(spark, d).select("event_id", "user_id", "ts")
    used = asof_supply(spark, d).select("supply_id")
    free = joins.anti(roles.purchases(spark, d), used, "event_id", "supply_id")
    w = config.CANDIDATE_WINDOW_HOURS * HOUR
    return joins.interval_candidates(inc, free, "user_id", "event_id", "ts", "ts", w, w, "event_id", ["value"],
                                     k=config.CANDIDATE_SLOTS, prefix="cand")


# J5 -----------------------------------------------------------------------------

@register("interval_collect", f"""
WITH e AS ({SQL_ERR}), p AS ({SQL_PUR})
SELECT e.event_id, e.user_id, e.ts, count(p.event_id) AS n_supply,
  coalesce(string_agg(CAST(p.event_id AS VARCHAR), ',' ORDER BY p.ts, p.event_id), '') AS supply_list,
  CASE WHEN count(p.event_id) > 0 THEN 'Si' ELSE 'No' END AS hubo_abastecimiento
FROM e LEFT JOIN p ON e.user_id = p.user_id AND p.ts >= e.ts AND p.ts <= e.ts + INTERVAL 48 HOUR
GROUP BY e.event_id, e.user_id, e.ts""")
def q_interval_collect(spark: SparkSession, d: str) -> DataFrame:
    inc = roles.incidents(spark, d).select("event_id", "user_id", "ts")
    pur = roles.purchases(spark, d).select("event_id", "user_id", "ts")
    out = joins.interval_collect(inc, pur, "user_id", "event_id", "ts", "ts", 0, config.SUPPLY_WINDOW_HOURS * HOUR,
                                 "event_id", count_col="n_supply", list_col="_lst")
    return (out.withColumn("supply_list", F.array_join(F.transform("_lst", lambda x: x.cast("string")), ","))
            .withColumn("hubo_abastecimiento", F.when(F.col("n_supply") > 0, F.lit("Si")).otherwise(F.lit("No")))
            .drop("_lst"))


# J6 / J9 ------------------------------------------------------------------------

@register("fallback_match", """
WITH o AS (SELECT o_orderkey, o_custkey, o_orderstatus FROM orders),
a AS (SELECT o.*, c.c_custkey AS a_custkey, c.c_name AS a_name, c.c_nationkey AS a_nation,
             c.c_mktsegment AS a_segment, c.c_custkey IS NOT NULL AS hit1
      FROM o LEFT JOIN customer c ON (CASE WHEN o.o_orderstatus = 'F' THEN o.o_custkey END) = c.c_custkey),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY c_name ORDER BY c_custkey) AS rn
                     FROM customer WHERE c_name IS NOT NULL) t WHERE rn = 1)
SELECT a.o_orderkey, a.o_custkey,
  CASE WHEN hit1 THEN a_custkey ELSE b.c_custkey END AS c_custkey,
  CASE WHEN hit1 THEN a_name ELSE b.c_name END AS c_name,
  CASE WHEN hit1 THEN a_nation ELSE b.c_nationkey END AS c_nationkey,
  CASE WHEN hit1 THEN a_segment ELSE b.c_mktsegment END AS c_mktsegment,
  CASE WHEN hit1 THEN 'first' WHEN b.c_custkey IS NOT NULL THEN 'second' END AS match_source,
  coalesce(CASE WHEN hit1 THEN a_custkey ELSE b.c_custkey END, a.o_custkey) AS site_id
FROM a LEFT JOIN b
  ON (CASE WHEN NOT hit1 THEN 'Customer#' || lpad(CAST(a.o_custkey AS VARCHAR), 9, '0') END) = b.c_name""")
def q_fallback_match(spark: SparkSession, d: str) -> DataFrame:
    """Completed orders carry a usable customer reference (key A); the rest
    are matched through the customer name written from the number (key B)."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    o = o.withColumn("_ka", F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")))
    o = o.withColumn("_kb", F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")))
    c = table(spark, d, "customer")
    out = joins.coalesce_join(o, c, ("_ka", "c_custkey"), ("_kb", "c_name"),
                              ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"], ["c_custkey"])
    return (out.withColumn("site_id", F.coalesce(F.col("c_custkey"), F.col("o_custkey")))
            .select("o_orderkey", "o_custkey", "c_custkey", "c_name", "c_nationkey", "c_mktsegment",
                    "match_source", "site_id"))


# J7 -----------------------------------------------------------------------------

@register("join_slots", f"""
WITH p AS ({SQL_PIVOT})
SELECT p.l_orderkey, p.l_partkey_1, p.l_partkey_2, p.l_partkey_3,
  a.p_name AS p_name_1, a.p_brand AS p_brand_1, b.p_name AS p_name_2, b.p_brand AS p_brand_2,
  c.p_name AS p_name_3, c.p_brand AS p_brand_3
FROM p LEFT JOIN part a ON p.l_partkey_1 = a.p_partkey LEFT JOIN part b ON p.l_partkey_2 = b.p_partkey
LEFT JOIN part c ON p.l_partkey_3 = c.p_partkey""")
def q_join_slots(spark: SparkSession, d: str) -> DataFrame:
    p = pivot3(spark, d).select("l_orderkey", "l_partkey_1", "l_partkey_2", "l_partkey_3")
    return slots.join_slots(p, "l_orderkey", ["l_partkey_1", "l_partkey_2", "l_partkey_3"],
                            table(spark, d, "part"), "p_partkey", ["p_name", "p_brand"])


# T4 / J8 / O5 -------------------------------------------------------------------

def site_code(c):
    return F.concat(F.lit("CU"), zero_fill(c.cast("string"), 5))


def notes_with_codes(spark: SparkSession, d: str) -> DataFrame:
    """Document text followed by a site line built from the document id: an
    excluded prefix (NC), an unknown code (ZZ), a code glued to a letter (XCU)
    and a customer site code (CU) that may or may not exist."""
    doc = table(spark, d, "documents").select("doc_id", "text")
    k = F.col("doc_id")
    line = F.concat_ws(" ", F.lit("Sitio"), F.concat(F.lit("NC"), F.lpad(k.cast("string"), 5, "0")),
                       F.concat(F.lit("ZZ"), F.lpad((k * 7).cast("string"), 5, "0")),
                       F.concat(F.lit("X"), site_code(k * 3)), site_code(k * 2))
    return doc.withColumn("notas", F.concat_ws("\n", F.col("text"), line)).drop("text")


SQL_NOTES_CODES = """
SELECT doc_id, concat_ws(chr(10), text, concat_ws(' ', 'Sitio', 'NC' || lpad(CAST(doc_id AS VARCHAR), 5, '0'),
   'ZZ' || lpad(CAST(doc_id * 7 AS VARCHAR), 5, '0'), 'XCU' || lpad(CAST(doc_id * 3 AS VARCHAR), 5, '0'),
   'CU' || lpad(CAST(doc_id * 2 AS VARCHAR), 5, '0'))) AS notas
FROM documents"""


@register("first_known_code", f"""
WITH n AS ({SQL_NOTES_CODES}),
x AS (SELECT doc_id, list_filter(regexp_extract_all(notas, '[A-Z]{{2}}[0-9]{{5}}'),
                                 lambda c: NOT (c[1:2] IN ('NC', 'CD', 'CR'))) AS codes FROM n),
e AS (SELECT doc_id, unnest(codes) AS code, generate_subscripts(codes, 1) AS pos FROM x),
s AS (SELECT 'CU' || lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS code FROM customer),
f AS (SELECT doc_id, arg_min(code, pos) AS ID_Sitio FROM e WHERE code IN (SELECT code FROM s) GROUP BY doc_id)
SELECT x.doc_id, CAST(len(list_distinct(codes)) AS BIGINT) AS n_codes, f.ID_Sitio
FROM x LEFT JOIN f ON x.doc_id = f.doc_id""")
def q_first_known_code(spark: SparkSession, d: str) -> DataFrame:
    from fieldops.functions.text import site_codes
    n = notes_with_codes(spark, d).withColumn("_codes", site_codes("notas"))
    sites = table(spark, d, "customer").select(site_code(F.col("c_custkey")).alias("code"))
    out = joins.first_known(n, "doc_id", "_codes", sites, "code", "ID_Sitio")
    return out.select("doc_id", F.size("_codes").cast("bigint").alias("n_codes"), "ID_Sitio")


# J1 / J2 / S5 --------------------------------------------------------------------

def sites_table(spark: SparkSession, d: str) -> DataFrame:
    """Site table from three feeds: base (customer, nation as province, region
    as department), swap feed (latest purchase per user) and TSS feed (latest
    signup per user)."""
    from fieldops.sources.sites import build_sites
    c = table(spark, d, "customer")
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    base = (c.join(n, c.c_nationkey == n.n_nationkey, "left").join(r, n.n_regionkey == r.r_regionkey, "left")
            .select(F.col("c_custkey").alias("Codigo_Unico"), "c_name", F.col("n_name").alias("Provincia"),
                    F.col("r_name").alias("Departamento"), "c_mktsegment", "c_acctbal"))
    ev = table(spark, d, "events")

    def latest(kind: str, ts_name: str) -> DataFrame:
        last = state.latest_by_key(ev.where(F.col("event_type") == kind).select("user_id", "ts", "event_id", "value"),
                                   "user_id", ["ts", "event_id"])
        return last.select(F.col("user_id").alias("Codigo_Unico"), F.col("ts").alias(ts_name), "value")

    return build_sites(base, latest("purchase", "Fecha_Fin_Swap"), latest("signup", "Fecha_TSS"), tss_suffix=None)


SQL_SITES = """
WITH sw AS (SELECT user_id, ts AS Fecha_Fin_Swap, value FROM (
              SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
              FROM events WHERE event_type = 'purchase') t WHERE rn = 1),
     tss AS (SELECT user_id, ts AS Fecha_TSS, value AS value_tss FROM (
              SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
              FROM events WHERE event_type = 'signup') t WHERE rn = 1)
SELECT c.c_custkey AS Codigo_Unico, c.c_name, n.n_name AS Provincia, r.r_name AS Departamento, c.c_mktsegment,
       c.c_acctbal, sw.Fecha_Fin_Swap, sw.value, tss.Fecha_TSS, tss.value_tss
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN sw ON sw.user_id = c.c_custkey LEFT JOIN tss ON tss.user_id = c.c_custkey"""


@register("site_enrich", f"""
WITH s AS ({SQL_SITES})
SELECT o.o_orderkey, o.o_custkey AS Codigo_Unico, o.o_orderdate, o.o_totalprice AS value,
  s.c_name, s.Provincia, s.Departamento, s.c_mktsegment, s.c_acctbal, s.Fecha_Fin_Swap, s.value AS value_sitios,
  s.Fecha_TSS, s.value_tss
FROM orders o LEFT JOIN s ON o.o_custkey = s.Codigo_Unico""")
def q_site_enrich(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("Codigo_Unico"), "o_orderdate",
                                         F.col("o_totalprice").alias("value"))
    return joins.join_suffix(o, sites_table(spark, d), "Codigo_Unico", suffix="_sitios")


# P12 / P13 / A8 -------------------------------------------------------------------

@register("membership_range", """
SELECT o_orderkey, o_orderdate,
  CASE WHEN EXISTS (SELECT 1 FROM lineitem l WHERE l.l_returnflag = 'R' AND l.l_orderkey = o.o_orderkey)
       THEN 'SI' ELSE 'NO' END AS EN_TDE,
  CASE WHEN o_orderdate BETWEEN (SELECT min(l_shipdate) FROM lineitem WHERE l_returnflag = 'R')
                            AND (SELECT max(l_shipdate) FROM lineitem WHERE l_returnflag = 'R')
       THEN 'en_rango' ELSE '' END AS en_rango
FROM orders o""")
def q_membership_range(spark: SparkSession, d: str) -> DataFrame:
    """External activity list = returned lines: is the order in it, and was
    it created inside the list's booking period (scalar subqueries)."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    ext = table(spark, d, "lineitem").where(F.col("l_returnflag") == "R")
    o = joins.flag_in(o, "o_orderkey", ext, "l_orderkey", "EN_TDE")
    lo = ext.agg(F.min("l_shipdate")).scalar()
    hi = ext.agg(F.max("l_shipdate")).scalar()
    return o.withColumn("en_rango", rules.in_range_flag("o_orderdate", lo, hi))


# P10 ----------------------------------------------------------------------------

def _sql_case(col: str, mapping: dict[str, str]) -> str:
    return "CASE " + col + " " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


def _sql_conflict(o: str, t: str) -> str:
    parts = []
    for ostat, tstats, label in config.STATUS_CONFLICT_RULES:
        lst = ", ".join(f"'{x}'" for x in tstats)
        parts.append(f"WHEN {o} = '{ostat}' AND {t} IN ({lst}) THEN '{label}'")
    return "CASE " + " ".join(parts) + " ELSE '' END"


@register("status_conflict", f"""
WITH t1 AS (SELECT * FROM ({SQL_TOP3}) s WHERE Orden = 1),
x AS (SELECT o.o_orderkey, {_sql_case('o.o_orderstatus', config.ORDER_STATUS_ROLE)} AS Estado_TOA,
             {_sql_case('t1.l_returnflag', config.TASK_STATUS_ROLE)} AS Estado_1
      FROM orders o LEFT JOIN t1 ON o.o_orderkey = t1.l_orderkey)
SELECT o_orderkey, Estado_TOA, Estado_1, {_sql_conflict('Estado_TOA', 'Estado_1')} AS Etiqueta FROM x""")
def q_status_conflict(spark: SparkSession, d: str) -> DataFrame:
    t1 = top3(spark, d).where(F.col("Orden") == 1).select("l_orderkey", "l_returnflag")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    x = o.join(t1, o.o_orderkey == t1.l_orderkey, "left")
    x = x.select("o_orderkey", roles.order_status(F.col("o_orderstatus")).alias("Estado_TOA"),
                 roles.task_status(F.col("l_returnflag")).alias("Estado_1"))
    return x.withColumn("Etiqueta", rules.status_conflict("Estado_TOA", "Estado_1"))


# S9 / P6 / P9 / C14 / C8 ------------------------------------------------------------

PART_VENDORS = ["bolt", "gear"]


@register("vendor_extract", """
WITH p AS (SELECT *, CASE WHEN p_type = 'ECONOMY' THEN upper(p_name) ELSE p_name END AS Bucket FROM part),
v AS (SELECT * FROM (VALUES ('bolt'), ('gear')) t(vendor))
SELECT v.vendor, p.p_partkey, p.Bucket,
  CASE WHEN p.p_brand IS NULL OR p.p_brand IN ('nan', 'None') THEN '' ELSE p.p_brand END AS p_brand,
  CASE WHEN p.p_size IS NULL OR p.p_size = 0 THEN '' ELSE CAST(p.p_size AS VARCHAR) END AS p_size,
  CASE WHEN contains(lower(p.Bucket), 'bolt') THEN 'bolt' WHEN contains(lower(p.Bucket), 'gear') THEN 'gear'
       ELSE '' END AS Empresa,
  CASE WHEN contains(p.Bucket, 'bolt') OR contains(p.Bucket, 'gear') THEN 'FLM' ELSE 'TDP' END AS Responsable
FROM p JOIN v ON contains(lower(p.Bucket), v.vendor)""")
def q_vendor_extract(spark: SparkSession, d: str) -> DataFrame:
    """One extract row per vendor named in the bucket (a row naming both
    vendors goes to both); vendor label case-insensitive, responsible party
    case-sensitive; placeholders blanked; internal columns dropped."""
    from fieldops.functions.clean import blank_placeholders, drop_if
    p = table(spark, d, "part")
    p = p.withColumn("Bucket", F.when(F.col("p_type") == "ECONOMY", F.upper("p_name")).otherwise(F.col("p_name")))
    p = p.withColumn("Empresa", rules.vendor("Bucket", PART_VENDORS))
    p = p.withColumn("Responsable", rules.responsible("Bucket", PART_VENDORS))
    vend = F.filter(F.array(*[F.lit(v) for v in PART_VENDORS]), lambda v: F.lower(F.col("Bucket")).contains(v))
    x = p.withColumn("vendor", F.explode(vend))
    x = drop_if(x, ["p_name", "p_type", "p_retailprice", "Mes"])
    x = blank_placeholders(x, ["p_brand", "p_size"])
    return x.select("vendor", "p_partkey", "Bucket", "p_brand", "p_size", "Empresa", "Responsable")


# P1-P5 ----------------------------------------------------------------------------

def _orders_as_tasks(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return o.select(
        "o_orderkey",
        F.concat(F.when(F.col("o_orderstatus") == "F", F.lit("CM")).when(F.col("o_orderstatus") == "O", F.lit("plm"))
                 .otherwise(F.lit("XX")), F.col("o_orderkey").cast("string")).alias("Task_Id"),
        F.when(F.col("o_totalprice") > 300000, F.lit("PROACTIVO")).when(F.col("o_totalprice") < 50000,
                                                                         F.lit("Abastecimiento"))
        .otherwise(F.lit("Correctivo")).alias("Task_Category"),
        F.nullif(F.col("o_orderpriority"), F.lit("3-MEDIUM")).alias("Cancel_Reason"),
        F.when(F.col("o_orderstatus") == "P", F.lit("canceled")).when(F.col("o_orderstatus") == "F", F.lit("closed"))
        .alias("Task_Status"),
    )


@register("exclude_and_eligible", """
WITH t AS (
  SELECT o_orderkey,
    (CASE WHEN o_orderstatus = 'F' THEN 'CM' WHEN o_orderstatus = 'O' THEN 'plm' ELSE 'XX' END)
      || CAST(o_orderkey AS VARCHAR) AS Task_Id,
    CASE WHEN o_totalprice > 300000 THEN 'PROACTIVO' WHEN o_totalprice < 50000 THEN 'Abastecimiento'
         ELSE 'Correctivo' END AS Task_Category,
    nullif(o_orderpriority, '3-MEDIUM') AS Cancel_Reason,
    CASE WHEN o_orderstatus = 'P' THEN 'canceled' WHEN o_orderstatus = 'F' THEN 'closed' END AS Task_Status
  FROM orders)
SELECT *, CASE WHEN contains(lower(Task_Category), 'abastecimiento')
                AND NOT coalesce(Task_Status = 'canceled', false) THEN 'SI' ELSE 'NO' END AS supply
FROM t
WHERE NOT coalesce(Cancel_Reason IN ('1-URGENT', '5-LOW'), false)
  AND (contains(lower(Task_Id), 'cm') OR (contains(lower(Task_Id), 'plm') AND coalesce(Task_Category = 'PROACTIVO', false)))""")
def q_exclude_and_eligible(spark: SparkSession, d: str) -> DataFrame:
    t = _orders_as_tasks(spark, d)
    t = t.where(rules.exclude_values("Cancel_Reason", ["1-URGENT", "5-LOW"]))
    t = t.where(rules.eligible_task("Task_Id", "Task_Category"))
    return t.withColumn("supply", rules.yes_no(rules.supply_task("Task_Category", "Task_Status")))


# P7 / P8 / P14 / P15 / C15 ------------------------------------------------------------

@register("flags_any", f"""
WITH p AS ({SQL_PIVOT}),
x AS (
  SELECT o.o_orderkey, r.r_name, n.n_name,
    CASE WHEN o.o_orderpriority = '1-URGENT' THEN 'Mantenimiento PROACTIVO' ELSE o.o_orderpriority END AS notas,
    p.l_returnflag_1, p.l_returnflag_2, p.l_returnflag_3, p.l_shipdate_1, p.l_shipdate_2, p.l_shipdate_3,
    a.p_name AS n1, b.p_name AS n2, c.p_name AS n3
  FROM orders o LEFT JOIN customer cu ON o.o_custkey = cu.c_custkey
  LEFT JOIN nation n ON cu.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN p ON o.o_orderkey = p.l_orderkey
  LEFT JOIN part a ON p.l_partkey_1 = a.p_partkey LEFT JOIN part b ON p.l_partkey_2 = b.p_partkey
  LEFT JOIN part c ON p.l_partkey_3 = c.p_partkey),
y AS (
  SELECT o_orderkey,
    CASE WHEN coalesce(r_name = 'AMERICA', false) OR coalesce(n_name = 'PERU', false) THEN 'MB' ELSE '' END
      AS Marcha_Blanca,
    CASE WHEN contains(lower(coalesce(notas, '')), 'proactivo') THEN 'Proactivo' ELSE '' END AS Proactivo,
    CASE WHEN (coalesce(l_returnflag_1 = 'R', false) AND contains(upper(coalesce(n1, '')), 'AC'))
           OR (coalesce(l_returnflag_2 = 'R', false) AND contains(upper(coalesce(n2, '')), 'AC'))
           OR (coalesce(l_returnflag_3 = 'R', false) AND contains(upper(coalesce(n3, '')), 'AC'))
         THEN 'Si' ELSE 'No' END AS Fallo_AC,
    CASE WHEN coalesce(l_shipdate_1, l_shipdate_2, l_shipdate_3) IS NOT NULL THEN 'Si' ELSE 'No' END AS Tecnico_llego
  FROM x)
SELECT *, CASE WHEN Fallo_AC = 'Si' OR Tecnico_llego = 'Si' OR Proactivo = 'Proactivo' THEN 'Si' ELSE 'No' END
  AS Atencion FROM y""")
def q_flags_any(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    cu = table(spark, d, "customer")
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    p = pivot3(spark, d)
    p = slots.join_slots(p, "l_orderkey", ["l_partkey_1", "l_partkey_2", "l_partkey_3"], table(spark, d, "part"),
                         "p_partkey", ["p_name"])
    x = (o.join(cu, o.o_custkey == cu.c_custkey, "left").join(n, cu.c_nationkey == n.n_nationkey, "left")
         .join(r, n.n_regionkey == r.r_regionkey, "left").join(p, o.o_orderkey == p.l_orderkey, "left"))
    notas = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("Mantenimiento PROACTIVO")).otherwise(
        F.col("o_orderpriority"))
    spec = [F.when(F.col(f"l_returnflag_{i}") == "R", F.lit(config.AC_SPECIALITY)) for i in (1, 2, 3)]
    y = x.select(
        "o_orderkey",
        rules.soft_launch("r_name", "n_name", dept_value="AMERICA", prov_value="PERU").alias("Marcha_Blanca"),
        rules.proactive(notas).alias("Proactivo"),
        rules.ac_fault(spec, [F.col(f"p_name_{i}") for i in (1, 2, 3)]).alias("Fallo_AC"),
        rules.any_present("l_shipdate_1", "l_shipdate_2", "l_shipdate_3").alias("Tecnico_llego"),
    )
    return y.withColumn("Atencion", rules.any_true(F.col("Fallo_AC") == "Si", F.col("Tecnico_llego") == "Si",
                                                   F.col("Proactivo") == config.L_PROACTIVE))


# D1 / D3 / D4 ---------------------------------------------------------------------

@register("days_since", """
WITH x AS (SELECT l.l_orderkey, l.l_linenumber, l.l_partkey,
             date_diff('microsecond', o.o_orderdate, l.l_shipdate) AS us
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN floor(us / 86400000000.0::DOUBLE) > 0 THEN CAST(floor(us / 86400000000.0::DOUBLE) AS BIGINT) END AS dias,
  us / 60000000.0::DOUBLE AS minutos, us / 3600000000.0::DOUBLE AS horas
FROM x""")
def q_days_since(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    x = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    return x.select("l_orderkey", "l_linenumber", "l_partkey",
                    rules.days_since("o_orderdate", "l_shipdate").alias("dias"),
                    rules.minutes_between("o_orderdate", "l_shipdate").alias("minutos"),
                    rules.hours_between("o_orderdate", "l_shipdate").alias("horas"))


# D5 / D6 ---------------------------------------------------------------------------

AS_OF = "2024-01-31 00:00:00"


@register("open_age_band", f"""
WITH x AS (SELECT event_id,
             CASE event_type WHEN 'purchase' THEN 'Completado' WHEN 'signup' THEN 'Cancelado' ELSE 'Pendiente' END
               AS Estado_TOA, ts FROM events),
y AS (SELECT event_id, Estado_TOA,
        CASE WHEN Estado_TOA NOT IN ('Completado', 'Cancelado')
             THEN date_diff('microsecond', ts, TIMESTAMP '{AS_OF}') / 3600000000.0::DOUBLE END AS horas_abierto
      FROM x)
SELECT *, CASE WHEN horas_abierto BETWEEN 0.000001 AND 3 THEN 'verde'
               WHEN horas_abierto > 3 AND horas_abierto <= 6 THEN 'amarillo'
               WHEN horas_abierto > 6 THEN 'rojo' ELSE '' END AS semaforo
FROM y""")
def q_open_age_band(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    status = (F.when(F.col("event_type") == "purchase", F.lit("Completado"))
              .when(F.col("event_type") == "signup", F.lit("Cancelado")).otherwise(F.lit("Pendiente")))
    x = e.select("event_id", status.alias("Estado_TOA"), "ts")
    as_of = F.lit(AS_OF).cast("timestamp_ntz")
    x = x.withColumn("horas_abierto", rules.open_age_hours("ts", "Estado_TOA", as_of))
    return x.select("event_id", "Estado_TOA", "horas_abierto", rules.age_band("horas_abierto").alias("semaforo"))


# C1 / C2 / C5 / C6 ------------------------------------------------------------------

# Spark rendering patterns matching the fixed input formats, in the same order.
RENDER_PATTERNS = ["dd/MM/yy hh:mm a", "yyyy-MM-dd HH:mm:ss", "dd/MM/yy HH:mm:ss", "dd/MM/yy", "yyyy-MM-dd HH:mm",
                   "dd/MM/yyyy hh:mm a", "dd/MM/yyyy HH:mm"]


def rendered_dates(spark: SparkSession, d: str) -> DataFrame:
    """Order dates (plus a time of day taken from the key) written as text in
    one of the seven feed formats, a null token or junk, chosen by key."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    t = F.timestamp_add("MINUTE", F.col("o_orderkey") % 1440, F.col("o_orderdate"))
    sel = F.col("o_orderkey") % 9
    raw = F.when(sel == 7, F.lit("-")).when(sel == 8, F.concat(F.lit("junk "), F.col("o_orderkey").cast("string")))
    for i, pat in enumerate(RENDER_PATTERNS):
        raw = raw.when(sel == i, F.date_format(t, pat))
    return o.select("o_orderkey", raw.alias("raw"),
                    F.date_format(F.col("o_orderdate"), "yyyy/MM/dd").alias("raw_slash"))


def _sql_rendered() -> str:
    fmts = [py for py, _ in config.DATETIME_FORMATS]
    whens = " ".join(f"WHEN o_orderkey % 9 = {i} THEN strftime(t, '{f}')" for i, f in enumerate(fmts))
    return f"""
SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 7 THEN '-' WHEN o_orderkey % 9 = 8 THEN 'junk ' || CAST(o_orderkey AS VARCHAR)
  {whens} END AS raw, strftime(o_orderdate, '%Y/%m/%d') AS raw_slash
FROM (SELECT o_orderkey, o_orderdate, o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS BIGINT)) AS t FROM orders) s"""


SQL_RENDERED = _sql_rendered()
SQL_FORMATS = "[" + ", ".join(f"'{py}'" for py, _ in config.DATETIME_FORMATS) + "]"
SQL_PARSE = ("try_strptime(regexp_replace(CASE WHEN {c} IN ('', '-', 'no se registro ?') THEN NULL ELSE {c} END,"
             " '^\\s+|\\s+$', '', 'g'), " + SQL_FORMATS + ")")


@register("parse_dates", f"""
WITH r AS ({SQL_RENDERED})
SELECT o_orderkey, raw, {SQL_PARSE.format(c='raw')} AS parsed,
  strftime({SQL_PARSE.format(c='raw')}, '%Y-%m-%d %H:%M:%S') AS parsed_text
FROM r""")
def q_parse_dates(spark: SparkSession, d: str) -> DataFrame:
    from fieldops.functions.clean import fmt_ts, parse_ts
    r = rendered_dates(spark, d)
    return r.select("o_orderkey", "raw", parse_ts("raw").alias("parsed"), fmt_ts(parse_ts("raw")).alias("parsed_text"))


# C3 / O3 ----------------------------------------------------------------------------

@register("unparsed_report", f"""
WITH r AS ({SQL_RENDERED}),
f AS (SELECT 'raw' AS "column", raw AS raw, o_orderkey FROM r
      WHERE CASE WHEN raw IN ('', '-', 'no se registro ?') THEN NULL ELSE raw END IS NOT NULL
        AND {SQL_PARSE.format(c='raw')} IS NULL
      UNION ALL
      SELECT 'raw_slash', raw_slash, o_orderkey FROM r
      WHERE CASE WHEN raw_slash IN ('', '-', 'no se registro ?') THEN NULL ELSE raw_slash END IS NOT NULL
        AND {SQL_PARSE.format(c='raw_slash')} IS NULL)
SELECT "column", raw, rn FROM (
  SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY o_orderkey, raw) AS rn FROM f) t
WHERE rn <= 20""")
def q_unparsed_report(spark: SparkSession, d: str) -> DataFrame:
    from fieldops.functions.clean import unparsed_report
    return unparsed_report(rendered_dates(spark, d), ["raw", "raw_slash"], "o_orderkey", limit=20)


# C4 ----------------------------------------------------------------------------------

CONTRACT = {"qty": "INTEGER", "price": "REAL", "ship_day": "DATE", "flag": "TEXT", "ship_ts": "DATETIME"}


@register("contract_cast", f"""
WITH t AS (
  SELECT l_orderkey, l_linenumber, CAST(l_quantity / 2 AS VARCHAR) AS qty,
    CASE WHEN l_linenumber = 3 THEN CAST(l_extendedprice AS VARCHAR) || 'd' ELSE CAST(l_extendedprice AS VARCHAR) END
      AS price,
    strftime(l_shipdate, '%Y-%m-%d') AS ship_day, l_returnflag AS flag,
    strftime(l_shipdate + to_minutes(CAST(l_partkey % 1440 AS BIGINT)), '%d/%m/%Y %H:%M') AS ship_ts
  FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST(round_even(TRY_CAST(qty AS DOUBLE), 0) AS BIGINT) AS qty,
  TRY_CAST(price AS DOUBLE) AS price, TRY_CAST(ship_day AS DATE) AS ship_day, flag,
  {SQL_PARSE.format(c='ship_ts')} AS ship_ts
FROM t""")
def q_contract_cast(spark: SparkSession, d: str) -> DataFrame:
    """Lines rendered to text as a feed delivers them, then typed by contract
    (half-even integer rounding, junk numbers to NULL)."""
    from fieldops.functions.clean import apply_contract
    li = table(spark, d, "lineitem")
    txt = li.select(
        "l_orderkey", "l_linenumber",
        (F.col("l_quantity") / 2).cast("string").alias("qty"),
        F.when(F.col("l_linenumber") == 3, F.concat(F.col("l_extendedprice").cast("string"), F.lit("d")))
        .otherwise(F.col("l_extendedprice").cast("string")).alias("price"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship_day"),
        F.col("l_returnflag").alias("flag"),
        F.date_format(F.timestamp_add("MINUTE", F.col("l_partkey") % 1440, F.col("l_shipdate")),
                      "dd/MM/yyyy HH:mm").alias("ship_ts"))
    return apply_contract(txt, CONTRACT)


# C9 - C13 / C16 ---------------------------------------------------------------------

@register("canon_ids", """
WITH t AS (
  SELECT o_orderkey,
    CASE o_orderkey % 4 WHEN 0 THEN CAST(o_orderkey AS VARCHAR) || '.0'
                        WHEN 1 THEN CAST(o_orderkey * 100003 AS VARCHAR)
                        WHEN 2 THEN 'SIOM-' || CAST(o_orderkey AS VARCHAR) ELSE '' END AS raw_id,
    ' PET' || CAST(o_orderkey AS VARCHAR) || '-01 ' AS peticion,
    CASE WHEN o_orderstatus = 'F' THEN 'INC' || lpad(CAST(o_orderkey AS VARCHAR), 7, '0')
         ELSE 'TT' || CAST(o_orderkey AS VARCHAR) END AS ticket,
    CASE WHEN o_orderstatus = 'P' THEN 'Cancelado (antiguo)' WHEN o_orderstatus = 'F' THEN 'Completado'
         ELSE 'Pendiente' END AS estado_raw,
    o_custkey, o_orderdate
  FROM orders),
c AS (
  SELECT *,
    CASE WHEN raw_id IS NULL OR raw_id = '' THEN NULL
         WHEN regexp_matches(raw_id, '^\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*$')
           THEN (CASE WHEN length(CAST(CAST(TRY_CAST(raw_id AS DOUBLE) AS BIGINT) AS VARCHAR)) < 8
                      THEN lpad(CAST(CAST(TRY_CAST(raw_id AS DOUBLE) AS BIGINT) AS VARCHAR), 8, '0')
                      ELSE CAST(CAST(TRY_CAST(raw_id AS DOUBLE) AS BIGINT) AS VARCHAR) END)
         ELSE raw_id END AS Nro_TOA,
    regexp_replace(trim(peticion), '-\\d{2}$', '') AS Numero_Peticion
  FROM t)
SELECT o_orderkey, raw_id, Nro_TOA, coalesce(length(Nro_TOA) = 8, false) AS largo_8, Numero_Peticion,
  CASE WHEN regexp_matches(ticket, '^INC\\d{7}') THEN ticket ELSE Numero_Peticion END AS Clave_Remedy,
  trim(replace(estado_raw, '(antiguo)', '')) AS Estado_TOA,
  coalesce(CAST(o_custkey AS VARCHAR), '') || '_' || coalesce(CAST(o_orderdate AS VARCHAR), '') AS Index
FROM c""")
def q_canon_ids(spark: SparkSession, d: str) -> DataFrame:
    from fieldops.functions import clean
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    raw = (F.when(k % 4 == 0, F.concat(k.cast("string"), F.lit(".0"))).when(k % 4 == 1, (k * 100003).cast("string"))
           .when(k % 4 == 2, F.concat(F.lit("SIOM-"), k.cast("string"))).otherwise(F.lit("")))
    t = o.select(
        "o_orderkey", raw.alias("raw_id"),
        F.concat(F.lit(" PET"), k.cast("string"), F.lit("-01 ")).alias("peticion"),
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("INC"), zero_fill(k.cast("string"), 7)))
        .otherwise(F.concat(F.lit("TT"), k.cast("string"))).alias("ticket"),
        F.when(F.col("o_orderstatus") == "P", F.lit("Cancelado (antiguo)"))
        .when(F.col("o_orderstatus") == "F", F.lit("Completado")).otherwise(F.lit("Pendiente")).alias("estado_raw"),
        "o_custkey", "o_orderdate")
    t = t.withColumns({"Nro_TOA": clean.canon_id("raw_id"), "Numero_Peticion": clean.strip_suffix("peticion")})
    return t.select(
        "o_orderkey", "raw_id", "Nro_TOA", F.coalesce(clean.fixed_length("Nro_TOA", 8), F.lit(False)).alias("largo_8"),
        "Numero_Peticion", clean.incident_key("ticket", "Numero_Peticion").alias("Clave_Remedy"),
        clean.strip_literal("estado_raw", "(antiguo)").alias("Estado_TOA"),
        clean.composite_key("o_custkey", "o_orderdate").alias("Index"))


# C7 / C8 / O1 -----------------------------------------------------------------------

REPORT_MAP = {"o_orderkey": "ID_TOA", "o_orderdate": "Creacion_TOA", "o_orderstatus": "Estado_TOA",
              "o_custkey": "Site_ID", "Prioridad_TOA": "Prioridad", "o_totalprice": "Monto"}


@register("project_report", """
SELECT o_orderkey AS ID_TOA, o_orderdate AS Creacion_TOA, o_orderstatus AS Estado_TOA, o_custkey AS Site_ID,
  o_orderpriority AS Prioridad, o_totalprice AS Monto
FROM orders ORDER BY Creacion_TOA DESC NULLS LAST, ID_TOA""")
def q_project_report(spark: SparkSession, d: str) -> DataFrame:
    from fieldops.functions.clean import drop_if, normalize_names, project_as
    o = table(spark, d, "orders").withColumnRenamed("o_orderpriority", "Prioridad TOA").withColumn("Mes", F.lit(1))
    o = drop_if(normalize_names(o), ["Mes"])
    return project_as(o, REPORT_MAP).orderBy(F.col("Creacion_TOA").desc_nulls_last(), F.col("ID_TOA"))


# A9 / S11 / A10 ---------------------------------------------------------------------

@register("duplicate_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def q_duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    return state.duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("table_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in
    ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
     "pages", "benchmark", "labels", "conversations"]))
def q_table_counts(spark: SparkSession, d: str) -> DataFrame:
    from fieldops.sources.io import table_counts
    return table_counts(spark, d)


@register("stage_metrics", """
SELECT 'raw' AS stage, count(*) AS rows, count(user_id) AS nonnull_user_id, count(value) AS nonnull_value FROM events
UNION ALL
SELECT 'incidents', count(*), count(user_id), count(value) FROM events WHERE event_type = 'error'
UNION ALL
SELECT 'since_cutoff', count(*), count(user_id), count(value) FROM events
WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-08 00:00:00'""")
def q_stage_metrics(spark: SparkSession, d: str) -> DataFrame:
    ev = table(spark, d, "events")
    inc = ev.where(F.col("event_type") == "error")
    cut = inc.where(rules.since("ts", "2024-01-08 00:00:00"))
    cols = ["user_id", "value"]
    return state.union_all(state.stage_metrics(ev, "raw", cols), state.stage_metrics(inc, "incidents", cols),
                           state.stage_metrics(cut, "since_cutoff", cols))


# A12 / P1 -----------------------------------------------------------------------------

@register("review_queue", """
WITH s AS (SELECT doc_id AS Nro_TOA, text AS Notas, CAST(NULL AS VARCHAR) AS Confirmado, 1 AS fuente FROM documents
           WHERE lower(text) LIKE '%test%' OR lower(text) LIKE '%ticket de prueba%'),
h AS (SELECT doc_id, NULL, CASE WHEN quality = 1 THEN 'SI' ELSE 'NO' END, 2 FROM labels),
e AS (SELECT doc_id, 'Error al pasar de Autin', 'SI', 3 FROM labels WHERE toxic = 1),
u AS (SELECT * FROM s UNION ALL SELECT * FROM h UNION ALL SELECT * FROM e)
SELECT Nro_TOA, Notas, Confirmado, fuente FROM (
  SELECT *, row_number() OVER (PARTITION BY Nro_TOA ORDER BY fuente DESC) AS rn FROM u) t WHERE rn = 1""")
def q_review_queue(spark: SparkSession, d: str) -> DataFrame:
    """Test tickets: suspects from notes, the confirmation sheet (labels) and
    the error list (toxic labels); a later source wins per ticket."""
    from fieldops.functions.rules import icontains
    doc = table(spark, d, "documents")
    lab = table(spark, d, "labels")
    sus_cond = F.lit(False)
    for m in config.TEST_MARKERS:
        sus_cond = sus_cond | icontains("text", m)
    suspects = doc.where(sus_cond).select(F.col("doc_id").alias("Nro_TOA"), F.col("text").alias("Notas"),
                                          F.lit(None).cast("string").alias("Confirmado"))
    sheet = lab.select(F.col("doc_id").alias("Nro_TOA"), F.lit(None).cast("string").alias("Notas"),
                       F.when(F.col("quality") == 1, F.lit("SI")).otherwise(F.lit("NO")).alias("Confirmado"))
    errors = lab.where(F.col("toxic") == 1).select(F.col("doc_id").alias("Nro_TOA"),
                                                   F.lit(config.ERROR_LIST_NOTE).alias("Notas"),
                                                   F.lit("SI").alias("Confirmado"))
    merged, _confirmed, _pending = state.review_queue(suspects, sheet, errors, "Nro_TOA")
    return merged.withColumnRenamed("_src", "fuente")


# T1 - T3 ------------------------------------------------------------------------------

def alarm_inputs(spark: SparkSession, d: str):
    """Incident summaries and notes written from part rows (the driver text has
    no alarms): a padded pipe segment (rejected untrimmed), a tight segment, an
    AC-failure segment, or no pipe; every second row has an 'Alarma:' line
    ending in CRLF.  Catalogue = names of the larger parts with their type."""
    p = table(spark, d, "part")
    k = F.col("p_size") % 4
    resumen = (F.when(k == 0, F.concat(F.lit("INC"), F.col("p_partkey").cast("string"), F.lit(" | "), F.col("p_name"),
                                       F.lit(" | "), F.col("p_type")))
               .when(k == 1, F.concat(F.lit("INC|"), F.col("p_name"), F.lit("|"), F.col("p_type")))
               .when(k == 2, F.concat(F.col("p_name"), F.lit(" | falla ac "), F.lower("p_type")))
               .otherwise(F.col("p_name")))
    notas = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("Alarma: "), F.upper("p_name"), F.lit("\r\nfin"))) \
        .otherwise(F.lit("sin alarma"))
    inc = p.select("p_partkey", resumen.alias("Resumen"), notas.alias("Notas"))
    cat = p.where(F.col("p_size") > 25).select(F.col("p_name").alias("Alarma"), F.col("p_type").alias("Tipo"))
    return inc, cat


@register("alarm_rule", """
WITH p AS (
  SELECT p_partkey,
    CASE p_size % 4 WHEN 0 THEN 'INC' || CAST(p_partkey AS VARCHAR) || ' | ' || p_name || ' | ' || p_type
                    WHEN 1 THEN 'INC|' || p_name || '|' || p_type
                    WHEN 2 THEN p_name || ' | falla ac ' || lower(p_type) ELSE p_name END AS resumen,
    CASE WHEN p_size % 2 = 0 THEN 'Alarma: ' || upper(p_name) || chr(13) || chr(10) || 'fin' ELSE 'sin alarma' END
      AS notas
  FROM part),
cat AS (SELECT lower(regexp_replace(p_name, '^\\s+|\\s+$', '', 'g')) AS k, min(p_type) AS tipo
        FROM part WHERE p_size > 25 GROUP BY 1),
s AS (SELECT *, lower(nullif(regexp_extract(resumen, '\\|([^|]+)', 1), '')) AS seg FROM p),
a AS (SELECT p_partkey, notas,
        CASE WHEN seg IN (SELECT k FROM cat)
               OR (contains(seg, 'ac') AND (contains(seg, 'failure') OR contains(seg, 'fallo') OR contains(seg, 'falla')))
             THEN seg END AS acc FROM s),
b AS (SELECT p_partkey,
        coalesce(regexp_replace(lower(coalesce(acc, nullif(regexp_extract(notas, 'Alarma: ([^\\n]*?)\\n', 1), ''))),
                                '^\\s+|\\s+$', '', 'g'), '') AS alarma FROM a)
SELECT b.p_partkey,
  CASE WHEN alarma = '' THEN 'alarma no identificada' ELSE alarma END AS Alarma,
  CASE WHEN alarma = '' THEN 'alarma no identificada'
       WHEN contains(alarma, 'ac') AND (contains(alarma, 'failure') OR contains(alarma, 'fallo') OR contains(alarma, 'falla'))
         THEN 'TOTAL'
       WHEN cat.tipo IS NULL THEN 'tipo no identificado' ELSE cat.tipo END AS Tipo
FROM b LEFT JOIN cat ON b.alarma = cat.k""")
def q_alarm_rule(spark: SparkSession, d: str) -> DataFrame:
    from fieldops.functions.text import alarm_catalogue, identify_alarms
    inc, cat = alarm_inputs(spark, d)
    out = identify_alarms(inc, "Resumen", "Notas", alarm_catalogue(cat))
    return out.select("p_partkey", "Alarma", "Tipo")


# T5 / T6 / L6 ----------------------------------------------------------------------------

def notes_with_orders(spark: SparkSession, d: str) -> DataFrame:
    doc = table(spark, d, "documents").select("doc_id", "text")
    k = F.col("doc_id")
    sel = k % 5
    suffix = (F.when(sel == 0, F.concat(F.lit("TOA: "), F.lpad(((k * 13) % 20000).cast("string"), 8, "0")))
              .when(sel == 1, F.concat(F.lit("Siom:"), F.lpad(((k * 7) % 20000).cast("string"), 9, "9")))
              .when(sel == 2, F.concat(F.lit("Circuito: "), k.cast("string")))
              .when(sel == 3, F.concat(F.lit("CD"), F.lpad(k.cast("string"), 6, "0"), F.lit(" TOA: "),
                                       F.lpad((k % 15000).cast("string"), 8, "0")))
              .otherwise(F.lit("")))
    return doc.select("doc_id", F.concat(F.col("text"), F.lit("\n"), suffix).alias("Notas"))


@register("notes_rules", f"""
WITH n AS (
  SELECT doc_id, text || chr(10) || CASE doc_id % 5
      WHEN 0 THEN 'TOA: ' || lpad(CAST((doc_id * 13) % 20000 AS VARCHAR), 8, '0')
      WHEN 1 THEN 'Siom:' || lpad(CAST((doc_id * 7) % 20000 AS VARCHAR), 9, '9')
      WHEN 2 THEN 'Circuito: ' || CAST(doc_id AS VARCHAR)
      WHEN 3 THEN 'CD' || lpad(CAST(doc_id AS VARCHAR), 6, '0') || ' TOA: ' || lpad(CAST(doc_id % 15000 AS VARCHAR), 8, '0')
      ELSE '' END AS notas
  FROM documents),
t AS (SELECT doc_id,
        coalesce(nullif(regexp_extract(regexp_replace(regexp_extract(notas, '(?i)(?:TOA:|SIOM:)([^\\n]*?)(?:\\n|$)', 1),
                 '^\\s+|\\s+$', '', 'g'), '(\\d{{8}})', 1), ''), 'sin TOA en notas') AS TOA_notas,
        coalesce(regexp_matches(notas, 'CD\\d{{6}}|CR\\d{{5}}|Circuito:|CIRCUITO:'), false) AS corp
      FROM n),
m AS (SELECT t.*, o.o_orderkey AS Nro_TOA, o.o_custkey AS site,
        {_sql_case('c.c_mktsegment', config.SEGMENT_PROVIDER_ROLE)} AS prov
      FROM t LEFT JOIN orders o ON lpad(CAST(o.o_orderkey AS VARCHAR), 8, '0') = t.TOA_notas
      LEFT JOIN customer c ON o.o_custkey = c.c_custkey),
r AS (SELECT *, CASE WHEN corp THEN 'Caso Empresa' WHEN Nro_TOA IS NOT NULL THEN 'Si tiene TOA'
                     ELSE 'TOA no identificado' END AS r1 FROM m)
SELECT doc_id, CASE WHEN corp THEN 'SI' ELSE 'NO' END AS Caso_Empresa, TOA_notas, Nro_TOA,
  CASE WHEN NOT coalesce(prov IN ('HUAWEI', 'COMFICA'), false) AND site IS NOT NULL AND r1 <> 'Si tiene TOA'
       THEN 'Sitio corresponde a Telefonica' ELSE r1 END AS Razones_Sin_TOA
FROM r""")
def q_notes_rules(spark: SparkSession, d: str) -> DataFrame:
    """Notes name an order after 'TOA:'/'SIOM:' or look like a corporate
    case; the order is looked up (8-digit zero-filled key) and the reason for
    a missing order decided, with the site's provider override."""
    from fieldops.functions.text import corporate_case, order_in_notes
    n = notes_with_orders(spark, d)
    n = n.withColumns({"TOA_notas": order_in_notes("Notas"), "_corp": corporate_case("Notas")})
    o = table(spark, d, "orders").select(zero_fill(F.col("o_orderkey").cast("string"), 8).alias("_k"),
                                         F.col("o_orderkey").alias("Nro_TOA"), F.col("o_custkey").alias("_site"))
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("_site"),
                                           roles.provider(F.col("c_mktsegment")).alias("_prov"))
    x = n.join(o, n.TOA_notas == o._k, "left").join(c, "_site", "left")
    return x.select("doc_id", rules.yes_no(F.col("_corp")).alias("Caso_Empresa"), "TOA_notas", "Nro_TOA",
                    rules.no_order_reason("_corp", "Nro_TOA", "_prov", "_site").alias("Razones_Sin_TOA"))


# T7 - T11 ---------------------------------------------------------------------------------

# Field-report phrases appended to the documents (the driver text has no
# repair vocabulary); chosen by doc_id % 8.
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


def field_texts(spark: SparkSession, d: str) -> DataFrame:
    from fieldops.functions.text import combined_text
    doc = table(spark, d, "documents").select("doc_id", "text")
    phrase = F.element_at(F.array(*[F.lit(p) for p in FIELD_PHRASES]), (F.col("doc_id") % 8 + 1).cast("int"))
    empty = F.lit(None).cast("string")
    return doc.select("doc_id", combined_text([F.col("text"), phrase, empty, empty, empty, empty]).alias("Texto_Comb"))


_W = r"[\p{L}\p{M}\p{Nd}\p{Pc}]"
_NW = r"[^\p{L}\p{M}\p{Nd}\p{Pc}]"
_B = f"(?:^|{_NW})"
_E = f"(?:$|{_NW})"
SQL_DETECT = {
    "ge": (_B + r"(?:no\s+(?:tiene|hay|existe)|sin|ningún(?:a)?|no\s*cuenta\s+con)\s+"
           r"(?:grupo\s+electr[oó]geno|grupo|ge|g\.e)" + _E,
           _B + r"(?:instal|encend|cambi|coloc|dej(?:a|o)|oper|funcion)",
           _B + r"(?:grupo\s+electr[oó]geno|ge|g\.e|grupo)" + _E),
    "baterias": (None, _B + r"(?:coloc|cambi|instal|mid|recarg|carg|respald|revis|verific)",
                 _B + r"(?:b{1,2}[aá]ter[ií]a(?:s)?)" + _E),
    "itm": (None, _B + r"(?:cambi|ajust|reajust|reposicion)", _B + r"(?:itm)" + _E),
    "breakers": (None, _B + r"(?:sub[ií]o|levant(?:o|a)|ajust(?:o|ó)|activ|arregl(?:o|ó))",
                 _B + r"(?:breaker|breacker|breackers|braker|bracker|brackers|breker|breckers)" + _E),
}


def _sql_detector(name: str, col: str) -> str:
    neg, verb, noun = SQL_DETECT[name]
    cond = f"regexp_matches(lower({col}), '{verb}') AND regexp_matches(lower({col}), '{noun}')"
    if neg:
        cond += f" AND NOT regexp_matches(lower({col}), '{neg}')"
    return f"CASE WHEN coalesce({col}, '') = '' THEN 'NO' WHEN {cond} THEN 'SI' ELSE 'NO' END"


def _sql_field_texts() -> str:
    arr = "[" + ", ".join("'" + p.replace("'", "''") + "'" for p in FIELD_PHRASES) + "]"
    return (f"SELECT doc_id, concat_ws('. ', coalesce(text, ''), {arr}[doc_id % 8 + 1], '', '', '', '') AS Texto_Comb "
            f"FROM documents")


@register("text_detectors", f"""
WITH t AS ({_sql_field_texts()})
SELECT doc_id, {_sql_detector('ge', 'Texto_Comb')} AS accion_ge, {_sql_detector('baterias', 'Texto_Comb')} AS accion_baterias,
  {_sql_detector('itm', 'Texto_Comb')} AS accion_itm, {_sql_detector('breakers', 'Texto_Comb')} AS accion_breakers,
  length(Texto_Comb) AS largo
FROM t""")
def q_text_detectors(spark: SparkSession, d: str) -> DataFrame:
    from fieldops.functions.text import detector
    t = field_texts(spark, d)
    return t.select("doc_id", detector("ge", "Texto_Comb").alias("accion_ge"),
                    detector("baterias", "Texto_Comb").alias("accion_baterias"),
                    detector("itm", "Texto_Comb").alias("accion_itm"),
                    detector("breakers", "Texto_Comb").alias("accion_breakers"),
                    F.length("Texto_Comb").cast("bigint").alias("largo"))


# L1 / L2 / D4 -----------------------------------------------------------------------------

SQL_TIER = _sql_case("c.c_mktsegment", config.SEGMENT_TIER_ROLE)
SQL_TARGET = ("CASE trim(priorizacion) " + " ".join(f"WHEN '{k}' THEN {float(v)}::DOUBLE"
                                                      for k, v in config.TIER_TARGET_HOURS.items()) + " END")


def incidents_with_tier(spark: SparkSession, d: str) -> DataFrame:
    inc = roles.incidents(spark, d).select("event_id", "user_id", "ts", "value")
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"),
                                           roles.tier(F.col("c_mktsegment")).alias("priorizacion"),
                                           "c_mktsegment", "c_acctbal")
    return inc.join(c, "user_id", "left")


@register("sla_compliance", f"""
WITH e AS ({SQL_ERR}), p AS ({SQL_PUR}),
a AS (SELECT e.event_id, e.user_id, e.ts, p.ts AS reg_ts FROM e ASOF LEFT JOIN p ON e.user_id = p.user_id AND e.ts <= p.ts),
t AS (SELECT a.*, {SQL_TIER} AS priorizacion FROM a LEFT JOIN customer c ON a.user_id = c.c_custkey),
u AS (SELECT *, {SQL_TARGET} AS objetivo_h, date_diff('microsecond', ts, reg_ts) AS us FROM t)
SELECT event_id, user_id, ts, reg_ts, priorizacion, objetivo_h, us / 3600000000.0::DOUBLE AS envio_h,
  CASE WHEN objetivo_h IS NULL THEN 'Sin información Site ID'
       WHEN ts IS NULL OR reg_ts IS NULL THEN 'Sin información TOA'
       WHEN us / 60000000.0::DOUBLE < (objetivo_h + 0.25::DOUBLE) * 60.0::DOUBLE THEN '< del tiempo esperado'
       WHEN us / 60000000.0::DOUBLE > (objetivo_h + 0.75::DOUBLE) * 60.0::DOUBLE THEN '> del tiempo esperado'
       ELSE 'rango correcto' END AS cumplimiento
FROM u""")
def q_sla_compliance(spark: SparkSession, d: str) -> DataFrame:
    """Registration = first purchase of the site at or after the incident
    (forward as-of); target by site tier; compliance band."""
    inc = incidents_with_tier(spark, d).select("event_id", "user_id", "ts", "priorizacion")
    pur = roles.purchases(spark, d).select("user_id", F.col("event_id").alias("reg_id"), F.col("ts").alias("reg_ts"))
    x = joins.asof_join(inc, pur, "user_id", "ts", "reg_ts", ["reg_ts"], right_tiebreak=["reg_id"], strict=False,
                        forward=True)
    x = x.withColumn("objetivo_h", rules.target_hours("priorizacion"))
    return x.select("event_id", "user_id", "ts", "reg_ts", "priorizacion", "objetivo_h",
                    rules.hours_between("ts", "reg_ts").alias("envio_h"),
                    rules.compliance("objetivo_h", "ts", "reg_ts").alias("cumplimiento"))


# A11 / L3 / L4 / P11 ---------------------------------------------------------------------

CUTOFF = "2024-01-08 00:00:00"


def _sql_bins(col: str, outcome: str) -> str:
    parts = [f"WHEN {outcome} = 'Cancelamiento Outlier' THEN 'Cancelamiento Outlier'", f"WHEN {col} IS NULL THEN NULL"]
    parts += [f"WHEN {col} >= {lo} AND {col} < {hi} THEN '{label}'" for lo, hi, label in config.CANCEL_BINS]
    return "CASE " + " ".join(parts) + " ELSE '72+' END"


@register("cancel_outcome", f"""
WITH e AS ({SQL_ERR} AND ts >= TIMESTAMP '{CUTOFF}'), p AS ({SQL_PUR}),
f AS (SELECT e.event_id, e.user_id, e.ts, e.value, p.ts AS next_ts
      FROM e ASOF LEFT JOIN p ON e.user_id = p.user_id AND e.ts < p.ts),
b AS (SELECT f.*, p.ts AS prev_ts FROM f ASOF LEFT JOIN p ON f.user_id = p.user_id AND f.ts > p.ts),
c AS (SELECT b.event_id, b.ts,
        date_diff('microsecond', b.ts, b.next_ts) / 3600000000.0::DOUBLE AS t_autin_1,
        date_diff('microsecond', b.ts, b.prev_ts) / 3600000000.0::DOUBLE AS t_autin_2,
        b.value AS t_autin_3,
        CASE WHEN cu.c_mktsegment = 'BUILDING' THEN cu.c_acctbal / 100.0::DOUBLE END AS t_toa,
        {SQL_TIER.replace('c.c_mktsegment', 'cu.c_mktsegment')} AS priorizacion
      FROM b LEFT JOIN customer cu ON b.user_id = cu.c_custkey),
m AS (SELECT *, list_min(list_filter([t_autin_1, t_autin_2, t_autin_3, t_toa], lambda x: x < 96)) AS t_min,
        {SQL_TARGET} AS objetivo_h FROM c),
o AS (SELECT *, CASE WHEN objetivo_h IS NULL THEN 'Sin información Site ID'
                     WHEN t_min IS NULL AND coalesce(t_autin_1, t_autin_2, t_autin_3, t_toa) IS NULL THEN 'Ticket no cancelado'
                     WHEN t_min IS NULL THEN 'Cancelamiento Outlier'
                     WHEN t_min * 60.0::DOUBLE < (objetivo_h + 0.25::DOUBLE) * 60.0::DOUBLE THEN 'Cancelado antes de rango contención'
                     WHEN t_min * 60.0::DOUBLE > (objetivo_h + 0.75::DOUBLE) * 60.0::DOUBLE THEN 'Cancelado fuera de rango contención'
                     ELSE 'Cancelado en rango contención' END AS error_contencion FROM m)
SELECT event_id, t_autin_1, t_autin_2, t_autin_3, t_toa, t_min, error_contencion,
  {_sql_bins('t_min', 'error_contencion')} AS rango_cancelacion
FROM o""")
def q_cancel_outcome(spark: SparkSession, d: str) -> DataFrame:
    """Incidents since the cut-off; four cancellation gaps (next and previous
    purchase, the event value as hours, the account balance for 'cancelled'
    sites); bounded minimum, outcome and bin."""
    inc = incidents_with_tier(spark, d).where(rules.since("ts", CUTOFF))
    pur = roles.purchases(spark, d).select("user_id", F.col("event_id").alias("pid"), F.col("ts").alias("pts"))
    both = joins.asof_around(inc, pur, "user_id", "ts", "pts", ["pts"], right_tiebreak=["pid"])
    hours = ["t_autin_1", "t_autin_2", "t_autin_3", "t_toa"]
    x = both.select(
        "event_id", "priorizacion",
        rules.hours_between("ts", "next_pts").alias("t_autin_1"),
        rules.hours_between("ts", "prev_pts").alias("t_autin_2"),
        F.col("value").alias("t_autin_3"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") / F.lit(100.0)).alias("t_toa"))
    x = x.withColumns({"t_min": rules.bounded_min(hours), "_target": rules.target_hours("priorizacion")})
    x = x.withColumn("error_contencion", rules.cancel_outcome("_target", "t_min", hours))
    return x.select("event_id", *hours, "t_min", "error_contencion",
                    rules.cancel_bin("t_min", "error_contencion").alias("rango_cancelacion"))


# L5 ------------------------------------------------------------------------------------

@register("swap_relation", f"""
WITH e AS ({SQL_ERR}), s AS ({SQL_SITES})
SELECT e.event_id, e.user_id, e.ts, s.Codigo_Unico AS ID_Sitio, s.Fecha_Fin_Swap,
  CASE WHEN s.Codigo_Unico IS NULL THEN 'Sin info de Sitio'
       WHEN s.Fecha_Fin_Swap IS NOT NULL AND e.ts > s.Fecha_Fin_Swap THEN 'Incidente post SWAP'
       ELSE 'Incidente no relacionado a SWAP' END AS Clasificacion_SWAP
FROM e LEFT JOIN s ON e.user_id = s.Codigo_Unico""")
def q_swap_relation(spark: SparkSession, d: str) -> DataFrame:
    inc = roles.incidents(spark, d).select("event_id", "user_id", "ts")
    s = sites_table(spark, d).select(F.col("Codigo_Unico").alias("ID_Sitio"), "Fecha_Fin_Swap")
    x = inc.join(s, inc.user_id == s.ID_Sitio, "left")
    return x.select("event_id", "user_id", "ts", "ID_Sitio", "Fecha_Fin_Swap",
                    rules.swap_relation("ID_Sitio", "ts", "Fecha_Fin_Swap").alias("Clasificacion_SWAP"))


# Consolidated report ------------------------------------------------------

def state_tables(spark: SparkSession, d: str, cols: list[str] | None = None):
    """Task and pause state tables (W1 output).  The tasks are read several times, so they
    are stored once per run like the original's database tables (``cols`` of them, where the others
    aren't read); the pauses are read once."""
    from fieldops.sources.io import stage_table
    tasks = roles.tasks(spark, d)
    return stage_table(tasks.select(*(cols or tasks.columns)), "tasks"), roles.pauses(spark, d)


def consolidated(spark: SparkSession, d: str) -> DataFrame:
    from fieldops.plans import reports
    tasks, pauses = state_tables(spark, d, reports.TASK_COLS)
    return reports.consolidate(roles.work_orders(spark, d), tasks, pauses,
                               roles.sites(spark, d), roles.confirmed_tests(spark, d), roles.external_activity(spark, d), roles.TOA_DIGITS)


from fieldops.plans.report_sql import consolidated_sql, published_sql, vendor_extracts_sql  # noqa: E402

register("consolidated_report", consolidated_sql())(consolidated)


PUBLISH_AS_OF = "1998-08-03 00:00:00"


@register("published_report", published_sql(PUBLISH_AS_OF))
def q_published_report(spark: SparkSession, d: str) -> DataFrame:
    from fieldops.plans import reports
    return reports.published_report(consolidated(spark, d), F.lit(PUBLISH_AS_OF).cast("timestamp_ntz"))


@register("vendor_extracts", vendor_extracts_sql())
def q_vendor_extracts(spark: SparkSession, d: str) -> DataFrame:
    from fieldops.plans import reports
    return reports.vendor_extracts(consolidated(spark, d))


@register("consolidated_delta", consolidated_sql())
def q_consolidated_delta(spark: SparkSession, d: str) -> DataFrame:
    """The report kept up over three drops: a first load that lacks part of
    every feed's rows, or has earlier ones, then drops that bring them."""
    from fieldops.plans import delta, feeds
    from fieldops.session import scratch_path
    root = scratch_path(spark, "report")
    base, drops = feeds.report_drops(feeds.report_feeds(spark, d))
    delta.build(spark, root, base, roles.TOA_DIGITS)
    for drop in drops:
        delta.apply_drop(spark, root, drop, roles.TOA_DIGITS)
    delta.expire(spark, root)
    return delta.report(spark, root)


# Incident report -------------------------------------------------------------------------

INCIDENT_CUTOFF = "1994-01-01 00:00:00"


@register("incident_report")
def q_incident_report(spark: SparkSession, d: str) -> DataFrame:
    from fieldops.plans import reports
    tasks, pauses = state_tables(spark, d)
    return reports.incident_report(roles.incident_feed(spark, d), roles.work_orders(spark, d), tasks,
                                   roles.sites(spark, d), roles.alarm_catalogue(spark, d),
                                   reports.task_slots(tasks, pauses, roles.TOA_DIGITS), INCIDENT_CUTOFF, roles.TOA_DIGITS)


# Incremental ingest ------------------------------------------

@register("incremental_ingest", """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) t WHERE rn = 1""")
def q_incremental_ingest(spark: SparkSession, d: str) -> DataFrame:
    """The events table lands as two dated drops (first and second half of the
    month, rows without a time in the first) in a fresh folder on the shared checkpoint storage; an
    ``availableNow`` stream consumes each drop once and upserts it into the
    state table keyed by (user_id, event_type).  Result = the state table."""
    from fieldops.session import scratch_path
    from fieldops.streaming.ingest import ingest_stream
    from fieldops.sources.io import read_table
    ev = table(spark, d, "events")
    base = scratch_path(spark, "ingest")
    src, root, ckpt = f"{base}/landing", f"{base}/tables", f"{base}/checkpoint"
    split = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    early = F.coalesce(F.col("ts") < split, F.lit(True))
    for i, part in enumerate([ev.where(early), ev.where(~early)], start=1):
        part.write.mode("overwrite").parquet(f"{src}/{i}.{i}.drop")
        q = ingest_stream(spark, f"{src}/*", ev.schema, ["user_id", "event_type"], ["ts", "event_id"],
                          root, "events_state", ckpt)
        q.awaitTermination()
    return read_table(spark, root, "events_state").select(*ev.columns)


@register("stateful_ingest", """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id % 3 DESC, ts DESC, event_id DESC) AS rn
  FROM events) t WHERE rn = 1""")
def q_stateful_ingest(spark: SparkSession, d: str) -> DataFrame:
    """The events land as drops of three days, the middle one last; streaming
    state keeps the newest day's row per key, and each batch rewrites the folders of
    the keys that it changes."""
    from fieldops.session import scratch_path
    from fieldops.streaming.ingest import ingest_stream
    from fieldops.sources.io import read_table
    ev = table(spark, d, "events")
    base = scratch_path(spark, "stateful")
    for day in (0, 2, 1):
        ev.where(F.col("event_id") % 3 == day).write.parquet(f"{base}/landing/{day + 1}.1.drop")
        ingest_stream(spark, f"{base}/landing/*", ev.schema, ["user_id", "event_type"], ["ts", "event_id"], f"{base}/tables", "events_state",
                      f"{base}/checkpoint", stateful=True, parts="user_id div 1000").awaitTermination()
    return read_table(spark, f"{base}/tables", "events_state").select(*ev.columns)


# State builds from landed feeds -----------

@register("landing_ingest", f"""
SELECT CAST(o_orderkey + {roles.TOA_OFFSET} AS VARCHAR) AS Nro_TOA,
  CASE WHEN o_orderkey % 7 = 0 THEN 'Suspendido' WHEN o_orderkey % 3 = 0 THEN 'Cancelado'
       ELSE {_sql_case('o_orderstatus', config.ORDER_STATUS_ROLE)} END AS Estado_TOA,
  CASE WHEN o_orderkey % 7 = 0 THEN 'Línea "uno", fin' || chr(10) || 'línea dos' ELSE coalesce(text, '') END AS Notas,
  date_trunc('minute', o_orderdate) AS Creacion, o_orderpriority AS Subtipo,
  CASE WHEN o_orderkey % 7 = 0 THEN '8.1.d' WHEN o_orderkey % 3 = 0 THEN '2.1.b' ELSE '30.12.a' END AS origen
FROM orders LEFT JOIN documents ON o_orderkey = doc_id""")
def q_landing_ingest(spark: SparkSession, d: str) -> DataFrame:
    """Work orders land as four drops of text files; the first run takes three
    (one lacks a required column and is skipped), the second the last one."""
    from fieldops.plans import feeds
    from fieldops.plans.ingest import ingest
    from fieldops.session import scratch_path
    from fieldops.sources.io import list_files
    base = scratch_path(spark, "landing")
    drops = feeds.work_order_drops(spark, d, f"{base}/feed")
    contract = {c.replace(" ", "_"): "TEXT" for c in config.WORK_ORDER_COLUMNS} | {"Fecha_de_Registro_de_actividad_TOA": "DATETIME"}
    for version, run in enumerate((drops[:3], drops[3:])):
        files = [f for drop in run for f in list_files(spark, drop)]
        out, _ = ingest(spark, files, "Nro_TOA", contract, f"{base}/tables", "work_orders", str(version),
                        required=config.WORK_ORDER_COLUMNS, project=config.WORK_ORDER_COLUMNS, strip_marker=["Estado_TOA"],
                        source_col="origen")
    return out.select("Nro_TOA", "Estado_TOA", F.coalesce("Notas", F.lit("")).alias("Notas"),
                      F.col("Fecha_de_Registro_de_actividad_TOA").alias("Creacion"), F.col("Subtipo_de_Actividad").alias("Subtipo"), "origen")


@register("pause_ingest", "WITH " + report_sql.consolidated_ctes() + """
SELECT Order_ID, Operation_Time, Pause_Time, Reason, Order_ID || '_' || strftime(Operation_Time, '%Y-%m-%d %H:%M:%S') AS Index FROM p""")
def q_pause_ingest(spark: SparkSession, d: str) -> DataFrame:
    """Pauses land as text in two drops and a file without the order's column;
    their key is made of order and time (C12)."""
    from fieldops.plans import feeds
    from fieldops.plans.ingest import ingest
    from fieldops.session import scratch_path
    from fieldops.sources.io import list_files
    base = scratch_path(spark, "pauses")
    files = [f for drop in feeds.pause_drops(spark, d, f"{base}/feed") for f in list_files(spark, drop)]
    contract = {"Order_ID": "TEXT", "Operation_Time": "DATETIME", "Pause_Time": "TEXT", "Reason": "TEXT"}
    out, _ = ingest(spark, files, "Index", contract, f"{base}/tables", "pauses", "0", required=["Order ID"], make_key=["Order_ID", "Operation_Time"])
    return out.select(*contract, "Index")


@register("incident_state", """
WITH x AS (SELECT e.*, text, event_id % 5 = 0 AS again,
             CASE WHEN event_id % 10 = 0 THEN 'FLM HUAWEI' WHEN event_id % 5 = 0 THEN 'NOC'
                  WHEN event_id % 4 = 0 THEN 'FLM COMFICA SUR' WHEN event_id % 4 = 1 THEN 'FLM HUAWEI NORTE'
                  WHEN event_id % 4 = 2 THEN 'TDP CENTRAL' END AS Grupo_asignado
           FROM events e LEFT JOIN documents ON event_id = doc_id WHERE event_type = 'error')
SELECT 'INC' || lpad(CAST(event_id AS VARCHAR), CAST(greatest(7, length(CAST(event_id AS VARCHAR))) AS INTEGER), '0') AS ID_incidencia,
  CASE WHEN again THEN 'Cerrado' ELSE 'Asignado' END AS Estado, strftime(ts, '%Y-%m-%d %H:%M:%S') AS Fecha_envio,
  CASE WHEN again THEN strftime(ts + INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S') END AS Fecha_cierre,
  strftime(ts - INTERVAL 20 MINUTE, '%Y-%m-%d %H:%M:%S') AS Fecha_inicio_incidente, CAST(NULL AS VARCHAR) AS Fecha_fin_incidente,
  'Total' AS Tipo_afectacion, 'INC | alarma | nodo' AS Resumen, coalesce(text, 'sin notas') AS Notas, Grupo_asignado
FROM x WHERE contains(Grupo_asignado, 'FLM COMFICA') OR contains(Grupo_asignado, 'FLM HUAWEI')""")
def q_incident_state(spark: SparkSession, d: str) -> DataFrame:
    from fieldops.plans import feeds
    from fieldops.plans.ingest import incident_state
    from fieldops.session import scratch_path
    base = scratch_path(spark, "incidents")
    files = feeds.incident_files(spark, d, f"{base}/feed")
    return incident_state(spark, files, f"{base}/tables", "incidents", "0", by_folder=True).select(*config.INCIDENT_COLUMNS)


@register("site_state", f"""
WITH s AS ({SQL_SITES})
SELECT {{code}} AS Codigo_Unico, c_name AS Nombre_Local, Provincia, Departamento,
  strftime(Fecha_Fin_Swap, '%Y-%m-%d %H:%M:%S') AS Fecha_Fin_Swap, CAST(value AS DOUBLE) AS Alarmas_Activas_Nodo,
  strftime(Fecha_TSS, '%Y-%m-%d %H:%M:%S') AS Fecha_TSS
FROM s""".replace("{code}", report_sql.site_code("Codigo_Unico")))
def q_site_state(spark: SparkSession, d: str) -> DataFrame:
    from fieldops.plans import feeds
    from fieldops.plans.ingest import site_state
    from fieldops.session import scratch_path
    base = scratch_path(spark, "sites")
    files = feeds.site_files(spark, d, f"{base}/feed", sites_table(spark, d))
    out = site_state(spark, files, f"{base}/tables", "sites", "0")
    return out.withColumn("Alarmas_Activas_Nodo", F.col("Alarmas_Activas_Nodo").cast("double"))


@register("stored_inventory", """
SELECT 'events' AS table_name, count(*) AS n_rows, count(*) AS n_exported FROM events WHERE event_type <> 'error'
UNION ALL SELECT 'labels', count(*), count(*) FROM labels
UNION ALL SELECT 'supplier', count(*), count(*) FROM supplier""")
def q_stored_inventory(spark: SparkSession, d: str) -> DataFrame:
    """Three stored tables (one published twice) are inventoried by listing,
    exported, and the export counted beside them."""
    from fieldops.session import scratch_path
    from fieldops.sources import io
    base = scratch_path(spark, "stored")
    for name in ("events", "labels", "supplier"):
        io.write_table(table(spark, d, name), f"{base}/tables", name, "0")
    io.write_table(io.read_table(spark, f"{base}/tables", "events").where("event_type <> 'error'"), f"{base}/tables", "events", "1")
    names = io.export_stored(spark, f"{base}/tables", f"{base}/export")
    exported = io.table_counts(spark, f"{base}/export", names).withColumnRenamed("n_rows", "n_exported")
    return io.inventory(spark, f"{base}/tables").join(exported, "table_name")


def _incident_sql(cutoff: str) -> str:
    from fieldops.plans.report_sql import OFF, consolidated_ctes, site_code
    ws = "'^\\s+|\\s+$', '', 'g'"
    ac = "(contains({x}, 'ac') AND (contains({x}, 'failure') OR contains({x}, 'fallo') OR contains({x}, 'falla')))"
    obs = ["Arrive_Time", "Com_Fault_Speciality", "Com_Fault_Sub_Speciality", "Com_Fault_Cause", "Leave_Observations",
           "Detalle_de_actuación_realizada"]
    slot_dims = []
    for i in (1, 2, 3):
        slot_dims += [f"d{i}.{c} AS {c}_{i}" for c in ("Complete_Time", "Cancel_Time")]
        slot_dims += [f'd{i}."{c}" AS "{c}_{i}"' for c in obs]
    dim_cols = ", ".join(f"""CASE WHEN contains(Task_Id, 'CM') THEN "{c}" END AS "{c}" """ for c in obs)
    hours = [f"Tiempo_cancelacion_Autin_{i}" for i in (1, 2, 3)] + ["Tiempo_cancelacion_TOA"]
    texto = ", ".join(f'coalesce("{c}_{i}", \'\')' for i in (1, 2, 3)
                      for c in ("Leave_Observations", "Detalle_de_actuación_realizada"))
    ac_any = " OR ".join(f"(coalesce(Com_Fault_Speciality_{i} = 'ENERGIA', false) AND "
                         f"contains(upper(coalesce(Com_Fault_Sub_Speciality_{i}, '')), 'AC'))" for i in (1, 2, 3))
    det = ", ".join(f"{_sql_detector(n, 'Texto_Comb')} AS Accion_{n}" for n in config.DETECTORS)
    return "WITH " + consolidated_ctes() + f""",
ev AS (SELECT e.event_id, e.user_id, o.o_custkey,
         o.o_orderdate + to_minutes(CAST(o.o_orderkey % 1440 AS BIGINT)) AS ocreated
       FROM events e LEFT JOIN orders o ON e.event_id = o.o_orderkey WHERE e.event_type = 'error'),
inc0 AS (SELECT
    CASE WHEN event_id % 3 = 0 THEN 'INC' || lpad(CAST(event_id AS VARCHAR), CAST(greatest(7, length(CAST(event_id AS VARCHAR))) AS INTEGER), '0')
         ELSE 'R' || CAST(event_id AS VARCHAR) END AS ID_incidencia,
    ocreated - to_minutes(CAST((event_id % 7) * 60 + 30 AS BIGINT)) AS Fecha_inicio_incidente,
    'INC | ' || CASE WHEN event_id % 4 = 0 THEN 'ac failure' ELSE 'alarma de energia' END || ' | nodo' AS Resumen,
    concat_ws(chr(10), 'Alarma: ' || CASE WHEN event_id % 2 = 0 THEN 'Falla de energia' ELSE 'Puerta abierta' END,
              CASE WHEN event_id % 3 = 1 THEN 'TOA: ' || CAST(event_id + {OFF} AS VARCHAR) END,
              'Sitio ' || {site_code('coalesce(o_custkey, user_id)')},
              CASE WHEN event_id % 7 = 0 THEN 'Circuito: 123' END) AS Notas,
    user_id, event_id % 5 = 0 AS _shut,
    CASE WHEN event_id % 2 = 0 THEN 'Total' ELSE 'Parcial' END AS Tipo_afectacion,
    CASE WHEN event_id % 2 = 0 THEN 'FLM COMFICA' ELSE 'FLM HUAWEI' END AS Grupo_asignado
  FROM ev),
inc AS (SELECT * EXCLUDE (_shut), Fecha_inicio_incidente + INTERVAL 20 MINUTE AS Fecha_envio,
          CASE WHEN _shut THEN 'Cerrado' ELSE 'Asignado' END AS Estado,
          CASE WHEN _shut THEN Fecha_inicio_incidente + INTERVAL 9 HOUR END AS Fecha_cierre,
          CASE WHEN _shut THEN Fecha_inicio_incidente + INTERVAL 8 HOUR END AS Fecha_fin_incidente FROM inc0
        WHERE Fecha_inicio_incidente >= TIMESTAMP '{cutoff}'),
icat AS (SELECT lower(trim(lower(p_name))) AS k, min(p_type) AS tipo FROM part GROUP BY 1),
ia AS (SELECT inc.*, lower(nullif(regexp_extract(Resumen, '\\|([^|]+)', 1), '')) AS seg FROM inc),
ib AS (SELECT ia.*, CASE WHEN seg IN (SELECT k FROM icat) OR {ac.format(x='seg')} THEN seg END AS acc FROM ia),
ic AS (SELECT ib.* EXCLUDE (seg, acc),
         coalesce(regexp_replace(lower(coalesce(acc, nullif(regexp_extract(Notas, 'Alarma: ([^\\n]*?)\\n', 1), ''))),
                                 {ws}), '') AS al FROM ib),
id AS (SELECT ic.* EXCLUDE (al), CASE WHEN al = '' THEN 'alarma no identificada' ELSE al END AS Alarma,
         CASE WHEN al = '' THEN 'alarma no identificada' WHEN {ac.format(x='al')} THEN 'TOTAL'
              WHEN icat.tipo IS NULL THEN 'tipo no identificado' ELSE icat.tipo END AS Tipo
       FROM ic LEFT JOIN icat ON ic.al = icat.k),
isites AS (SELECT {site_code('c.c_custkey')} AS code,
             {_sql_case('c.c_mktsegment', config.SEGMENT_PROVIDER_ROLE)} AS Proveedor_FLM,
             {_sql_case('c.c_mktsegment', config.SEGMENT_TIER_ROLE)} AS priorizacion, sw.Fecha_Fin_Swap,
             lower(c.c_mktsegment) AS Tipo_Estacion
           FROM customer c LEFT JOIN sw ON sw.user_id = c.c_custkey),
icodes AS (SELECT ID_incidencia, list_filter(regexp_extract_all(Notas, '[A-Z]{{2}}[0-9]{{5}}'),
                                             lambda c: NOT (c[1:2] IN ('NC', 'CD', 'CR'))) AS codes FROM id),
iex AS (SELECT ID_incidencia, unnest(codes) AS code, generate_subscripts(codes, 1) AS pos FROM icodes),
ifk AS (SELECT ID_incidencia, arg_min(code, pos) AS ID_Sitio FROM iex WHERE code IN (SELECT code FROM isites)
        GROUP BY ID_incidencia),
ie AS (SELECT id.*, ifk.ID_Sitio,
         coalesce(regexp_matches(Notas, 'CD\\d{{6}}|CR\\d{{5}}|Circuito:|CIRCUITO:'), false) AS corp,
         coalesce(nullif(regexp_extract(regexp_replace(regexp_extract(Notas, '(?i)(?:TOA:|SIOM:)([^\\n]*?)(?:\\n|$)', 1),
                  {ws}), '(\\d{{8,19}})', 1), ''), 'sin TOA en notas') AS TOA_notas
       FROM id LEFT JOIN ifk ON id.ID_incidencia = ifk.ID_incidencia),
itoa AS (SELECT Nro_TOA, ID_del_Ticket,
           regexp_replace(trim("Número_de_Petición"), '-\\d{{2}}$', '') AS "Número_de_Petición",
           Fecha_de_Registro_de_actividad_TOA AS created, Codigo_Unico AS "Código_de_Cliente",
           "Fecha_Hora_de_Cancelación", Estado_TOA FROM wo2),
itoa2 AS (SELECT *, CASE WHEN regexp_matches(ID_del_Ticket, '^INC\\d{{7}}') THEN ID_del_Ticket
                         ELSE "Número_de_Petición" END AS Clave_Remedy FROM itoa),
b2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY Nro_TOA ORDER BY created, Nro_TOA) AS rn
                      FROM itoa2 WHERE Nro_TOA IS NOT NULL) q WHERE rn = 1),
j1 AS (SELECT ie.*, o.Nro_TOA AS a_nro, o.ID_del_Ticket AS a_tk, o."Número_de_Petición" AS a_pet, o.created AS a_cr,
         o."Código_de_Cliente" AS a_cc, o."Fecha_Hora_de_Cancelación" AS a_fc, o.Estado_TOA AS a_st,
         o.Clave_Remedy IS NOT NULL AS hit1
       FROM ie LEFT JOIN itoa2 o ON ie.ID_incidencia = o.Clave_Remedy),
j2 AS (SELECT j1.*, b2.Nro_TOA AS b_nro, b2.ID_del_Ticket AS b_tk, b2."Número_de_Petición" AS b_pet, b2.created AS b_cr,
         b2."Código_de_Cliente" AS b_cc, b2."Fecha_Hora_de_Cancelación" AS b_fc, b2.Estado_TOA AS b_st
       FROM j1 LEFT JOIN b2
         ON (CASE WHEN NOT hit1 AND TOA_notas <> 'sin TOA en notas' THEN TOA_notas END) = b2.Nro_TOA),
nx0 AS (SELECT ID_incidencia, Fecha_inicio_incidente, Fecha_envio, Resumen, Notas, user_id, Estado, Fecha_cierre, Fecha_fin_incidente,
         Tipo_afectacion, Grupo_asignado, Alarma, Tipo, TOA_notas, corp,
         CASE WHEN hit1 THEN a_nro ELSE b_nro END AS Nro_TOA,
         CASE WHEN hit1 THEN a_tk ELSE b_tk END AS ID_del_Ticket,
         CASE WHEN hit1 THEN a_pet ELSE b_pet END AS "Número_de_Petición",
         CASE WHEN hit1 THEN a_cr ELSE b_cr END AS Fecha_de_Registro_de_actividad_TOA,
         CASE WHEN hit1 THEN a_cc ELSE b_cc END AS "Código_de_Cliente",
         CASE WHEN hit1 THEN a_fc ELSE b_fc END AS "Fecha_Hora_de_Cancelación",
         CASE WHEN hit1 THEN a_st ELSE b_st END AS Estado_TOA,
         CASE WHEN hit1 THEN 'first' WHEN b_nro IS NOT NULL THEN 'second' END AS match_source,
         ID_Sitio AS _site0
       FROM j2),
nx1 AS (SELECT nx0.* EXCLUDE (_site0), coalesce(_site0, "Código_de_Cliente") AS ID_Sitio FROM nx0),
nx2 AS (SELECT nx1.*, ID_incidencia || '|' || coalesce(Nro_TOA, '') AS _rk, s.Proveedor_FLM, s.priorizacion, s.Tipo_Estacion,
         s.Fecha_Fin_Swap,
         CASE WHEN NOT coalesce(s.Proveedor_FLM IN ('HUAWEI', 'COMFICA'), false) AND nx1.ID_Sitio IS NOT NULL
                   AND (CASE WHEN corp THEN 'Caso Empresa' WHEN Nro_TOA IS NOT NULL THEN 'Si tiene TOA'
                             ELSE 'TOA no identificado' END) <> 'Si tiene TOA'
              THEN 'Sitio corresponde a Telefonica'
              ELSE (CASE WHEN corp THEN 'Caso Empresa' WHEN Nro_TOA IS NOT NULL THEN 'Si tiene TOA'
                         ELSE 'TOA no identificado' END) END AS Razones_Sin_TOA
       FROM nx1 LEFT JOIN isites s ON nx1.ID_Sitio = s.code),
free AS (SELECT * FROM itoa2 f WHERE NOT EXISTS (SELECT 1 FROM nx2 WHERE nx2.Nro_TOA = f.Nro_TOA)),
cp AS (SELECT nx2._rk, f.Nro_TOA AS cn, f."Número_de_Petición" AS cpet,
         row_number() OVER (PARTITION BY nx2._rk ORDER BY f.created, f.Nro_TOA) AS rk
       FROM nx2 JOIN free f ON nx2.ID_Sitio = f."Código_de_Cliente"
         AND f.created BETWEEN nx2.Fecha_envio - INTERVAL 6 HOUR AND nx2.Fecha_envio + INTERVAL 6 HOUR
       WHERE nx2.Nro_TOA IS NULL),
cw AS (SELECT _rk, max(CASE WHEN rk = 1 THEN cn END) AS cand_Nro_TOA_1,
         max(CASE WHEN rk = 1 THEN cpet END) AS "cand_Número_de_Petición_1",
         max(CASE WHEN rk = 2 THEN cn END) AS cand_Nro_TOA_2,
         max(CASE WHEN rk = 2 THEN cpet END) AS "cand_Número_de_Petición_2" FROM cp GROUP BY _rk),
sl1 AS (SELECT Number_OS_SIOM AS snro,
          coalesce(Task_Id_1, '') AS i1, coalesce(Task_Id_2, '') AS i2, coalesce(Task_Id_3, '') AS i3,
          coalesce(Task_Status_1, '') AS e1, coalesce(Task_Status_2, '') AS e2, coalesce(Task_Status_3, '') AS e3,
          coalesce(Cancel_Reason_1, '') AS m1, coalesce(Cancel_Reason_2, '') AS m2c, coalesce(Cancel_Reason_3, '') AS m3c,
          coalesce(Task_Id_3, '') = coalesce(Task_Id_2, '') AS k3, coalesce(Task_Id_2, '') = coalesce(Task_Id_1, '') AS k2
        FROM w),
sl AS (SELECT snro, i1 AS Autin_ID_1, CASE WHEN k2 THEN (CASE WHEN NOT k3 THEN i3 END) ELSE i2 END AS Autin_ID_2,
         CASE WHEN k2 OR k3 THEN NULL ELSE i3 END AS Autin_ID_3,
         e1 AS Estado_1, CASE WHEN k2 THEN (CASE WHEN NOT k3 THEN e3 END) ELSE e2 END AS Estado_2,
         CASE WHEN k2 OR k3 THEN NULL ELSE e3 END AS Estado_3,
         m1 AS Motivo_Cancel_1, CASE WHEN k2 THEN (CASE WHEN NOT k3 THEN m3c END) ELSE m2c END AS Motivo_Cancel_2,
         CASE WHEN k2 OR k3 THEN NULL ELSE m3c END AS Motivo_Cancel_3
       FROM sl1),
dim AS (SELECT Task_Id, Complete_Time, Cancel_Time, {dim_cols} FROM t),
nx3 AS (SELECT nx2.*, cw.* EXCLUDE (_rk), sl.* EXCLUDE (snro), {", ".join(slot_dims)},
         {SQL_TARGET} AS Tiempo_de_Contencion
       FROM nx2 LEFT JOIN cw ON nx2._rk = cw._rk LEFT JOIN sl ON nx2.Nro_TOA = sl.snro
       LEFT JOIN dim d1 ON sl.Autin_ID_1 = d1.Task_Id LEFT JOIN dim d2 ON sl.Autin_ID_2 = d2.Task_Id
       LEFT JOIN dim d3 ON sl.Autin_ID_3 = d3.Task_Id),
nx4 AS (SELECT *,
    date_diff('microsecond', Fecha_inicio_incidente, Fecha_de_Registro_de_actividad_TOA) AS _us,
    date_diff('microsecond', Fecha_inicio_incidente, Cancel_Time_1) / 3600000000.0::DOUBLE AS {hours[0]},
    date_diff('microsecond', Fecha_inicio_incidente, Cancel_Time_2) / 3600000000.0::DOUBLE AS {hours[1]},
    date_diff('microsecond', Fecha_inicio_incidente, Cancel_Time_3) / 3600000000.0::DOUBLE AS {hours[2]},
    CASE WHEN Estado_TOA = 'Cancelado' THEN date_diff('microsecond', Fecha_inicio_incidente, "Fecha_Hora_de_Cancelación")
      / 3600000000.0::DOUBLE END AS {hours[3]}
  FROM nx3),
nx5 AS (SELECT *, list_min(list_filter([{", ".join(hours)}], lambda v: v < 96)) AS Tiempo_cancelacion_minimo FROM nx4),
nx6 AS (SELECT *,
    CASE WHEN Tiempo_de_Contencion IS NULL THEN 'Sin información Site ID'
         WHEN Fecha_inicio_incidente IS NULL OR Fecha_de_Registro_de_actividad_TOA IS NULL THEN 'Sin información TOA'
         WHEN _us / 60000000.0::DOUBLE < (Tiempo_de_Contencion + 0.25::DOUBLE) * 60.0::DOUBLE THEN '< del tiempo esperado'
         WHEN _us / 60000000.0::DOUBLE > (Tiempo_de_Contencion + 0.75::DOUBLE) * 60.0::DOUBLE THEN '> del tiempo esperado'
         ELSE 'rango correcto' END AS Cumplimiento_de_Contencion,
    _us / 3600000000.0::DOUBLE AS Tiempo_de_envio,
    CASE WHEN Tiempo_de_Contencion IS NULL THEN 'Sin información Site ID'
         WHEN Tiempo_cancelacion_minimo IS NULL AND coalesce({", ".join(hours)}) IS NULL THEN 'Ticket no cancelado'
         WHEN Tiempo_cancelacion_minimo IS NULL THEN 'Cancelamiento Outlier'
         WHEN Tiempo_cancelacion_minimo * 60.0::DOUBLE < (Tiempo_de_Contencion + 0.25::DOUBLE) * 60.0::DOUBLE
           THEN 'Cancelado antes de rango contención'
         WHEN Tiempo_cancelacion_minimo * 60.0::DOUBLE > (Tiempo_de_Contencion + 0.75::DOUBLE) * 60.0::DOUBLE
           THEN 'Cancelado fuera de rango contención'
         ELSE 'Cancelado en rango contención' END AS Error_Contencion,
    CASE WHEN ID_Sitio IS NULL THEN 'Sin info de Sitio'
         WHEN Fecha_Fin_Swap IS NOT NULL AND Fecha_inicio_incidente > Fecha_Fin_Swap THEN 'Incidente post SWAP'
         ELSE 'Incidente no relacionado a SWAP' END AS Clasificacion_SWAP,
    CASE WHEN coalesce(Arrive_Time_1, Arrive_Time_2, Arrive_Time_3) IS NOT NULL THEN 'Si' ELSE 'No' END AS Tecnico_llego,
    CASE WHEN {ac_any} THEN 'Si' ELSE 'No' END AS Fallo_AC,
    concat_ws('. ', {texto}) AS Texto_Comb
  FROM nx5),
isup AS (SELECT Site_Id, Task_Id AS sid, Createtime AS sts FROM t
         WHERE contains(lower(Task_Category), 'abastecimiento') AND NOT coalesce(Task_Status = 'canceled', false)),
sc AS (SELECT nx6._rk, count(s.sid) AS n, string_agg(s.sid, ', ' ORDER BY s.sts, s.sid) AS lst
       FROM nx6 LEFT JOIN isup s ON nx6.ID_Sitio = s.Site_Id AND s.sts >= nx6.Fecha_de_Registro_de_actividad_TOA
         AND s.sts <= nx6.Fecha_de_Registro_de_actividad_TOA + INTERVAL 48 HOUR
       GROUP BY nx6._rk),
nx7 AS (SELECT nx6.*, {_sql_bins('Tiempo_cancelacion_minimo', 'Error_Contencion')} AS rango_de_cancelacion,
    CASE WHEN ID_Sitio IS NOT NULL AND Fecha_de_Registro_de_actividad_TOA IS NOT NULL THEN sc.n END
      AS Cantidad_Tickets_Abastecimiento,
    CASE WHEN ID_Sitio IS NOT NULL AND Fecha_de_Registro_de_actividad_TOA IS NOT NULL THEN coalesce(sc.lst, '') END
      AS Lista_Abastecimiento,
    {det}
  FROM nx6 LEFT JOIN sc ON nx6._rk = sc._rk),
nx8 AS (SELECT *, CASE WHEN coalesce(Cantidad_Tickets_Abastecimiento > 0, false) THEN 'Si' ELSE 'No' END
                   AS Hubo_Abastecimiento FROM nx7)
SELECT * EXCLUDE (_rk, _us, corp),
  CASE WHEN Hubo_Abastecimiento = 'Si' OR Tecnico_llego = 'Si' OR Fallo_AC = 'Si' OR Accion_ge = 'SI'
         OR Accion_baterias = 'SI' OR Accion_itm = 'SI' OR Accion_breakers = 'SI' THEN 'Si' ELSE 'No' END
    AS Detectamos_atencion
FROM nx8"""


ORACLE["incident_report"] = _incident_sql(INCIDENT_CUTOFF).strip()
