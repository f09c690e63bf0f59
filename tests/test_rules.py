import datetime as dt

from pyspark.sql import functions as F

from fieldops.functions import rules


def test_days_since_is_elapsed_not_calendar(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23), dt.datetime(2024, 1, 2, 1)),
                                (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 4, 1)),
                                (dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 4))], "a timestamp_ntz, b timestamp_ntz")
    got = [tuple(r) for r in df.select(rules.days_since("a", "b"), rules.whole_days("a", "b"),
                                       rules.hours_between("a", "b")).collect()]
    assert got == [(None, 0, 2.0), (3, 3, 73.0), (None, -1, -24.0)]


def test_age_band_boundaries(spark):
    df = spark.createDataFrame([(0.0,), (3.0,), (6.0,), (6.01,), (None,), (0.5,)], "h double")
    assert [r[0] for r in df.select(rules.age_band("h")).collect()] == ["", "verde", "amarillo", "rojo", "", "verde"]


def test_bounded_min_and_cancel_labels(spark):
    df = spark.createDataFrame([(None, -2.0, 5.0, 95.9), (96.0, None, None, 100.0), (None, None, None, None)],
                               "a double, b double, c double, d double")
    hours = ["a", "b", "c", "d"]
    x = df.withColumn("m", rules.bounded_min(hours)).withColumn("t", F.lit(2.0))
    x = x.withColumn("o", rules.cancel_outcome("t", "m", hours)).withColumn("bin", rules.cancel_bin("m", "o"))
    got = [tuple(r) for r in x.select("m", "o", "bin").collect()]
    assert got == [(-2.0, "Cancelado antes de rango contención", "72+"),
                   (None, "Cancelamiento Outlier", "Cancelamiento Outlier"),
                   (None, "Ticket no cancelado", None)]


def test_cancel_bins_half_open(spark):
    df = spark.createDataFrame([(0.0,), (5.99,), (6.0,), (71.9,), (72.0,)], "m double")
    got = [r[0] for r in df.select(rules.cancel_bin("m", F.lit("x"))).collect()]
    assert got == ["00-06", "00-06", "06-12", "60-72", "72+"]


def test_compliance_band(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(2.0, t0, t0 + dt.timedelta(minutes=m)) for m in (134, 135, 165, 166)]
    rows += [(None, t0, t0), (2.0, t0, None)]
    df = spark.createDataFrame(rows, "t double, s timestamp_ntz, r timestamp_ntz")
    got = [r[0] for r in df.select(rules.compliance("t", "s", "r")).collect()]
    assert got == ["< del tiempo esperado", "rango correcto", "rango correcto", "> del tiempo esperado",
                   "Sin información Site ID", "Sin información TOA"]


def test_predicates_keep_nulls(spark):
    df = spark.createDataFrame([("Duplicado", "CM1", "x", "canceled"), (None, "plm2", "PROACTIVO", None),
                                ("Otro", "PLM3", "x", "open"), ("Other", "cm4", "Abastecimiento", "open")],
                               "r string, id string, cat string, st string")
    got = [tuple(r) for r in df.select(rules.exclude_values("r"), rules.eligible_task("id", "cat"),
                                       rules.supply_task("cat", "st")).collect()]
    assert got == [(False, True, False), (True, True, False), (True, False, False), (False, True, True)]


def test_vendor_case_rules(spark):
    df = spark.createDataFrame([("Bucket COMFICA",), ("x huawei",), (None,), ("comfica y huawei",)], "b string")
    got = [tuple(r) for r in df.select(rules.vendor("b"), rules.responsible("b")).collect()]
    assert got == [("comfica", "TDP"), ("huawei", "FLM"), ("", "TDP"), ("comfica", "FLM")]


def test_status_conflict_and_reasons(spark):
    df = spark.createDataFrame([("Cancelado", "closed"), ("Completado", "canceled"), ("Pendiente", "closed"),
                                ("Pendiente", "accepted"), (None, None)], "o string, t string")
    assert [r[0] for r in df.select(rules.status_conflict("o", "t")).collect()] == [
        "cruce incorrecto", "cruce incorrecto", "falta de revisión", "", ""]
    df = spark.createDataFrame([(True, None, None, "S1"), (False, "1", None, "S1"), (False, None, "HUAWEI", "S1"),
                                (False, None, None, None), (True, "1", "COMFICA", "S1")],
                               "c boolean, o string, p string, s string")
    assert [r[0] for r in df.select(rules.no_order_reason("c", "o", "p", "s")).collect()] == [
        "Sitio corresponde a Telefonica", "Si tiene TOA", "TOA no identificado", "TOA no identificado",
        "Caso Empresa"]


def test_ac_fault_and_any(spark):
    df = spark.createDataFrame([("ENERGIA", "falla ac", None, None), ("ENERGIA", None, "ENERGIA", "DC"),
                                (None, None, None, None)], "s1 string, u1 string, s2 string, u2 string")
    got = [tuple(r) for r in df.select(rules.ac_fault(["s1", "s2"], ["u1", "u2"]),
                                       rules.any_present("s1", "s2")).collect()]
    assert got == [("Si", "Si"), ("No", "Si"), ("No", "No")]
