from pyspark.sql import functions as F

from fieldops.functions import text


def col_values(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_alarm_segment(spark):
    got = col_values(spark, ["a||b|c", "sin pipe", "INC | Falla AC |", None], text.alarm_segment)
    assert got == ["b", None, " falla ac ", None]


def test_alarm_in_notes_crlf(spark):
    got = col_values(spark, ["x\nAlarma: Puerta\r\nmas", "Alarma: sin fin", None], text.alarm_in_notes)
    assert got == ["Puerta\r", None, None]


def test_identify_alarms(spark):
    inc = spark.createDataFrame([(1, "INC | puerta abierta |", None), (2, "INC|puerta abierta|x", None),
                                 (3, "INC | ac failure |", None), (4, "nada", "Alarma: Humo \r\n"),
                                 (5, "nada", None)], "id int, r string, n string")
    cat = spark.createDataFrame([(" Puerta Abierta ", "PARCIAL"), ("humo", "TOTAL?")], "Alarma string, Tipo string")
    out = text.identify_alarms(inc, "r", "n", text.alarm_catalogue(cat)).orderBy("id")
    assert [tuple(r) for r in out.select("Alarma", "Tipo").collect()] == [
        ("alarma no identificada", "alarma no identificada"), ("puerta abierta", "PARCIAL"),
        ("ac failure", "TOTAL"), ("humo", "TOTAL?"), ("alarma no identificada", "alarma no identificada")]


def test_site_codes_text_order(spark):
    got = col_values(spark, ["AB12345 CD12345 NC11111 ABC12345 AB12345", None], text.site_codes)
    assert got == [["AB12345", "BC12345"], []]


def test_notes_rules(spark):
    got = col_values(spark, ["x TOA: 12345678 z\nmas", "siom:ab 123456789", "nada", None], text.order_in_notes)
    assert got == ["12345678", "12345678", "sin TOA en notas", "sin TOA en notas"]
    got = col_values(spark, ["CD123456", "CR12345", "Circuito: 1", "circuito:", None], text.corporate_case)
    assert got == [True, True, True, False, False]


def test_detectors_spanish_words(spark):
    vals = ["Se cambió el grupo electrógeno", "no tiene grupo electrógeno, se instaló nada",
            "se arregló breakers", "se levanta el breaker", "técnico cambió baterías", "se ajustó itm",
            "coloca g.e. en sitio", "", None]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [tuple(r) for r in df.select(*[text.detector(n, "v") for n in ("ge", "baterias", "itm", "breakers")]).collect()]
    assert got == [("SI", "NO", "NO", "NO"), ("NO", "NO", "NO", "NO"), ("NO", "NO", "NO", "NO"),
                   ("NO", "NO", "NO", "SI"), ("NO", "SI", "NO", "NO"), ("NO", "NO", "SI", "NO"),
                   ("SI", "NO", "NO", "NO"), ("NO", "NO", "NO", "NO"), ("NO", "NO", "NO", "NO")]


def test_combined_text(spark):
    df = spark.createDataFrame([("a", None, "c")], "x string, y string, z string")
    assert df.select(text.combined_text(["x", "y", "z"])).first()[0] == "a. . c"
