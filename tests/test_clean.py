import datetime as dt

from pyspark.sql import functions as F

from fieldops.functions import clean


def one(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_parse_ts_formats_and_tokens(spark):
    vals = ["3/2/25 1:44 PM", "03/02/70", "2025-02-03 09:45:00.123", "31/01/25 13:04", "2025-02-03",
            "2025-02-03 09:45:00", "03/02/25 15:02:15", "2025-02-03 09:48", "03/02/2025 07:38 AM",
            "31/01/2025 13:04", "-", "", "no se registro ?", None, "  03/02/25  ", "junk"]
    got = one(spark, vals, clean.parse_ts)
    assert got == [
        dt.datetime(2025, 2, 3, 13, 44), dt.datetime(1970, 2, 3), None, None, None,
        dt.datetime(2025, 2, 3, 9, 45), dt.datetime(2025, 2, 3, 15, 2, 15), dt.datetime(2025, 2, 3, 9, 48),
        dt.datetime(2025, 2, 3, 7, 38), dt.datetime(2025, 1, 31, 13, 4), None, None, None, None,
        dt.datetime(2025, 2, 3), None]


def test_two_digit_year_keeps_time(spark):
    assert one(spark, ["22/03/99 21:38:00"], clean.parse_ts) == [dt.datetime(1999, 3, 22, 21, 38)]


def test_integer_contract_rounds_half_even(spark):
    got = one(spark, ["2.5", "3.5", "5d", "", "-", " 7 ", "1e2", "abc", None], clean.to_integer)
    assert got == [2, 4, None, None, None, 7, 100, None, None]


def test_real_contract_rejects_suffixes(spark):
    assert one(spark, ["5d", "5.25", "Infinity", "NaN"], clean.to_double) == [None, 5.25, None, None]


def test_canon_id(spark):
    got = one(spark, ["12345678.0", "123456789", "SIOM-12", "", None, "42", "-5"], clean.canon_id)
    assert got == ["12345678", "123456789", "SIOM-12", None, None, "00000042", "-0000005"]
    got = one(spark, ["12345678.0", "42"], lambda c: clean.canon_id(c, width=0))
    assert got == ["12345678", "42"]


def test_suffix_key_literal(spark):
    assert one(spark, [" PET12-01 ", "PET12-1", "A-12-99"], clean.strip_suffix) == ["PET12", "PET12-1", "A-12"]
    df = spark.createDataFrame([("INC1234567", "P1"), ("INC12", "P2"), (None, "P3")], "a string, b string")
    assert [r[0] for r in df.select(clean.incident_key("a", "b")).collect()] == ["INC1234567", "P2", "P3"]
    assert one(spark, ["Cancelado (antiguo)", "(antiguo)x"], lambda c: clean.strip_literal(c, "(antiguo)")) == \
        ["Cancelado", "x"]


def test_composite_key_null_is_empty(spark):
    df = spark.createDataFrame([("a", None), (None, "b")], "x string, y string")
    assert [r[0] for r in df.select(clean.composite_key("x", "y")).collect()] == ["a_", "_b"]


def test_blank_placeholders(spark):
    df = spark.createDataFrame([(0, "nan", None, 1.5), (3, "None", "x", 0.0)], "a int, b string, c string, d double")
    out = clean.blank_placeholders(df).collect()
    assert [tuple(r) for r in out] == [("", "", "", "1.5"), ("3", "", "x", "")]


def test_contract_and_names(spark):
    df = spark.createDataFrame([("2.5", "x", "2024-05-01", "03/02/25")], "`a b` string, c string, d string, e string")
    df = clean.normalize_names(df)
    out = clean.apply_contract(df, {"a_b": "INTEGER", "c": "TEXT", "d": "DATE", "e": "DATETIME"}).collect()[0]
    assert tuple(out) == (2, "x", dt.date(2024, 5, 1), dt.datetime(2025, 2, 3))
    assert clean.drop_if(df, ["zz", "c"]).columns == ["a_b", "d", "e"]


def test_dates_ignore_the_session_zone(spark):
    """A time inside a spring-forward gap stays what the text says, in any session zone (C1, C6, DATE)."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([("2024-03-10 02:30:00", "10/03/24 2:30 AM")], "a string, b string")
        got = df.select(clean.fmt_ts(clean.parse_ts("a")), clean.fmt_ts(clean.parse_ts("b")), clean.parse_ts("a").cast("string"),
                        clean.cast_to("a", "DATE").cast("string")).first()
        assert tuple(got) == ("2024-03-10 02:30:00", "2024-03-10 02:30:00", "2024-03-10 02:30:00", "2024-03-10")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
