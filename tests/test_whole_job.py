"""Rows and texts that were once left out: long order numbers, null times."""

import datetime

import duckdb
from pyspark.sql import functions as F

from fieldops import config
from fieldops.functions import clean, text
from fieldops.plans import catalog, reports, roles

from conftest import SF_SMALL


def test_tasks_of_order_keys_beyond_90_million_keep_their_slots(spark, tmp_path):
    d = str(tmp_path)
    keys = [89_999_999, 90_000_000, 90_000_001, 123_456_789]
    spark.createDataFrame(
        [(k, i, 7, 5, 10.0, 100.0, 0.05, 0.03, "R", "F", datetime.datetime(1995, 1, i)) for k in keys for i in (1, 2)],
        "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, "
        "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz").write.parquet(f"{d}/lineitem.parquet")
    slots = reports.task_slots(roles.tasks(spark, d), roles.pauses(spark, d), roles.TOA_DIGITS)
    got = {r.ID_TOA: (r.Autin_ID_1, r.Autin_ID_2) for r in slots.collect()}
    assert got == {str(k + 10_000_000): (f"CM-{k}-1", f"CM-{k}-2") for k in keys}
    notes = spark.createDataFrame([(f"x\nTOA: {k + 10_000_000}\n",) for k in keys], "n string")
    assert {r[0] for r in notes.select(text.order_in_notes("n", roles.TOA_DIGITS)).collect()} == set(got)


def test_incremental_ingest_keeps_keys_with_null_times_alone(spark, tmp_path):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    late = ev.where("event_id % 10 = 1").withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    alone = late.withColumns({"user_id": F.col("user_id") + 1_000_000, "event_id": F.col("event_id") + 1_000_000})
    ev.unionByName(late).unionByName(alone).write.parquet(f"{tmp_path}/events.parquet")
    got = {tuple(r) for r in catalog.QUERIES["incremental_ingest"](spark, str(tmp_path)).select("user_id", "event_type", "event_id", "ts").collect()}
    db = duckdb.connect()
    db.execute(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    want = db.execute(f"select user_id, event_type, event_id, ts from ({catalog.ORACLE['incremental_ingest']})").fetchall()
    assert got == set(want) and len(want) == len(got) and any(r[3] is None for r in want)


def test_published_report_of_a_report_read_back_from_text(spark, tmp_path):
    typed = catalog.QUERIES["consolidated_report"](spark, SF_SMALL).limit(300)
    times = [c for c, k in config.REPORT_CONTRACT.items() if k == "DATETIME"]
    typed = typed.withColumns({c: F.date_trunc("second", c).cast("timestamp_ntz") for c in times}).persist()
    typed.select(*[(clean.fmt_ts(c) if c in times else F.col(c).cast("string")).alias(c) for c in typed.columns]).write.option("header", "true").option("quoteAll", "true").option("escape", '"').csv(f"file:{tmp_path}/r")
    text_only = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(f"file:{tmp_path}/r")
    assert {f.dataType.typeName() for f in text_only.schema.fields} == {"string"}
    as_of = F.lit(catalog.PUBLISH_AS_OF).cast("timestamp_ntz")
    rows = lambda df: [tuple(str(v) for v in r) for r in df.collect()]
    assert rows(reports.published_report(text_only, as_of)) == rows(reports.published_report(typed, as_of))
