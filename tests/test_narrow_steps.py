"""Steps of the reports, the delta and the ingests run no needless job, shuffle or column."""

import os

from pyspark.sql import functions as F

from fieldops.functions import clean
from fieldops.operators import slots, state
from fieldops.plans import feeds
from fieldops.sources import io
from fieldops.sources.keyed import KeyedTable


def jobs(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def plan(df):
    return df.select("*")._jdf.queryExecution().executedPlan().toString()  # not run yet


def test_staging_reads_no_footers(spark):
    out, n = jobs(spark, "staging", lambda: io.stage_table(spark.range(10).withColumn("t", F.lit("x")), "narrow"))
    assert n == 1 and out.count() == 10


def test_a_keyed_table_is_opened_without_a_job(spark, tmp_path):
    root = f"file:{tmp_path}"
    KeyedTable.create(spark.range(10), root, "t", ["id"], "id div 5").publish()
    t, n = jobs(spark, "opening", lambda: KeyedTable.open(spark, root, "t"))
    assert n == 0 and sorted(t.folders) == [0, 1] and t.read().count() == 10


def test_slots_behind_a_top_k_need_no_second_sort(spark):
    df = spark.range(200).select((F.col("id") % 20).alias("g"), F.col("id").alias("x"), F.col("id").cast("string").alias("s"))
    wide = slots.pivot_slots(slots.top_k(df, "g", [F.col("x").desc()]), "g", "Orden", ["x", "s"])
    p = plan(wide)
    assert "ObjectHashAggregate" not in p and p.count("Exchange hashpartitioning") == 1
    assert wide.where("g = 3").first().asDict() == {"g": 3, "x_1": 183, "s_1": "183", "x_2": 163, "s_2": "163", "x_3": 143, "s_3": "143"}


def test_plain_numbers_are_ids_as_before(spark):
    given = ["12345678", "12345678.0", "7", "7.00", "007", "5.", "1e3", "-4", " 9 ", "0", "x1", "", None, "123456789012345.0", "12\n"]
    df = spark.createDataFrame([(g,) for g in given], "s string")
    want = ["12345678", "12345678", "00000007", "00000007", "00000007", "00000005", "00001000", "-0000004", "00000009", "00000000", "x1", None, None,
            "123456789012345", "00000012"]
    assert [r[0] for r in df.select(clean.canon_id("s")).collect()] == want


def test_rows_of_no_vendor_take_part_in_no_join(spark):
    left = spark.createDataFrame([(1, "Bucket COMFICA"), (2, "TDP"), (3, None), (4, "huawei comfica")], "id long, bucket string")
    out = io.vendor_rows(left.join(spark.range(9).hint("merge"), "id", "left"), "bucket", ["comfica", "huawei"])
    assert sorted((r.id, r.vendor) for r in out.collect()) == [(1, "comfica"), (4, "comfica"), (4, "huawei")]
    below = out._jdf.queryExecution().optimizedPlan().toString().split("Join LeftOuter")[1]
    assert "Contains(" in below


def test_a_dropped_order_column_is_shuffled_once(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", None)], "k long, v string, o long")
    last = state.latest_by_key(df, "k", ["o"], ["o"])
    assert sorted(map(tuple, last.collect())) == [(1, "b"), (2, "c")]
    assert "max_by(struct(v, v#" in last._jdf.queryExecution().optimizedPlan().toString()
    whole = state.latest_by_key(df, "k", ["o", "v"])
    assert "max_by" not in whole._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, whole.collect()), key=repr) == [(1, "b", 2), (2, "c", None)]


def test_feeds_land_compressed(spark, tmp_path):
    feeds.write_csv(spark.range(5).select(F.lit('a "b"\nc').alias("x y"), "id"), f"file:{tmp_path}/1.1.a")
    assert any(f.endswith(".csv.gz") for f in os.listdir(f"{tmp_path}/1.1.a"))
    files = io.list_files(spark, f"file:{tmp_path}/1.1.a")
    assert set(io.headers(spark, files)) == {("x y", "id")}
    assert {r["x y"] for r in io.read_landing(spark, files).collect()} == {'a "b"\nc'}
