"""Stored state survives faults; arrival goes by drop; casts and keys have no silent limits."""

import os

import pytest
from pyspark.sql import functions as F

from fieldops.functions.clean import canon_id, to_integer, zero_fill
from fieldops.operators import joins
from fieldops.operators.state import latest_by_key
from fieldops.plans import catalog, roles
from fieldops.plans.ingest import ingest
from fieldops.session import ensure_checkpoint_dir
from fieldops.sources import io
from fieldops.streaming.ingest import ingest_stream

from conftest import SF_SMALL


@pytest.mark.parametrize("files", [1, 5])
def test_stream_with_several_files_per_drop(spark, tmp_path, files):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    split = F.lit("2024-01-16").cast("timestamp_ntz")
    for i, part in enumerate([ev.where(F.col("ts") < split), ev.where(F.col("ts") >= split)], start=1):
        part.repartition(files).write.parquet(f"file:{tmp_path}/landing/{i}.{i}.drop")
    ingest_stream(spark, f"file:{tmp_path}/landing/*", ev.schema, ["user_id", "event_type"], ["ts", "event_id"],
                  f"file:{tmp_path}/tables", "ev", f"file:{tmp_path}/ckpt").awaitTermination()
    got = sorted(tuple(r) for r in io.read_table(spark, f"file:{tmp_path}/tables", "ev").select(*ev.columns).collect())
    assert got == sorted(tuple(r) for r in latest_by_key(ev, ["user_id", "event_type"], ["ts", "event_id"]).collect())


def _csv(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return f"file:{path}"


def test_unreadable_pointer_stops_batch_and_stream(spark, tmp_path):
    root = f"file:{tmp_path}/tables"
    f = _csv(f"{tmp_path}/in/1.1.a.csv", "k,v\n1,a\n2,b\n")
    ingest(spark, [f], "k", {"k": "INTEGER"}, root, "t", "0")
    kept = sorted(os.listdir(f"{tmp_path}/tables/t"))
    pointer = f"{tmp_path}/tables/t/_current/000000000000"
    crc = f"{tmp_path}/tables/t/_current/.000000000000.crc"
    if os.path.exists(crc):
        os.remove(crc)
    with open(pointer, "w") as out:
        out.write("v=missing")
    with pytest.raises(Exception, match="missing|PATH_NOT_FOUND"):
        ingest(spark, [_csv(f"{tmp_path}/in/2.1.a.csv", "k,v\n3,c\n")], "k", {"k": "INTEGER"}, root, "t", "1")
    df = spark.createDataFrame([(9, "z")], "k long, v string")
    df.write.parquet(f"file:{tmp_path}/landing/1.1.drop")
    with pytest.raises(Exception, match="missing|PATH_NOT_FOUND"):
        ingest_stream(spark, f"file:{tmp_path}/landing/*", df.schema, ["k"], [], root, "t", f"file:{tmp_path}/ckpt").awaitTermination()
    assert sorted(os.listdir(f"{tmp_path}/tables/t")) == kept


def test_quoted_line_breaks_and_differing_headers(spark, tmp_path):
    _csv(f"{tmp_path}/a/1.csv", 'id,notes,state\n1,"first\nsecond ""x""",open\n')
    assert [tuple(r) for r in io.read_landing(spark, f"file:{tmp_path}/a").select("id", "notes", "state").collect()] == [("1", 'first\nsecond "x"', "open")]
    _csv(f"{tmp_path}/b/1.csv", "id,state\nT1,open\n")
    _csv(f"{tmp_path}/b/2.csv", "state,id\nopen,T2\n")
    with pytest.raises(Exception, match="(?i)header|column"):
        io.read_landing(spark, f"file:{tmp_path}/b").collect()


def test_casts_never_end_the_job(spark):
    df = spark.createDataFrame([("99999999999999999999",), ("1" + "0" * 30,), ("1" * 50,), ("2.5",), ("12.0",), ("x",), (None,)], "s string")
    got = [tuple(r) for r in df.select(to_integer("s"), canon_id("s")).collect()]
    assert got == [(None, "99999999999999999999"), (None, "1" + "0" * 30), (None, "1" * 50), (2, "00000002"), (12, "00000012"), (None, "x"), (None, None)]


def test_second_lookup_where_the_first_hit_has_no_order(spark):
    left = spark.createDataFrame([(1, "n1"), (2, "n2"), (3, "n3")], "k long, note string")
    right = spark.createDataFrame([(1, None, None), (2, "A", "A"), (7, "n1", "n1"), (8, "n3", "n3")], "rk long, num string, nk string")
    out = joins.coalesce_join(left, right, ("k", "rk"), ("note", "nk"), ["num"], ["num"], needed="num").orderBy("k")
    assert [(r.num, r.match_source) for r in out.collect()] == [("n1", "second"), ("A", "first"), ("n3", "second")]


def test_keys_beyond_their_width_stay_distinct(spark):
    keys = [0, 99_999, 100_000, 123_456, 1_234_567, 2_599_999, 2_600_000, 10_000_000, 12_600_000, 90_000_000, 123_456_789]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for code in (catalog.site_code, roles.site_code, lambda c: zero_fill(c, 7), roles.toa_number):
        assert df.select(code(F.col("k"))).distinct().count() == len(keys)


def test_no_checkpoint_folder_on_a_cluster_raises():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())
