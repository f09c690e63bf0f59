import tempfile

from pyspark.sql import functions as F

from fieldops.operators.state import latest_by_key
from fieldops.sources.io import read_table
from fieldops.sources.keyed import KeyedTable
from fieldops.streaming.ingest import ingest_stream

from conftest import SF_SMALL


def test_stream_in_two_drops_equals_batch(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    base = tempfile.mkdtemp(prefix="fieldops-stream-test-")
    split = F.lit("2024-01-16").cast("timestamp_ntz")
    for i, part in enumerate([ev.where(F.col("ts") < split), ev.where(F.col("ts") >= split)], start=1):
        part.write.parquet(f"{base}/landing/{i}.{i}.drop")
        ingest_stream(spark, f"{base}/landing/*", ev.schema, ["user_id", "event_type"], ["ts", "event_id"],
                      f"{base}/tables", "ev", f"{base}/ckpt").awaitTermination()
    # a rerun with no new files changes nothing
    ingest_stream(spark, f"{base}/landing/*", ev.schema, ["user_id", "event_type"], ["ts", "event_id"],
                  f"{base}/tables", "ev", f"{base}/ckpt").awaitTermination()
    got = sorted(tuple(r) for r in read_table(spark, f"{base}/tables", "ev").select(*ev.columns).collect())
    exp = sorted(tuple(r) for r in latest_by_key(ev, ["user_id", "event_type"], ["ts", "event_id"]).collect())
    assert got == exp


def _drops(spark, base, parts, **more):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    for day, rows in parts(ev):
        rows.write.parquet(f"{base}/landing/{day}.1.drop")
        ingest_stream(spark, f"{base}/landing/*", ev.schema, ["user_id", "event_type"], ["ts", "event_id"],
                      f"{base}/tables", "ev", f"{base}/ckpt", parts="user_id div 10", **more).awaitTermination()
        yield KeyedTable.open(spark, f"{base}/tables", "ev")


def test_a_batch_writes_the_folders_of_changed_keys_alone(spark):
    base = tempfile.mkdtemp(prefix="fieldops-stream-test-")
    few = "user_id in (1, 2) and event_type = 'click'"
    late = F.timestamp_add("DAY", F.lit(90), F.col("ts"))
    versions = list(_drops(spark, base, lambda ev: [(1, ev), (2, ev.where(few).withColumn("ts", late)), (3, ev.where(few).withColumn("ts", late))]))
    first, second, third = (v.folders for v in versions)
    assert len(first) > 1 and {p for p in first if first[p] != second[p]} == {0}
    assert third == second  # a replayed batch writes nothing
    # what the second version replaced goes with the next one
    assert versions[1].read().where(few).count() == 2


def test_stateful_stream_equals_one_batch_whatever_the_order_of_arrival(spark):
    base = tempfile.mkdtemp(prefix="fieldops-stream-test-")
    split = F.lit("2024-01-16").cast("timestamp_ntz")
    tagged = lambda df, v: df.withColumn("value", F.lit(v))
    # the drop of the 9th lands before that of the 2nd, which has newer times
    *_, last = _drops(spark, base, lambda ev: [(9, tagged(ev.where(F.col("ts") < split), 9.0)), (2, tagged(ev, 2.0))], stateful=True)
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    both = tagged(ev.where(F.col("ts") < split), 9.0).withColumn("_d", F.lit(9)).unionByName(tagged(ev, 2.0).withColumn("_d", F.lit(2)))
    want = latest_by_key(both, ["user_id", "event_type"], ["_d", "ts", "event_id"]).drop("_d")
    got = read_table(spark, f"{base}/tables", "ev").select(*ev.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert last.read().where("value = 9.0").count() > 0
