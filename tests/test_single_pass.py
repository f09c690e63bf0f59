"""As-of joins read each side once; rows without a key are spread; plans of the reports."""

import datetime as dt
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fieldops.operators import joins, repeat
from fieldops.plans.catalog import QUERIES

from conftest import SF_SMALL

T0 = dt.datetime(2024, 1, 1)
HOUR = 3_600_000_000


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]


@pytest.mark.parametrize("name, events", [("asof_supply", 2), ("cancel_outcome", 2), ("sla_compliance", 2), ("repeat_events", 1)])
def test_each_side_is_read_once(spark, name, events):
    plan = final_plan(QUERIES[name](spark, SF_SMALL))
    assert len(re.findall(r"FileScan parquet \[[^\]]*\bevent_id", plan)) + len(re.findall(r"FileScan parquet \[ts#|FileScan parquet \[user_id#", plan)) == events
    assert "ReusedExchange" in plan


def _rows(n, seed, keys):
    r = random.Random(seed)
    return [(i, r.choice(keys), None if i % 23 == 0 else T0 + dt.timedelta(minutes=r.randrange(0, 3000) // 5 * 5)) for i in range(n)]


@pytest.mark.parametrize("strict", [True, False])
def test_both_directions_in_one_pass(spark, strict):
    left, right = _rows(300, 1, [0, 0, 0, 1, None]), _rows(200, 2, [0, 0, 1, 2, None])
    out = joins.asof_around(spark.createDataFrame(left, "id long, k long, ts timestamp_ntz"), spark.createDataFrame(right, "rid long, k long, rts timestamp_ntz"),
                            "k", "ts", "rts", ["rid"], right_tiebreak=["rid"], strict=strict, bucket_micros=5 * HOUR)
    got = {r.id: (r.prev_rid, r.next_rid) for r in out.collect()}
    assert len(got) == len(left)
    for i, k, ts in left:
        mine = [(t, j) for j, rk, t in right if k is not None and rk == k and t is not None and ts is not None]
        earlier = [x for x in mine if x[0] < ts or (not strict and x[0] == ts)]
        later = [x for x in mine if x[0] > ts or (not strict and x[0] == ts)]
        first = min((t for t, _ in later), default=None)
        assert got[i] == (max(earlier)[1] if earlier else None, max((j for t, j in later if t == first), default=None)), i


def test_neighbours_on_both_sides(spark):
    data = _rows(300, 3, ["a", "a", "b", "", None])
    df = spark.createDataFrame(data, "id long, k string, ts timestamp_ntz")
    out = joins.neighbours(df, "k", "ts", "id", ["id"], F.col("k") != "", (("prev_", False), ("next_", True)), bucket_micros=7 * HOUR)
    got = {r.id: (r.prev_id, r.next_id) for r in out.collect()}
    assert len(got) == len(data)
    line = sorted((t, i, k) for i, k, t in data if k and t is not None)
    for i, k, ts in data:
        group = [x[1] for x in line if x[2] == k]
        at = group.index(i) if k and ts is not None else None
        assert got[i] == ((None, None) if at is None else (group[at - 1] if at else None, group[at + 1] if at + 1 < len(group) else None))


@pytest.fixture
def sixteen_parts(spark):
    put = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
           "spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    was = {k: spark.conf.get(k, None) for k in put}
    for k, v in put.items():
        spark.conf.set(k, v)
    yield
    for k, v in was.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _even(df):
    sizes = Counter(r[0] for r in df.select(F.spark_partition_id()).collect())
    sizes = sorted(sizes.values())
    assert len(sizes) == 16 and sizes[-1] <= 1.5 * sizes[len(sizes) // 2], sizes


def test_rows_without_a_key_are_spread(spark, sixteen_parts):
    n = 20_000
    key = F.when(F.col("id") % 10 == 0, F.col("id") % 500)
    left = spark.range(n).select("id", key.alias("k"), (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(mins=(F.col("id") % 900).cast("int"))).alias("ts"))
    right = spark.range(500).select(F.col("id").alias("rk"), F.col("id").cast("string").alias("v"), F.lit(T0).cast("timestamp_ntz").alias("rts"), (F.col("id") * 3).alias("k2"))
    out = joins.asof_join(left, right.withColumnRenamed("rk", "k"), "k", "ts", "rts", ["v"])
    _even(out)
    assert out.where("v IS NOT NULL").count() == left.where(F.col("k").isNotNull() & (F.col("ts") > F.lit(T0).cast("timestamp_ntz"))).count()
    _even(joins.left_join_known(left, right, "k", "rk", ["id"]))
    matched = joins.coalesce_join(left.withColumn("note", F.lit(None).cast("long")), right, ("k", "rk"), ("note", "k2"), ["v"], ["v"])
    _even(matched)
    assert matched.where("match_source = 'first'").count() == n // 10
    _even(repeat.repeat_within(left.withColumn("g", F.when(F.col("k") < 250, "x")), ["k", "g"], "ts", "id"))
