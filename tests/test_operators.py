import datetime as dt
import random

from pyspark.sql import functions as F

from fieldops.operators import joins, repeat, slots, state

T0 = dt.datetime(2024, 1, 1)
HOUR = 3_600_000_000


def _events(n, keys, seed, span_h=24 * 20):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        k = rnd.choice(keys)
        out.append((i, k, T0 + dt.timedelta(minutes=rnd.randrange(span_h * 60))))
    return out


def test_asof_matches_brute_force_with_hot_key(spark):
    # key 0 holds most rows and spans many day-buckets; ties on time exist
    keys = [0] * 8 + [1, 2, None]
    left = _events(400, keys, 1)
    right = _events(300, keys, 2) + [(1000, 0, left[0][2]), (1001, 0, left[0][2])]
    ldf = spark.createDataFrame(left, "lid long, k long, ts timestamp_ntz")
    rdf = spark.createDataFrame(right, "rid long, k long, rts timestamp_ntz")
    for strict in (True, False):
        out = joins.asof_join(ldf, rdf, "k", "ts", "rts", ["rid", "rts"], right_tiebreak=["rid"], strict=strict,
                              bucket_micros=6 * HOUR)
        got = {r.lid: r.rid for r in out.collect()}
        assert len(got) == len(left) and out.count() == len(left)
        for lid, k, ts in left:
            cands = [(rts, rid) for rid, rk, rts in right
                     if rk is not None and k is not None and rk == k and (rts < ts if strict else rts <= ts)]
            assert got[lid] == (max(cands)[1] if cands else None), (lid, strict)


def test_asof_forward(spark):
    left = _events(200, [0, 1], 3)
    right = _events(150, [0, 1], 4)
    ldf = spark.createDataFrame(left, "lid long, k long, ts timestamp_ntz")
    rdf = spark.createDataFrame(right, "rid long, k long, rts timestamp_ntz")
    out = joins.asof_join(ldf, rdf, "k", "ts", "rts", ["rid"], right_tiebreak=["rid"], strict=True, forward=True,
                          bucket_micros=12 * HOUR)
    got = {r.lid: r.rid for r in out.collect()}
    for lid, k, ts in left:
        cands = [(rts, -rid, rid) for rid, rk, rts in right if rk == k and rts > ts]
        exp = min(cands)[2] if cands else None
        if exp is not None:
            same_t = [rid for rid, rk, rts in right if rk == k and rts == min(cands)[0]]
            assert got[lid] in same_t
        else:
            assert got[lid] is None


def test_interval_candidates_and_collect_boundaries(spark):
    left = spark.createDataFrame([(1, 7, T0), (2, 7, T0 + dt.timedelta(days=3)), (3, None, T0), (4, 7, None)],
                                 "lid long, k long, ts timestamp_ntz")
    rts = [T0 - dt.timedelta(hours=6), T0 + dt.timedelta(hours=6), T0 + dt.timedelta(hours=6, seconds=1),
           T0 + dt.timedelta(hours=48), T0 - dt.timedelta(hours=6, seconds=1), T0]
    right = spark.createDataFrame([(10 + i, 7, t) for i, t in enumerate(rts)], "rid long, k long, rts timestamp_ntz")
    c = joins.interval_candidates(left, right, "k", "lid", "ts", "rts", 6 * HOUR, 6 * HOUR, "rid", [], k=2,
                                  prefix="c").orderBy("lid")
    assert [tuple(r) for r in c.select("lid", "c_rid_1", "c_rid_2").collect()] == [
        (1, 10, 15), (2, None, None), (3, None, None), (4, None, None)]
    s = joins.interval_collect(left, right, "k", "lid", "ts", "rts", 0, 48 * HOUR, "rid").orderBy("lid")
    assert [tuple(r) for r in s.select("lid", "n_matches", "matches").collect()] == [
        (1, 4, [15, 11, 12, 13]), (2, 0, []), (3, None, None), (4, None, None)]


def test_latest_and_upsert_idempotent(spark):
    base = spark.createDataFrame([(1, "a", 1), (1, "a", 3), (2, "b", 1), (None, "n", 1)], "k int, v string, o int")
    new = spark.createDataFrame([(1, "new", 0), (3, "c", 1), (None, "m", 0)], "k int, v string, o int")
    lb = sorted((tuple(r) for r in state.latest_by_key(base, "k", ["o"]).collect()), key=repr)
    assert lb == sorted([(1, "a", 3), (2, "b", 1), (None, "n", 1)], key=repr)
    once = state.upsert(base, new, "k", ["o"])
    twice = state.upsert(once, new, "k", ["o"])
    a = sorted((tuple(r) for r in once.collect()), key=repr)
    assert a == sorted((tuple(r) for r in twice.collect()), key=repr)
    assert a == sorted([(1, "new", 0), (2, "b", 1), (3, "c", 1), (None, "m", 0)], key=repr)


def test_top_k_and_pivot(spark):
    df = spark.createDataFrame([(1, "canceled", 1), (1, "closed", 5), (1, "x", 2), (1, "completed", 9), (2, None, 1)],
                               "g int, st string, t int")
    top = slots.top_k(df, "g", [slots.priority("st"), F.col("t")], k=3)
    assert top.groupBy("g").count().where("count > 3").count() == 0
    wide = slots.pivot_slots(top, "g", "Orden", ["st"]).orderBy("g")
    assert [tuple(r) for r in wide.collect()] == [(1, "closed", "completed", "x"), (2, None, None, None)]


def test_compact_slots_cases(spark):
    cases = [("A", "A", "B"), ("A", "B", "B"), ("A", "A", "A"), ("A", "B", "A"), ("A", None, None)]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, a string, b string, c string")
    out = slots.compact_slots(df, ["a", "b", "c"]).orderBy("i")
    assert [tuple(r)[1:] for r in out.collect()] == [
        ("A", "B", None), ("A", "B", None), ("A", None, None), ("A", "B", "A"), ("A", "", None)]


def test_repeat_within_window(spark):
    rows = [(1, "S", "E", T0), (2, "S", "E", T0 + dt.timedelta(days=7)), (3, "S", "E", T0 + dt.timedelta(days=14, seconds=1)),
            (4, "S", "", T0), (5, "S", "", T0), (6, "S", "E", T0 + dt.timedelta(days=14, seconds=1)),
            (7, None, "E", T0)]
    df = spark.createDataFrame(rows, "id long, site string, eq string, ts timestamp_ntz")
    out = repeat.repeat_within(df, ["site", "eq"], "ts", "id", days=7).orderBy("id")
    assert [tuple(r) for r in out.select("id", "Reiteradas", "TOA_Reiterado").collect()] == [
        (1, "", None), (2, "Reiterada", 1), (3, "", None), (4, "", None), (5, "", None), (6, "Reiterada", 3),
        (7, "", None)]


def test_join_helpers(spark):
    left = spark.createDataFrame([(1, "x", None), (2, "y", "b"), (None, "z", "a")], "k int, v string, k2 string")
    right = spark.createDataFrame([(1, "x1", "a", 5), (3, "x3", "b", 1), (4, "x4", "b", 0)],
                                  "k int, v string, k2 string, o int")
    j = joins.join_suffix(left, right.select("k", "v"), "k").orderBy("v")
    assert j.columns == ["k", "v", "k2", "v_sitios"]
    c = joins.coalesce_join(left, right, ("k", "k"), ("k2", "k2"), ["v", "o"], ["o"]).orderBy("k2")
    assert sorted(((r.k, r.v, r.match_source) for r in c.collect()), key=repr) == sorted(
        [(1, "x1", "first"), (2, "x4", "second"), (None, "x1", "second")], key=repr)
    a = joins.anti(left, spark.createDataFrame([(1,), (None,)], "u int"), "k", "u")
    assert sorted(r.k or 0 for r in a.collect()) == [0, 2]
    f = joins.flag_in(left, "k", right, "k", "hit").orderBy("v")
    assert [r.hit for r in f.collect()] == ["SI", "NO", "NO"]


def test_interval_candidates_equal_brute_force_on_a_dense_site(spark):
    """Half of the rows at one site, ties in time, windows over bucket edges, null keys and times, k of 1 to 3."""
    import datetime as dt
    import random

    from fieldops.operators.joins import interval_candidates
    rng = random.Random(5)
    at = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    site = lambda i: None if i % 29 == 0 else "S0" if i % 2 else f"S{i % 7}"
    left = [(i, site(i), None if i % 31 == 0 else at(rng.randrange(0, 6000))) for i in range(300)]
    right = [(f"r{i:03d}", site(i), None if i % 37 == 0 else at(rng.randrange(0, 600) * 10), i * 2) for i in range(400)]
    l = spark.createDataFrame(left, "id long, site string, ts timestamp_ntz")
    r = spark.createDataFrame(right, "rid string, site string, rts timestamp_ntz, v long")
    six, two = dt.timedelta(hours=6), dt.timedelta(hours=2)
    for k in (1, 2, 3):
        out = interval_candidates(l, r, "site", "id", "ts", "rts", 6 * 3_600_000_000, 2 * 3_600_000_000, "rid", ["v"], k=k)
        got = {x["id"]: [(x[f"cand_rid_{i}"], x[f"cand_v_{i}"]) for i in range(1, k + 1)] for x in out.collect()}
        assert len(got) == len(left)
        for i, s, t in left:
            near = sorted((x[2], x[0], x[3]) for x in right if s and x[1] == s and t and x[2] and t - six <= x[2] <= t + two)[:k]
            assert got[i] == [(n[1], n[2]) for n in near] + [(None, None)] * (k - len(near)), i


def test_interval_collect_equals_brute_force_on_a_dense_site(spark):
    """Half of the rows at one site, ties in time, windows over bucket edges, null keys and times; no pair rows."""
    rng = random.Random(9)
    at = lambda m: T0 + dt.timedelta(minutes=m)
    site = lambda i: None if i % 29 == 0 else "S0" if i % 2 else f"S{i % 7}"
    left = [(i, site(i), None if i % 31 == 0 else at(rng.randrange(0, 600) * 10)) for i in range(300)]
    right = [(f"r{i:03d}", site(i), None if i % 37 == 0 else at(rng.randrange(0, 600) * 10)) for i in range(400)]
    l = spark.createDataFrame(left, "id long, site string, ts timestamp_ntz")
    r = spark.createDataFrame(right, "rid string, site string, rts timestamp_ntz")
    for lo, hi in ((-2, 6), (0, 48), (3, 3)):
        out = joins.interval_collect(l, r, "site", "id", "ts", "rts", lo * HOUR, hi * HOUR, "rid")
        got = {x.id: (x.n_matches, x.matches) for x in out.collect()}
        assert out.columns == ["id", "site", "ts", "n_matches", "matches"] and len(got) == len(left)
        for i, s, t in left:
            near = [x for _, x in sorted((u, x) for x, rs, u in right if s and rs == s and t and u and dt.timedelta(hours=lo) <= u - t <= dt.timedelta(hours=hi))]
            assert got[i] == ((len(near), near) if s and t else (None, None)), i
