"""Joins: enrichment, collision-safe join, as-of, interval candidates and
collection, two-stage fallback, membership (J1-J10).

Null join keys never match (SQL semantics), unlike pandas merges.

Skew: site keys are the risky ones -- assume one site may hold a third of the
rows.  The as-of and interval joins therefore never partition by the site
alone: they add a time bucket to the key, so a hot site is spread over many
tasks, and carry the few cross-bucket facts (last row of earlier buckets)
through small per-(key, bucket) aggregates.  No candidate cap is applied; the
residual time filter is exact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldops.functions.rules import micros_between


def _cols(cs: Sequence[str] | str) -> list[str]:
    return [cs] if isinstance(cs, str) else list(cs)


def _micros(ts: Column) -> Column:
    """Microseconds since the epoch of a TIMESTAMP_NTZ (zone independent)."""
    return micros_between(F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def _bucket(ts: Column, width_micros: int) -> Column:
    return F.floor(_micros(ts) / F.lit(float(width_micros))).cast("bigint")


# --------------------------------------------------------------------------- J1 / J2 / J10

def enrich(left: DataFrame, right: DataFrame, left_on: Sequence[str] | str, right_on: Sequence[str] | str | None = None,
           cols: Sequence[str] | None = None) -> DataFrame:
    """Left outer equi-join; duplicate right keys fan out.  The physical
    join (broadcast vs sort-merge) is left to AQE, which measures the right
    side at run time against ``autoBroadcastJoinThreshold``."""
    lo = _cols(left_on)
    ro = _cols(right_on) if right_on is not None else lo
    keep = [c for c in (cols if cols is not None else right.columns) if c not in ro]
    r = right.select(*[F.col(a).alias(f"_rk{i}") for i, a in enumerate(ro)], *keep)
    cond = None
    for i, a in enumerate(lo):
        c = F.col(a) == F.col(f"_rk{i}")
        cond = c if cond is None else cond & c
    return left.join(r, cond, "left").drop(*[f"_rk{i}" for i in range(len(ro))])


def join_suffix(left: DataFrame, right: DataFrame, on: Sequence[str] | str, suffix: str = "_sitios") -> DataFrame:
    """Left join where right columns that also exist on the left (other
    than the keys) get ``suffix``."""
    on = _cols(on)
    clash = {c: f"{c}{suffix}" for c in right.columns if c in left.columns and c not in on}
    return left.join(right.withColumnsRenamed(clash), on, "left")


def anti(df: DataFrame, used: DataFrame, on: str, used_on: str | None = None) -> DataFrame:
    """Rows whose key is not in ``used`` (NULLs in ``used`` removed first,
    so a NULL there cannot empty the result as NOT IN would)."""
    u = used.select(F.col(used_on or on).alias("_u")).where(F.col("_u").isNotNull()).distinct()
    return df.join(u, F.col(on) == F.col("_u"), "left_anti")


def flag_in(df: DataFrame, col: str, other: DataFrame, other_col: str, name: str,
            yes: str = "SI", no: str = "NO") -> DataFrame:
    """Membership flag.  The other side is reduced to its distinct keys
    (aggregated map-side, so it never fans the left side out) and left-joined;
    AQE broadcasts it when its measured size is small.  A join rather than a
    correlated EXISTS, so it stays correct when both sides come from the same
    source DataFrame."""
    keys = other.select(F.col(other_col).alias("_fk")).where(F.col("_fk").isNotNull()).distinct()
    keys = keys.withColumn("_fhit", F.lit(True))
    out = df.join(keys, F.col(col) == F.col("_fk"), "left")
    return out.withColumn(name, F.when(F.col("_fhit"), F.lit(yes)).otherwise(F.lit(no))).drop("_fk", "_fhit")


# --------------------------------------------------------------------------- rows without a key

SPREAD = 4096  # parts into which rows without a key are dealt


def spread_nulls(key: Column, *row: Column) -> Column:
    """0 for rows with a key, else a part number by a hash of ``row``: as a second
    key beside ``key`` it deals the rows that can't match over many tasks, where
    null alone would send all of them into one."""
    return F.when(key.isNull(), F.pmod(F.xxhash64(*row), F.lit(SPREAD))).otherwise(F.lit(0)).cast("int")


def _no_spread(key: str) -> Column:
    """0, but not a literal: the optimizer would take a literal out of the join's keys."""
    return F.pmod(F.xxhash64(key), F.lit(1)).cast("int")


def left_join_known(left: DataFrame, right: DataFrame, left_key: str, right_key: str, spread_by: Sequence[str]) -> DataFrame:
    """Left equi-join on one key whose left side is mostly null.  ``spread_by``:
    left columns that tell its rows apart.  ``right_key`` stays in the result."""
    l = left.withColumn("_spread", spread_nulls(F.col(left_key), *[F.col(f"`{c}`") for c in spread_by]))
    r = right if "_spread0" in right.columns else right.withColumn("_spread0", _no_spread(right_key))
    return l.join(r, (F.col(left_key) == F.col(right_key)) & (F.col("_spread") == F.col("_spread0")), "left").drop("_spread", "_spread0")


# --------------------------------------------------------------------------- J3 as-of

def _asof(u: DataFrame, ways: Sequence[bool], width: int, order_of: str) -> DataFrame:
    """Nearest right rows of the left rows of ``u``, per way (True: ahead) as ``_m0``, ``_m1``.

    ``u``: _by (struct of keys), _ts (micros), _tb (tie-break), _side (but for
    'self'), _r (a right row's payload, else null), _lrow (a left row, else null).  ``order_of``:
    'sides' (time, side, tie-break), 'tuple' (time, tie-break, side) or 'self'
    (time, tie-break; every row is both sides).

    One shuffle by (_by, time bucket) feeds two readers: the windows inside the buckets, and
    one summary row per bucket with its last right row, over which the carry
    from other buckets runs.  Both read the same exchange (they ask for the same
    columns, and no filter is inferred for one alone, as the join's keys are never
    null), so the inputs are read once.  Rows without a key or time can't match; their
    bucket is a hash of the row, which spreads them over the tasks."""
    known = F.col("_ts").isNotNull()
    for f in u.schema["_by"].dataType.fieldNames():
        known = known & F.col("_by")[f].isNotNull()
    b = F.coalesce(F.when(known, F.floor(F.col("_ts") / F.lit(float(width))).cast("bigint")), F.xxhash64("_lrow"))
    u = u.withColumn("_b", b).repartition("_by", "_b").withColumn("_h", F.xxhash64("_by", "_b"))  # a number first: structs sort slowly
    rows, last, carried = u, [], []
    for i, ahead in enumerate(ways):
        ts = -F.col("_ts") if ahead else F.col("_ts")
        tie = F.col("_tb").desc_nulls_last() if ahead and order_of == "self" else F.col("_tb").asc_nulls_first()
        order = {"sides": [F.col("_side"), tie], "tuple": [tie, F.col("_side")], "self": [tie]}[order_of]
        inside = Window.partitionBy("_h", "_by", "_b").orderBy(ts.asc_nulls_first(), *order).rowsBetween(Window.unboundedPreceding, -1)
        rows = rows.withColumn(f"_m{i}", F.last("_r", ignorenulls=True).over(inside))
        if ahead and order_of == "self":
            last.append(F.min_by("_r", F.when(F.col("_r").isNotNull(), F.struct("_ts", "_tb"))).alias(f"_p{i}"))
        else:
            place = [ts.alias("t"), F.col("_tb"), *([] if order_of == "self" else [F.col("_side")])]
            last.append(F.max_by("_r", F.when(F.col("_r").isNotNull(), F.struct(*place))).alias(f"_p{i}"))
        before = Window.partitionBy("_by").orderBy(F.col("_b").desc() if ahead else F.col("_b").asc()).rowsBetween(Window.unboundedPreceding, -1)
        carried.append(F.last(f"_p{i}", ignorenulls=True).over(before).alias(f"_c{i}"))
    # Whether the bucket has left rows; of a row that is always there, a hash keeps the column asked for.
    some = F.max(F.hash("_lrow")) if order_of == "self" else F.max(F.when(F.col("_lrow").isNotNull(), 1))
    summary = u.groupBy("_h", "_by", "_b").agg(some.alias("_n"), F.max(known).alias("_known"), *last).where("_known")
    prior = summary.select("_by", "_b", "_n", *carried).where(F.col("_n").isNotNull()).drop("_n")
    joined = rows.where(F.col("_lrow").isNotNull()).join(prior, ["_by", "_b"], "left")
    return joined.select("_lrow", *[F.coalesce(f"_m{i}", f"_c{i}").alias(f"_m{i}") for i in range(len(ways))])


def _unpacked(found: DataFrame, left: DataFrame, payload: Sequence[str], prefixes: Sequence[str]) -> DataFrame:
    return found.select(*[F.col(f"_lrow.`{c}`").alias(c) for c in left.columns],
                        *[F.col(f"_m{i}")[c].alias(f"{p}{c}") for i, p in enumerate(prefixes) for c in payload])


def _sides(left: DataFrame, right: DataFrame, by: Sequence[str], left_ts: str, right_ts: str, payload: Sequence[str],
           rtb: Sequence[str], ltb: Sequence[str], lside: int, rside: int) -> DataFrame:
    known = F.col(right_ts).isNotNull()
    for k in by:
        known = known & F.col(k).isNotNull()
    key = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(by)]).alias("_by")
    r = right.where(known).select(
        key, _micros(F.col(right_ts)).alias("_ts"), (F.struct(*[F.col(c) for c in rtb]) if rtb else F.lit(0)).alias("_tb"),
        F.lit(rside).alias("_side"), F.struct(*[F.col(c) for c in payload]).alias("_r"))
    l = left.select(
        key, _micros(F.col(left_ts)).alias("_ts"),
        (F.struct(*[F.col(c) for c in ltb]) if ltb else F.lit(None if rtb else 0)).cast(r.schema["_tb"].dataType).alias("_tb"),
        F.lit(lside).alias("_side"), F.lit(None).cast(r.schema["_r"].dataType).alias("_r"),
        F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("_lrow"))
    return l.unionByName(r.withColumn("_lrow", F.lit(None).cast(l.schema["_lrow"].dataType)))


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str] | str, left_ts: str, right_ts: str,
              payload: Sequence[str], right_tiebreak: Sequence[str] = (), left_tiebreak: Sequence[str] = (),
              strict: bool = True, bucket_micros: int = 86_400_000_000, prefix: str = "",
              forward: bool = False) -> DataFrame:
    """For every left row, the latest right row with the same ``by`` key
    and an earlier time (``strict``: right_ts < left_ts, else <=).  Left rows
    are all kept; payload columns are NULL when nothing matches.  With
    ``forward`` it is the earliest right row at a later time instead.

    Ties among right rows at the same time are broken by ``right_tiebreak``
    (greatest wins).  With ``left_tiebreak`` the comparison is on the tuple
    (ts, tiebreak) -- used for "immediate predecessor" on a self as-of.

    Plan (skew-safe, each side read once; see ``_asof``): the rows go by (key,
    time bucket), never by the key alone; what earlier buckets hand on comes
    from one summary row per key and bucket, whatever the row count of the key."""
    lside, rside = (0, 1) if strict or left_tiebreak else (1, 0)  # with a tiebreak, an equal tuple is the row itself
    u = _sides(left, right, _cols(by), left_ts, right_ts, list(payload), list(right_tiebreak), list(left_tiebreak), lside, rside)
    return _unpacked(_asof(u, [forward], int(bucket_micros), "tuple" if left_tiebreak else "sides"), left, list(payload), [prefix])


def asof_around(left: DataFrame, right: DataFrame, by: Sequence[str] | str, left_ts: str, right_ts: str, payload: Sequence[str],
                right_tiebreak: Sequence[str] = (), strict: bool = True, bucket_micros: int = 86_400_000_000,
                prefixes: tuple[str, str] = ("prev_", "next_")) -> DataFrame:
    """J3 both ways at once: the nearest earlier and the nearest later right row, from one shuffle."""
    u = _sides(left, right, _cols(by), left_ts, right_ts, list(payload), list(right_tiebreak), [], *((0, 1) if strict else (1, 0)))
    return _unpacked(_asof(u, [False, True], int(bucket_micros), "sides"), left, list(payload), prefixes)


def neighbours(df: DataFrame, by: Sequence[str] | str, ts: str, row_id: str, payload: Sequence[str], valid: Column | None = None,
               ways: Sequence[tuple[str, bool]] = (("prev_", False),), bucket_micros: int = 86_400_000_000) -> DataFrame:
    """The neighbours of every row in its key's (ts, row_id) order, per way a
    prefix and whether it looks ahead.  An as-of of the table on itself that
    reads it once: each row is both sides.  Rows that aren't ``valid``, or lack
    a key or time, have no neighbour and are none."""
    by = _cols(by)
    known = F.col(ts).isNotNull() if valid is None else F.coalesce(valid, F.lit(False)) & F.col(ts).isNotNull()
    for k in by:
        known = known & F.col(k).isNotNull()
    u = df.select(F.struct(*[F.when(known, F.col(k)).alias(f"k{i}") for i, k in enumerate(by)]).alias("_by"), _micros(F.col(ts)).alias("_ts"),
                  F.col(row_id).alias("_tb"), F.when(known, F.struct(*[F.col(c) for c in payload])).alias("_r"),
                  F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_lrow"))
    return _unpacked(_asof(u, [w[1] for w in ways], int(bucket_micros), "self"), df, list(payload), [w[0] for w in ways])


# --------------------------------------------------------------------------- J4 / J5 interval joins

def interval_candidates(left: DataFrame, right: DataFrame, by: Sequence[str] | str, left_id: str, left_ts: str,
                        right_ts: str, before_micros: int, after_micros: int, right_id: str,
                        payload: Sequence[str], k: int = 2, prefix: str = "cand") -> DataFrame:
    """The first ``k`` right rows (by time, then id) within
    [left_ts - before, left_ts + after] (inclusive) on the same key, as
    columns ``{prefix}_{col}_{i}``.  All left rows are kept.

    No pairs are formed: every right row carries itself and its next ``k - 1``
    rows (from its (key, bucket) window, and across its end from the heads of
    the buckets that follow), a forward as-of finds the first right row from
    the window's start on, and what lies beyond its end is cut off.  So the work
    is linear in both sides, however dense a key is."""
    by = _cols(by)
    pay = list(dict.fromkeys([right_id, *payload]))
    known = F.col(right_ts).isNotNull()
    for c in by:
        known = known & F.col(c).isNotNull()
    r = right.where(known).select(
        *[F.col(c).alias(c) for c in by], F.col(right_ts).alias("_rts"), _bucket(F.col(right_ts), max(before_micros + after_micros, 1)).alias("_b"),
        F.struct(F.col(right_ts).alias("t"), F.col(right_id).alias("i"), *[F.col(c).alias(f"p_{c}") for c in pay]).alias("_row"))
    inside = Window.partitionBy(*by, "_b").orderBy("_row.t", "_row.i")
    r = r.withColumns({"_own": F.collect_list("_row").over(inside.rowsBetween(0, k - 1)), "_place": -F.row_number().over(inside)})
    heads = r.where(F.col("_place") == -1).select(*by, "_b", "_own")
    later = Window.partitionBy(*by).orderBy("_b")
    following = [F.coalesce(F.lead("_own", i).over(later), F.expr("filter(_own, x -> false)")) for i in range(1, k)]
    if following:
        heads = heads.select(*by, "_b", F.slice(F.concat(*following), 1, k - 1).alias("_carry"))
        r = r.join(heads, [*by, "_b"]).withColumn("_next", F.slice(F.concat("_own", "_carry"), 1, k))
    else:
        r = r.withColumn("_next", F.col("_own"))
    r = r.drop("_row", "_own", "_b", *(["_carry"] if following else []))
    start = F.timestamp_add("MICROSECOND", F.lit(-before_micros), F.col(left_ts))
    x = asof_join(left.withColumn("_start", start), r, by, "_start", "_rts", ["_next"], right_tiebreak=["_place"], strict=False,
                  bucket_micros=max(before_micros + after_micros, 1), forward=True)
    end = F.timestamp_add("MICROSECOND", F.lit(after_micros), F.col(left_ts))
    x = x.withColumn("_next", F.filter("_next", lambda row: row["t"] <= end))
    return x.select(*[F.col(f"`{c}`") for c in left.columns],
                    *[F.get("_next", F.lit(i - 1))[f"p_{c}"].alias(f"{prefix}_{c}_{i}") for i in range(1, k + 1) for c in pay])


def in_reach(right: DataFrame, left: DataFrame, by: Sequence[str] | str, left_ts: str, right_ts: str, before_micros: int, after_micros: int) -> DataFrame:
    """The right rows in a time bucket of their key that the window [left_ts - before,
    left_ts + after] of some left row touches: all rows that any window holds, and few others.
    Buckets have the window's width, so a left row names two at most."""
    by = _cols(by)
    width = max(before_micros + after_micros, 1)
    valid = F.col(left_ts).isNotNull()
    for k in by:
        valid = valid & F.col(k).isNotNull()
    at = [F.floor((_micros(F.col(left_ts)) + F.lit(x)) / F.lit(float(width))).cast("bigint") for x in (-before_micros, after_micros)]
    touched = left.where(valid).select(*[F.col(k).alias(f"_by{i}") for i, k in enumerate(by)], F.explode(F.sequence(*at)).alias("_b")).distinct()
    cond = _bucket(F.col(right_ts), width) == F.col("_b")
    for i, k in enumerate(by):
        cond = cond & (F.col(k) == F.col(f"_by{i}"))
    return right.join(touched, cond, "left_semi")


def interval_collect(left: DataFrame, right: DataFrame, by: Sequence[str] | str, left_id: str, left_ts: str,
                     right_ts: str, lo_micros: int, hi_micros: int, right_id: str,
                     count_col: str = "n_matches", list_col: str = "matches") -> DataFrame:
    """Count and time-ordered id list of right rows within
    [left_ts + lo, left_ts + hi] on the same key.  No match -> (0, []);
    NULL key or time on the left -> (NULL, NULL).  The list is the result
    itself, so it is never capped.

    No pair rows are formed: the right side is one sorted array per (key, time
    bucket) with buckets of the window's width, and a left row takes its part
    of the at most two arrays that its window touches where it meets them."""
    by = _cols(by)
    width = max(hi_micros - lo_micros, 1)
    known = F.col(right_ts).isNotNull()
    valid = F.col(left_ts).isNotNull()
    for k in by:
        known, valid = known & F.col(k).isNotNull(), valid & F.col(k).isNotNull()
    entry = F.struct(F.col(right_ts).alias("t"), F.col(right_id).alias("id"))
    arrays = (right.where(known).groupBy(*[F.col(k).alias(f"_by{i}") for i, k in enumerate(by)], _bucket(F.col(right_ts), width).alias("_b"))
              .agg(F.array_sort(F.collect_list(entry)).alias("_a")))
    arrays = arrays.withColumn("_spread0", F.pmod(F.xxhash64("_b"), F.lit(1)).cast("int"))
    at = [F.floor((_micros(F.col(left_ts)) + F.lit(x)) / F.lit(float(width))).cast("bigint") for x in (lo_micros, hi_micros)]
    x = left.withColumns({"_b_0": F.when(valid, at[0]), "_b_1": F.when(valid & (at[0] != at[1]), at[1])})
    for n in (0, 1):
        x = x.withColumn("_spread", spread_nulls(F.col(f"_b_{n}"), *[F.col(f"`{c}`") for c in left.columns]))
        cond = (F.col(f"_b_{n}") == F.col("_b")) & (F.col("_spread") == F.col("_spread0"))
        for i, k in enumerate(by):
            cond = cond & (F.col(k) == F.col(f"_by{i}"))
        gap = lambda e: micros_between(F.col(left_ts), e["t"])
        met = F.transform(F.filter("_a", lambda e: (gap(e) >= lo_micros) & (gap(e) <= hi_micros)), lambda e: e["id"])
        none = F.array().cast(f"array<{right.schema[right_id].dataType.simpleString()}>")
        x = x.join(arrays, cond, "left").withColumn(f"_l_{n}", F.coalesce(met, none)).drop("_a", "_b", "_spread", "_spread0", *[f"_by{i}" for i in range(len(by))])
    x = x.withColumn(list_col, F.when(valid, F.concat("_l_0", "_l_1")))
    return x.withColumn(count_col, F.when(valid, F.size(list_col).cast("bigint"))).select(*[F.col(f"`{c}`") for c in left.columns], count_col, list_col)


# --------------------------------------------------------------------------- J6 / J8

def coalesce_join(left: DataFrame, right: DataFrame, first: tuple[str, str], second: tuple[str, str],
                  cols: Sequence[str], second_order: Sequence[str], second_when: Column | None = None,
                  source_col: str = "match_source", needed: str | None = None) -> DataFrame:
    """Join on the first key; where that finds nothing -- or only a row
    whose ``needed`` column is null or blank -- (and ``second_when`` holds), look the second key up -- right side reduced to its
    first row per key by ``second_order`` -- and take the listed columns from
    there.  ``source_col`` records 'first' / 'second' / NULL."""
    lk1, rk1 = first
    lk2, rk2 = second
    r1 = right.select(F.col(rk1).alias("_k1"), F.struct(*[F.col(c) for c in cols]).alias("_a"),
                      F.lit(True).alias("_hit1"))
    # grouped by both keys of the join below, which then needs no second shuffle
    firsts = (right.where(F.col(rk2).isNotNull())
              .groupBy(F.col(rk2).alias("_k2"), _no_spread(rk2).alias("_spread0"))
              .agg(F.min_by(F.struct(*[F.col(c) for c in cols]), F.struct(*[F.col(c) for c in second_order])).alias("_b"))
              .withColumn("_hit2", F.lit(True)))
    x = left_join_known(left, r1, lk1, "_k1", left.columns)
    gate = F.col("_hit1").isNull()
    if needed is not None:
        gate = gate | (F.trim(F.coalesce(F.col("_a")[needed].cast("string"), F.lit(""))) == "")
    if second_when is not None:
        gate = gate & F.coalesce(second_when, F.lit(False))
    x = x.withColumn("_k2l", F.when(gate, F.col(lk2)))
    x = left_join_known(x, firsts, "_k2l", "_k2", left.columns)
    out = x.withColumns({c: F.when(F.col("_hit2").isNull(), F.col("_a")[c]).otherwise(F.col("_b")[c]) for c in cols})
    out = out.withColumn(source_col, F.when(F.col("_hit2"), F.lit("second")).when(F.col("_hit1"), F.lit("first")))
    return out.drop("_k1", "_a", "_hit1", "_k2l", "_k2", "_b", "_hit2")


def first_known(df: DataFrame, row_id: str, codes: str, dim: DataFrame, dim_key: str, out: str) -> DataFrame:
    """The first code of the array (text order) that exists in ``dim``."""
    exploded = df.select(F.col(row_id).alias("_rid"), F.posexplode(F.col(codes)).alias("_pos", "_code"))
    known = dim.select(F.col(dim_key).alias("_code")).where(F.col("_code").isNotNull())
    hits = exploded.join(known, "_code", "left_semi")
    firsts = hits.groupBy("_rid").agg(F.min_by("_code", "_pos").alias(out))
    return df.join(firsts, F.col(row_id) == F.col("_rid"), "left").drop("_rid")
