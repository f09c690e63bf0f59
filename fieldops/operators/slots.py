"""Top-k per group, long->wide slots, slot compaction and slot joins
(A3, A4, A5, A6, O2, J7)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldops import config


def priority(status: Column | str, table: Mapping[str, int] = config.TASK_STATUS_PRIORITY,
             default: int = config.TASK_STATUS_PRIORITY_DEFAULT) -> Column:
    """Status -> priority number (unknown and NULL -> ``default``)."""
    s = F.col(status) if isinstance(status, str) else status
    out = None
    for k, v in table.items():
        out = F.when(s == k, F.lit(v)) if out is None else out.when(s == k, F.lit(v))
    return out.otherwise(F.lit(default))


def top_k(df: DataFrame, group: Sequence[str] | str, order: Sequence[Column], k: int = config.TASK_SLOTS,
          rank_col: str = "Orden") -> DataFrame:
    """A3/A4/O2: the first ``k`` rows of each group by ``order``, with their
    1-based rank.  ``row_number() <= k`` lets Catalyst insert a partial
    WindowGroupLimit before the shuffle, so a huge group ships at most k rows
    per map partition."""
    group = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w).cast("bigint")).where(F.col(rank_col) <= k)


def pivot_slots(df: DataFrame, key: str, rank: str, cols: Sequence[str], k: int = config.TASK_SLOTS,
                apart: Sequence[Sequence[str]] = ()) -> DataFrame:
    """A5: long -> wide, ``col_1 .. col_k``; absent slots are NULL columns.

    One struct per rank is taken with ``first``, a sort-based aggregate: behind a
    top-k its input is in the key's order already, and a list per key would be
    sorted too (a hash of objects goes over to sorting after 128 keys) and searched
    anew for every column.  ``apart``: columns with structs of their own, which (and whose
    inputs) are not worked out where nobody reads them; ``first`` takes all from the same row."""
    groups = [g for g in ([c for c in cols if all(c not in a for a in apart)], *apart) if g]
    at = {c: n for n, g in enumerate(groups) for c in g}
    ranks = range(1, k + 1)
    firsts = df.where(F.col(rank).between(1, k)).groupBy(key).agg(*[
        F.first(F.when(F.col(rank) == i, F.struct(*[F.col(c) for c in g])), ignorenulls=True).alias(f"_slot{i}_{n}") for i in ranks for n, g in enumerate(groups)])
    return firsts.select(F.col(key), *[F.col(f"_slot{i}_{at[c]}")[c].alias(f"{c}_{i}") for i in ranks for c in cols])


def compact_slots(df: DataFrame, ids: Sequence[str], companions: Sequence[Sequence[str]] = ()) -> DataFrame:
    """Remove repeated slot ids (slot values first filled with '').

    slot3 equal to slot2 -> slot3 cleared; slot2 equal to slot1 -> slot2
    cleared and slot3 (if still there) moved into slot2.  A,B,A keeps both A.
    ``companions`` are column triples that move with their slot id."""
    i1, i2, i3 = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ids]
    out = df.withColumns({"_m3": i3 == i2, "_m2": i2 == i1})
    m3, m2 = F.col("_m3"), F.col("_m2")
    updates = {}
    for g in [list(ids)] + [list(c) for c in companions]:
        v1, v2, v3 = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in g]
        updates[g[0]] = v1
        updates[g[1]] = F.when(m2, F.when(~m3, v3)).otherwise(v2)
        updates[g[2]] = F.when(m2 | m3, F.lit(None).cast("string")).otherwise(v3)
    return out.withColumns(updates).drop("_m3", "_m2")


def join_slots(df: DataFrame, key: str, slot_keys: Sequence[str], dim: DataFrame, dim_key: str,
               cols: Sequence[str]) -> DataFrame:
    """Look the same dimension up for every slot, one join in total.

    The slot keys are exploded with their position, joined once to the
    dimension (hash/sort-merge chosen by AQE from runtime sizes), and pivoted
    back to ``col_1 .. col_n``.  Three separate joins would shuffle the wide
    left side three times; here only the narrow (key, pos, slot key) rows move."""
    n = len(slot_keys)
    slots = df.select(key, F.posexplode(F.array(*[F.col(c) for c in slot_keys])).alias("_pos", "_sk"))
    slots = slots.where(F.col("_sk").isNotNull())
    d = dim.select(F.col(dim_key).alias("_sk"), *cols)
    looked = slots.join(d, "_sk", "inner").withColumn("_slot", F.col("_pos") + 1)
    wide = pivot_slots(looked, key, "_slot", list(cols), k=n)
    return df.join(wide, key, "left")
