"""Repeat detection (A7): a work order is a repeat when the previous order of
the same group (site, equipment) was created at most ``days`` earlier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldops import config
from fieldops.functions.rules import micros_between
from fieldops.operators.joins import neighbours


def repeat_within(df: DataFrame, keys: Sequence[str], ts: str, row_id: str, days: float = config.REPEAT_DAYS,
                  flag_col: str = "Reiteradas", prev_col: str = "TOA_Reiterado") -> DataFrame:
    """Previous row of the group in (ts, id) order; flag it when it is at
    most ``days`` older (inclusive).  Rows with a NULL or empty key are never
    flagged and never serve as a predecessor.

    The predecessor is found with the skew-safe self as-of (time buckets
    of ``days`` width, the table read once), not a window over the whole group: one group may hold a
    third of all rows."""
    valid = F.lit(True)
    for k in keys:
        valid = valid & F.col(k).isNotNull() & (F.col(k).cast("string") != "")
    width = int(days * 86_400_000_000)
    m = neighbours(df, keys, ts, row_id, [ts, row_id], valid, (("_prev_", False),), bucket_micros=max(width, 1))
    gap = micros_between(F.col(f"_prev_{ts}"), F.col(ts))
    hit = valid & F.col(f"_prev_{row_id}").isNotNull() & F.coalesce(gap <= width, F.lit(False))
    return (m.withColumn(flag_col, F.when(hit, F.lit(config.L_REPEAT)).otherwise(F.lit("")))
            .withColumn(prev_col, F.when(hit, F.col(f"_prev_{row_id}")))
            .drop(f"_prev_{ts}", f"_prev_{row_id}"))
