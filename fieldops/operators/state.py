"""Current-state tables: keep-last dedupe, upsert, duplicate checks, stage
metrics and the test-ticket review queue (A1, A2, A9, A10, A12, O4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ARRIVAL = "_arrival"


def _cols(cs: Sequence[str] | str) -> list[str]:
    return [cs] if isinstance(cs, str) else list(cs)


def latest_by_key(df: DataFrame, key: Sequence[str] | str, order: Sequence[str | Column], drop: Sequence[str] = ()) -> DataFrame:
    """A1: one row per key, the one with the greatest ``order`` (last wins).

    Written as an aggregate (``max_by`` over a struct of the row) rather than
    a window: the hash aggregate combines map-side, so a key holding a third of
    all rows still shuffles one row per map partition.  NULL keys form one
    group (as pandas ``drop_duplicates`` does).  ``order`` should be unique per
    key; NULL order fields sort lowest.  ``drop``: columns that the result lacks (of
    those in ``order`` one copy is shuffled then, not two)."""
    key = _cols(key)
    rest = [c for c in df.columns if c not in key and c not in drop]
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    if rest and set(rest) <= {o for o in order if isinstance(o, str)}:  # the order holds the row
        last = F.max(F.struct(*order_cols))
    else:
        last = F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), F.struct(*order_cols))
    agg = df.groupBy(*key).agg(last.alias("_row"))
    return agg.select(*key, *[F.col(f"_row.`{c}`").alias(c) for c in rest]).select(*[c for c in df.columns if c not in drop])


def union_all(*dfs: DataFrame) -> DataFrame:
    """Union by name; columns missing on one side are NULL."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def upsert(base: DataFrame, new: DataFrame, key: Sequence[str] | str,
           order: Sequence[str | Column] = (), base_rank: int = -1, new_rank: int = 1,
           drop: Sequence[str] = ()) -> DataFrame:
    """A2: stored rows union new rows, then keep-last per key.  Arrival decides
    first (new beats stored), then ``order`` inside one arrival.  Idempotent:
    upserting the same batch twice gives the same table."""
    b = base.withColumn(ARRIVAL, F.lit(base_rank)) if ARRIVAL not in base.columns else base
    n = new.withColumn(ARRIVAL, F.lit(new_rank)) if ARRIVAL not in new.columns else new
    both = union_all(b, n)
    return latest_by_key(both, key, [ARRIVAL, *order], [ARRIVAL, *drop])


def order_out(df: DataFrame, keys: Sequence[str | Column], descending: Sequence[bool] | None = None) -> DataFrame:
    """O1: sort for published output; NULLs last in both directions (as the
    original's sorts did).  Only for final output -- intermediate orderings
    are window orders."""
    descending = list(descending) if descending is not None else [False] * len(keys)
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    return df.orderBy(*[k.desc_nulls_last() if d else k.asc_nulls_last() for k, d in zip(cols, descending)])


def duplicate_keys(df: DataFrame, key: Sequence[str] | str) -> DataFrame:
    """Keys that occur more than once, with their count."""
    key = _cols(key)
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def stage_metrics(df: DataFrame, stage: str, cols: Sequence[str] = ()) -> DataFrame:
    """A10: one row with the row count and non-null counts of ``cols``."""
    aggs = [F.count(F.lit(1)).alias("rows")] + [F.count(F.col(c)).alias(f"nonnull_{c}") for c in cols]
    return df.agg(*aggs).select(F.lit(stage).alias("stage"), "*")


def observed(df: DataFrame, name: str, cols: Sequence[str] = ()):
    """A10 without an extra pass: attach an Observation that fills in when the
    DataFrame is next computed.  Returns (df, observation)."""
    from pyspark.sql import Observation
    obs = Observation(name)
    aggs = [F.count(F.lit(1)).alias("rows")] + [F.count(F.col(c)).alias(f"nonnull_{c}") for c in cols]
    return df.observe(obs, *aggs), obs


def review_queue(suspects: DataFrame, sheet: DataFrame, errors: DataFrame, key: str = "Nro_TOA"):
    """Test-ticket list = suspects (from notes) + confirmation sheet +
    error list; a later source wins per key.  Returns (confirmed, pending):
    pending rows have no ``Confirmado`` decision yet (the original asked a
    person at the console; here decisions arrive as the ``sheet`` table)."""
    tagged = union_all(
        suspects.withColumn("_src", F.lit(1)),
        sheet.withColumn("_src", F.lit(2)),
        errors.withColumn("_src", F.lit(3)),
    )
    merged = latest_by_key(tagged, key, ["_src"])
    confirmed = merged.where(F.col("Confirmado") == "SI")
    pending = merged.where(F.col("Confirmado").isNull())
    return merged, confirmed, pending
