"""The site table is built from three feeds (base list, swap cases, TSS
cases), all mandatory, joined on the site code."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldops.functions.clean import normalize_names, strip_literal
from fieldops.operators.joins import join_suffix

FEED_MARKERS = ("sitios", "swap", "tss")


def pick_feeds(paths: Iterable[str]) -> dict[str, str]:
    """Choose the feed files by name (case-insensitive); every feed must be
    present, otherwise the build stops (as the original did)."""
    found: dict[str, str] = {}
    for p in sorted(paths):
        name = p.rsplit("/", 1)[-1].lower()
        for m in FEED_MARKERS:
            if m in name and m not in found:
                found[m] = p
                break
    missing = [m for m in FEED_MARKERS if m not in found]
    if missing:
        raise ValueError(f"site feeds missing: {missing}")
    return found


def build_sites(base: DataFrame, swap: DataFrame, tss: DataFrame, key: str = "Codigo_Unico",
                tss_suffix: str = "_Swap") -> DataFrame:
    """Base sites left-joined to the swap and TSS feeds on the site code.

    The TSS feed's codes carry a literal suffix that is removed first; columns
    of a later feed that clash with earlier ones get the feed suffix.  Feeds
    are small per site, but nothing here assumes so: AQE picks the join."""
    tss = tss.withColumn(key, strip_literal(F.col(key).cast("string"), tss_suffix)) if tss_suffix else tss
    out = join_suffix(base, swap, key, suffix="_swap")
    out = join_suffix(out, tss, key, suffix="_tss")
    return normalize_names(out)
