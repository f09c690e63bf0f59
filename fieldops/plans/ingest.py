"""Batch state builds from feeds: W1 (landing folder into a current-state table)
and the incident state (banner feeds, latest file wins, vendor groups).

W7 (``streaming.ingest``) is the incremental form of W1."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldops import config
from fieldops.functions import clean
from fieldops.functions.rules import any_marker
from fieldops.operators.state import latest_by_key, union_all, upsert
from fieldops.sources.sites import build_sites, pick_feeds
from fieldops.sources.io import (
    FILE_NAME, alphabetical_order, contract_report, headers, read_landing, read_table, read_with_banner, table_exists, with_arrival_order,
    write_table,
)

LINE = "_line"


def place_in_file():
    """Orders the rows of a scan by file, then by line (a task reads a file in order)."""
    return F.struct(F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("at"))


def ingest(spark: SparkSession, files: Sequence[str], key: Sequence[str] | str, contract: Mapping[str, str],
           root: str, name: str, version: str, required: Sequence[str] = (), order: Sequence[str] = (),
           drop: Sequence[str] = ("Mes",), rename: Mapping[str, str] | None = None, project: Sequence[str] | None = None,
           strip_marker: Sequence[str] = (), make_key: Sequence[str] = (), source_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Files lacking a required column are reported and skipped (S3); the
    rest are read with the name of their drop (S1/S12), ordered by arrival (S2),
    names normalised, typed by contract (C7/C4), then upserted into the stored
    table (A2) and published as a new version (S7).  Returns (new current table,
    contract report); with no acceptable file the stored table stays.

    ``rename`` renames feed columns and ``project`` keeps only those named (both
    before names are normalised); ``strip_marker`` columns lose the old-status
    marker (C9); ``make_key`` columns are joined into the key column ``Index``
    (C12); ``source_col`` keeps the drop's name under that name.  The cast comes
    before the keep-last, so keys compare as typed values.  Within one drop
    ``order`` decides, then the row's place in its file: the last row stays."""
    found = headers(spark, files) if files else {}
    ok, report = contract_report(spark, found, required, [*contract, *drop, *(rename or {})])
    if not ok:
        return read_table(spark, root, name), report
    parts = []
    for group in ok.values():  # one reader per distinct header: text feeds may order (or omit) columns differently
        part = read_landing(spark, group, exclude=(), drops=True).withColumn(LINE, place_in_file())
        part = part.withColumnsRenamed(dict(rename or {}))
        if project is not None:
            part = part.select(*[F.col(f"`{c}`") for c in [*project, FILE_NAME, LINE]])
        parts.append(clean.normalize_names(part))
    new = clean.drop_if(with_arrival_order(union_all(*parts)), list(drop))
    new = clean.apply_contract(new, contract)
    for c in strip_marker:
        new = new.withColumn(c, clean.strip_literal(c, config.OLD_STATUS_MARKER))
    if make_key:
        new = new.withColumn("Index", clean.composite_key(*make_key))
    new = new.withColumnRenamed("_arrival", "_drop_rank")
    new = new.withColumnRenamed(FILE_NAME, source_col) if source_col else new.drop(FILE_NAME)
    # only a table never published is a first load; one that cannot be read is an error
    base = read_table(spark, root, name) if table_exists(spark, root, name) else new.limit(0).drop("_drop_rank", LINE)
    keys = [key] if isinstance(key, str) else list(key)
    merged = upsert(base, new, keys, ["_drop_rank", *order, LINE], drop=["_drop_rank", LINE])
    write_table(merged, root, name, version)
    return read_table(spark, root, name), report


def incident_state(spark: SparkSession, files: str | Sequence[str], root: str, name: str, version: str,
                   by_folder: bool = False) -> DataFrame:
    """The incident state table: banner feeds (S4) in alphabetical order of
    their files (S2), date texts read day-first where they aren't ISO (C5), the
    row of the last file (there the last line) per incident (A2), then only the
    vendor groups (P2; a null group is no vendor's).  Dates are stored as text
    (C6).  A group is judged on an incident's latest row alone."""
    dates = list(config.INCIDENT_DATES)
    new = read_with_banner(spark, files, config.INCIDENT_COLUMNS, by_folder=by_folder)
    new = alphabetical_order(new).drop(FILE_NAME)
    new = new.withColumns({c: clean.fmt_ts(clean.parse_ts(c, config.INCIDENT_DATE_FORMATS)) for c in dates})
    new = new.withColumnRenamed("_arrival", "_drop_rank")
    base = read_table(spark, root, name) if table_exists(spark, root, name) else new.limit(0).drop("_drop_rank", LINE)
    merged = upsert(base, new, "ID_incidencia", ["_drop_rank", LINE], drop=["_drop_rank", LINE])
    write_table(merged.where(any_marker("Grupo_asignado", config.VENDOR_GROUPS)), root, name, version)
    return read_table(spark, root, name)


def site_state(spark: SparkSession, files: Sequence[str], root: str, name: str, version: str) -> DataFrame:
    """The site state table from its three feeds (picked by name, all
    mandatory).  Each feed is reduced to the last row of a site before the join,
    so that no repeated code fans out, and the result is upserted (A2)."""
    feeds = pick_feeds(files)

    def last(feed: str, columns: Sequence[str] | None = None, renames: Mapping[str, str] | None = None) -> DataFrame:
        df = read_landing(spark, feeds[feed], exclude=()).withColumn(LINE, place_in_file()).drop(FILE_NAME)
        if columns:
            df = df.select(*[F.col(f"`{c}`") for c in columns], LINE)
        df = df.withColumnsRenamed(dict(renames or {}))
        if feed == "tss":
            df = df.withColumn(config.SITE_KEY, clean.strip_literal(f"`{config.SITE_KEY}`", config.TSS_SUFFIX))
        df = clean.normalize_names(df)
        return latest_by_key(df, config.SITE_KEY.replace(" ", "_"), [LINE]).drop(LINE)

    key = config.SITE_KEY.replace(" ", "_")
    new = build_sites(last("sitios"), last("swap", config.SWAP_COLUMNS, config.SWAP_RENAMES), last("tss", None, config.TSS_RENAMES),
                      key=key, tss_suffix="")
    base = read_table(spark, root, name) if table_exists(spark, root, name) else new.limit(0)
    write_table(upsert(base, new, key), root, name, version)
    return read_table(spark, root, name)
