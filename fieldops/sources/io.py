"""Sources and sinks: landing-folder scans with arrival order, contract
checks, banner-skipping text feeds, provenance, versioned full-replace writes,
per-vendor extracts, catalogue export and table inventory (S1-S4, S6, S7,
S9-S12)."""

from __future__ import annotations

import csv
import os
import re
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fieldops.session import TABLES, table

FILE_NAME = "_file"


# --------------------------------------------------------------------------- S1 / S12

def read_landing(spark: SparkSession, path: str | Sequence[str], fmt: str = "csv", schema: StructType | None = None,
                 glob: str | None = None, exclude: Sequence[str] = ("_procesado",), options: Mapping | None = None,
                 drops: bool = False) -> DataFrame:
    """Read every file of a landing folder, with the source file name
    on each row (``_file``).  ``glob`` narrows by name; names containing any
    ``exclude`` marker (e.g. already-processed copies) are skipped.  With
    ``drops``, ``_file`` is the drop's name (see ``drop_name``)."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    if fmt == "csv":
        # quoted line breaks stay inside their field, and a file whose header differs from
        # the scan's is refused instead of being read by position
        defaults = {"header": "true", "multiLine": "true", "escape": '"', "enforceSchema": "false"}
        for k, v in defaults.items():
            if k not in (options or {}):
                reader = reader.option(k, v)
    df = reader.load(path if isinstance(path, str) else list(path))
    df = df.withColumn(FILE_NAME, F.col("_metadata.file_name") if not drops else drop_name())
    for marker in exclude:
        df = df.where(~F.lower(F.col(FILE_NAME)).contains(marker.lower()))
    return df


# --------------------------------------------------------------------------- S2

def arrival_key(file_name: Column, season_start_month: int = 8, season_start_year: int = 2024) -> Column:
    """Sort key from a file name that starts with 'D.M.'.

    Undated files come first (alphabetically), then dated ones by (year,
    month, day); the year is ``season_start_year`` from ``season_start_month``
    on, the next year before it (the rule is a parameter, not hard-coded)."""
    m = F.regexp_extract(file_name, r"^(\d+)\.(\d+)(\.|$)", 0)
    day = F.regexp_extract(file_name, r"^(\d+)\.(\d+)", 1).try_cast("int")
    month = F.regexp_extract(file_name, r"^(\d+)\.(\d+)", 2).try_cast("int")
    dated = (m != "") & day.isNotNull() & month.isNotNull()
    year = F.when(month >= season_start_month, F.lit(season_start_year)).otherwise(F.lit(season_start_year + 1))
    return F.struct(
        F.when(dated, F.lit(1)).otherwise(F.lit(0)).alias("dated"),
        F.when(dated, year).alias("y"), F.when(dated, month).alias("m"), F.when(dated, day).alias("d"),
        file_name.alias("name"))


def with_arrival_order(df: DataFrame, file_col: str = FILE_NAME, **kw) -> DataFrame:
    """Adds ``_arrival``, the arrival key of the row's file (a struct that
    compares in arrival order).  Nothing is ranked or joined: an ordering takes
    the key as it is."""
    return df.withColumn("_arrival", arrival_key(F.col(file_col), **kw))


def alphabetical_order(df: DataFrame, file_col: str = FILE_NAME) -> DataFrame:
    """S2 (incident variant): ``_arrival`` is the file name, compared as text."""
    return df.withColumn("_arrival", F.col(file_col))


def drop_name() -> Column:
    """The drop a scanned file belongs to: its folder, if that bears a date
    ('D.M.'), else the file itself.  Files of one drop arrive together."""
    folder = folder_name()
    return F.when(folder.rlike(r"^\d+\.\d+(\.|$)"), folder).otherwise(F.col("_metadata.file_name"))


def folder_name() -> Column:
    """The folder that holds a scanned file."""
    return F.url_decode(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))


# --------------------------------------------------------------------------- S3

def list_files(spark: SparkSession, root: str, exclude: Sequence[str] = ("_procesado",)) -> list[str]:
    """The data files below ``root`` (listed through the Hadoop file system),
    without hidden ones and names that contain an ``exclude`` marker."""
    fs, to_path = _hadoop(spark, root)
    found, out = fs.listFiles(to_path(root), True), []
    while found.hasNext():
        path = found.next().getPath()
        name = path.getName()
        if not name.startswith(("_", ".")) and not any(m.lower() in name.lower() for m in exclude):
            out.append(path.toString())
    return sorted(out)


def headers(spark: SparkSession, files: Sequence[str], sep: str = ",") -> dict[tuple[str, ...], list[str]]:
    """Column names of delimited text files -> the files that have them, in one
    Spark job: the header is the first line of a file's first split, kept by an
    aggregate that is combined map-side.  A header must be one line.  Files
    without a line are left out.  One short row per file comes back."""
    lines = (spark.read.text(list(files)).where(F.col("_metadata.file_block_start") == 0)
             .select(F.col("_metadata.file_path").alias("f"), "value", F.monotonically_increasing_id().alias("at")))
    firsts = lines.groupBy("f").agg(F.min_by("value", "at").alias("line")).select(F.url_decode("f").alias("f"), "line").collect()
    by_path = {_plain(f): f for f in files}
    out: dict[tuple[str, ...], list[str]] = {}
    for r in sorted(firsts):
        names = next(csv.reader([r["line"].lstrip("\ufeff").rstrip("\r")], delimiter=sep))
        out.setdefault(tuple(names), []).append(by_path[_plain(r["f"])])
    return out


def _plain(path: str) -> str:
    """A path without its scheme's empty authority, for comparing."""
    return re.sub(r"^file:/+", "/", path)


def contract_report(spark: SparkSession, found: Mapping[tuple[str, ...], Sequence[str]], required: Sequence[str],
                    known: Sequence[str] = ()) -> tuple[dict[tuple[str, ...], list[str]], DataFrame]:
    """S3 on the result of ``headers``: (the groups that carry every required
    column, report(file, missing, unknown)).  With ``known`` (the contract's
    columns), columns that no contract names yet are reported too.  A file that
    lacks a column is refused; unknown columns alone don't refuse it."""
    norm = lambda c: c.replace(" ", "_")
    want, contract = [norm(c) for c in required], {norm(c) for c in [*required, *known]}
    ok, report = {}, []
    for names, files in found.items():
        have = {norm(c) for c in names}
        missing = [c for c in required if norm(c) not in have]
        unknown = [c for c in names if norm(c) not in contract] if known else []
        if missing or unknown:
            report += [(os.path.basename(f), ",".join(missing), ",".join(unknown)) for f in files]
        if all(c in have for c in want):
            ok[names] = list(files)
    return ok, spark.createDataFrame(sorted(report), "file string, missing string, unknown string")


def validate_contract(spark: SparkSession, files: Sequence[str], required: Sequence[str], known: Sequence[str] = ()):
    """S3: split delimited feed files into those carrying every required column
    and the rest; only headers are looked at.  Returns (ok_files, report)."""
    ok, report = contract_report(spark, headers(spark, files), required, known)
    return [f for group in ok.values() for f in group], report


# --------------------------------------------------------------------------- S4

def read_with_banner(spark: SparkSession, path: str | Sequence[str], names: Sequence[str], skip: int = 2, sep: str = ",",
                     by_folder: bool = False) -> DataFrame:
    """Delimited text files whose first ``skip`` lines are a banner and the
    next one a header; columns are renamed by position to ``names``.  Quoted line
    breaks stay inside their field.  Lines without text don't count (nor as
    banner), records with fewer columns are filled with NULL.  ``_file`` is the
    file's name, or its folder's with ``by_folder``; ``_line`` the record's place.

    A file is read by as many tasks as it has splits (see ``sources.quoted``)."""
    from fieldops.sources.quoted import PATH, read_quoted
    rows = read_quoted(spark, path, names, skip + 1, sep)
    parts = F.split(F.col(PATH), "/")
    place = F.replace(F.element_at(parts, -2 if by_folder else -1), F.lit("+"), F.lit("%2B"))
    return rows.select(F.url_decode(place).alias(FILE_NAME), "_line", *names)


# --------------------------------------------------------------------------- S7 / S9 / S10 / S11

def _hadoop(spark: SparkSession, path: str):
    """(Hadoop file system of ``path``, function text -> Hadoop path)."""
    jvm = spark.sparkContext._jvm
    to_path = jvm.org.apache.hadoop.fs.Path
    return to_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), to_path


def _text(spark: SparkSession, path: str) -> str:
    """A small file's text, read by the driver without a job."""
    fs, to_path = _hadoop(spark, path)
    stream = fs.open(to_path(path))
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _pointers(spark: SparkSession, root: str, name: str) -> list[str]:
    """Names of a table's pointer files, oldest first.  An absent folder means
    that the table was never written; any other failure is raised."""
    fs, to_path = _hadoop(spark, root)
    folder = to_path(f"{root.rstrip('/')}/{name}/_current")
    if not fs.exists(folder):
        return []
    return sorted(n for n in (f.getPath().getName() for f in fs.listStatus(folder)) if re.fullmatch(r"\d{12}", n))


def table_exists(spark: SparkSession, root: str, name: str) -> bool:
    """Whether a version of the table was ever published (decided by listing)."""
    return bool(_pointers(spark, root, name))


def write_table(df: DataFrame, root: str, name: str, version: str) -> str:
    """Full replace without overwriting a path that may be being read:
    write a fresh version folder, then publish it by renaming a new pointer file
    into ``_current`` (the highest number counts).  Readers see the old version
    or the new one, never neither.  Returns the version path."""
    spark = df.sparkSession
    folder = f"{root.rstrip('/')}/{name}"
    target = f"{folder}/v={version}-{uuid.uuid4().hex[:8]}"
    df.write.mode("errorifexists").option("compression", "zstd").parquet(target)
    fs, to_path = _hadoop(spark, root)
    number = int((_pointers(spark, root, name) or ["-1"])[-1]) + 1
    draft = to_path(f"{folder}/_current/draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(target.rsplit("/", 1)[1].encode()))
    out.close()
    if not fs.rename(draft, to_path(f"{folder}/_current/{number:012d}")):
        raise OSError(f"another writer published version {number} of {name}")
    return target


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in a fresh folder on the shared
    checkpoint storage and read it back: cuts the lineage (a lost executor
    replays from the table, not from the sources) and lets later readers prune
    columns and push filters into the scan.  The schema is known, so no job reads
    footers for it."""
    from fieldops.session import scratch_path
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Read the current version of a table, replaced in full or keyed
    (pruning and pushdown apply)."""
    pointers = _pointers(spark, root, name)
    if not pointers:
        raise FileNotFoundError(f"no version of table {name} under {root}")
    folder = f"{root.rstrip('/')}/{name}"
    current = _text(spark, f"{folder}/_current/{pointers[-1]}").strip()
    if not current:
        raise OSError(f"empty pointer {pointers[-1]} of table {name}")
    if current.startswith("_manifests/"):
        from fieldops.sources.keyed import KeyedTable
        return KeyedTable.open(spark, root, name).read()
    return spark.read.parquet(f"{folder}/{current}")


def vendor_rows(df: DataFrame, bucket: str, vendors: Sequence[str], vendor_col: str = "vendor") -> DataFrame:
    """One row per vendor named in the bucket (case-insensitive)."""
    hits = F.filter(F.array(*[F.lit(v) for v in vendors]), lambda v: F.lower(F.col(bucket)).contains(v))
    # as a plain filter it goes down to the scan: rows of no vendor take part in no join
    df = df.where(reduce(Column.__or__, [F.lower(F.col(bucket)).contains(v) for v in vendors], F.lit(False)))
    return df.withColumn(vendor_col, F.explode(hits))


def write_vendor_extracts(df: DataFrame, out: str, vendor_col: str = "vendor") -> None:
    """All vendor extracts in one pass, one folder per vendor."""
    df.write.mode("overwrite").partitionBy(vendor_col).parquet(out)


def export_catalog(spark: SparkSession, sf_dir: str, out: str, tables: Sequence[str] = TABLES) -> list[str]:
    """Export every table, one Parquet folder each, in the same layout
    as the source (``<name>.parquet``) so the copy reads like the original."""
    done = []
    for t in tables:
        table(spark, sf_dir, t).write.mode("overwrite").parquet(f"{out.rstrip('/')}/{t}.parquet")
        done.append(t)
    return done


def stored_tables(spark: SparkSession, root: str) -> list[str]:
    """Names of the tables published under ``root``, by listing."""
    fs, to_path = _hadoop(spark, root)
    if not fs.exists(to_path(root)):
        return []
    names = sorted(f.getPath().getName() for f in fs.listStatus(to_path(root)) if f.isDirectory())
    return [n for n in names if _pointers(spark, root, n)]


def counting_session(spark: SparkSession) -> SparkSession:
    """A session of the same application in which ``count(*)`` of Parquet files is
    answered from their footers: the newer file source, with aggregates pushed down."""
    s = spark.newSession()
    s.conf.set("spark.sql.sources.useV1SourceList", ",".join(
        x for x in s.conf.get("spark.sql.sources.useV1SourceList").split(",") if x.strip() != "parquet"))
    s.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return s


def _counts(tables: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """(table_name, n_rows), one job."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows") for t, df in tables]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """Every stored table with its row count, as one DataFrame (one job
    that reads file footers; see ``counting_session``)."""
    names, s = stored_tables(spark, root), counting_session(spark)
    if not names:
        return spark.createDataFrame([], "table_name string, n_rows long")
    return _counts([(t, read_table(s, root, t)) for t in names])


def export_stored(spark: SparkSession, root: str, out: str) -> list[str]:
    """Export the current version of every stored table, one Parquet
    folder each, named like the table."""
    names = stored_tables(spark, root)
    for t in names:
        read_table(spark, root, t).write.mode("overwrite").parquet(f"{out.rstrip('/')}/{t}.parquet")
    return names


def table_counts(spark: SparkSession, sf_dir: str, tables: Sequence[str] = TABLES) -> DataFrame:
    """Table inventory with row counts, as one DataFrame (one job that
    reads file footers; see ``counting_session``)."""
    s = counting_session(spark)
    return _counts([(t, table(s, sf_dir, t)) for t in tables])
