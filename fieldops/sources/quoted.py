"""Delimited text with quoted line breaks, read by many tasks.

A line break ends a record only outside quotes, and whether a byte is inside
depends on all quotes before it, so such a file is usually read by one task.
Here every split is read by itself:

1. In a split, a running count of quotes gives each line's state relative to the
   split's entry, and so the records that begin there if the split is entered
   outside quotes, and if it is entered inside.
2. One row per split (parity of its quotes, both counts) goes into a prefix over the
   file's splits, which settles the state at each entry and the
   number of records before it.
3. Lines that are a whole record are cut where they are; the lines of a record
   that goes on, perhaps into the next splits, are put together by its number.

All three readers take the lines from one shuffle by split.  A quote that belongs to
a field must be doubled and the field quoted; a line ends in LF or CR LF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PATH, RECORD, TEXT = "_path", "_line", "_text"
SPLIT = [PATH, "_start"]


def records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(_path, _line, _text): the records of text files, numbered from 1 in each.
    Lines without text outside quotes are no records."""
    raw = spark.read.option("lineSep", "\n").text(path if isinstance(path, str) else list(path)).select(
        "value", F.col("_metadata.file_path").alias(PATH), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_at"))
    raw = raw.repartition(*SPLIT)
    odd = F.pmod(F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit(""))), F.lit(2))
    here = Window.partitionBy(*SPLIT).orderBy("_at")
    before = here.rowsBetween(Window.unboundedPreceding, -1)
    lines = raw.withColumns({"_odd": odd, "_blank": F.trim("value", F.lit(" \t\r")) == ""})
    lines = lines.withColumn("_turned", F.pmod(F.coalesce(F.sum("_odd").over(before), F.lit(0)), F.lit(2)))
    begins = lambda state: F.sum(F.when((F.col("_turned") == state) & ~F.col("_blank"), 1).otherwise(0))
    upto = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lines = lines.withColumns({"_n0": begins(0).over(upto), "_n1": begins(1).over(upto)})

    splits = lines.groupBy(*SPLIT).agg(F.sum("_odd").alias("_quotes"), F.max("_n0").alias("_c0"), F.max("_n1").alias("_c1"))
    earlier = Window.partitionBy(PATH).orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_state", F.pmod(F.coalesce(F.sum("_quotes").over(earlier), F.lit(0)), F.lit(2)))
    splits = splits.withColumn("_begun", F.coalesce(F.sum(F.when(F.col("_state") == 0, F.col("_c0")).otherwise(F.col("_c1"))).over(earlier), F.lit(0)))

    lines = lines.join(splits.select(*SPLIT, "_state", "_begun"), SPLIT)
    number = F.col("_begun") + F.when(F.col("_state") == 0, F.col("_n0")).otherwise(F.col("_n1"))
    outside = F.col("_turned") == F.col("_state")
    lines = lines.where(~(outside & F.col("_blank"))).select(PATH, "_start", "_at", "value", number.alias(RECORD), (outside & (F.col("_odd") == 0)).alias("_whole"))
    bare = lambda c: F.when(F.endswith(c, F.lit("\r")), F.substring(c, F.lit(1), F.length(c) - 1)).otherwise(c).alias(TEXT)
    parts = lines.where(~F.col("_whole")).groupBy(PATH, RECORD).agg(F.array_sort(F.collect_list(F.struct("_start", "_at", "value"))).alias("_parts"))
    joined = F.array_join(F.transform("_parts", lambda p: p["value"]), "\n")
    return lines.where("_whole").select(PATH, RECORD, bare(F.col("value"))).unionByName(parts.select(PATH, RECORD, bare(joined)))


def read_quoted(spark: SparkSession, path: str | Sequence[str], names: Sequence[str], skip: int = 1, sep: str = ",") -> DataFrame:
    """(_path, _line, ``names``): the records after the first ``skip`` of each file, columns
    by position as text; a record with fewer columns is filled with NULL."""
    schema = ", ".join(f"`{n}` string" for n in names)
    r = records(spark, path).where(F.col(RECORD) > skip)
    return r.select(PATH, RECORD, F.from_csv(TEXT, schema, {"escape": '"', "sep": sep}).alias("_r")).select(PATH, F.col(RECORD).cast("bigint"), *[F.col(f"_r.`{n}`") for n in names])
