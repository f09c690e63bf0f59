"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import struct

import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldops.sources.io import stage_table

WORD_SPACE = b" \t\n\x0b\x0c\r"  # the characters that part words: space and U+0009 to U+000D


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write to the cluster's shared folder and read back: the result is read
    several times, and a lost executor replays from the table."""
    return stage_table(df, name)


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8; null has none."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


class WordHashes:
    """word -> 64-bit hash, remembered up to a bound (a cache, not a cap)."""

    def __init__(self, most: int = 200_000):
        self.most, self.known = most, {}

    def __call__(self, words: list[bytes]) -> list[int]:
        known = self.known
        if len(known) > self.most:
            known.clear()
        out = []
        for w in words:
            h = known.get(w)
            if h is None:
                h = known[w] = xxhash.xxh3_64_intdigest(w)
            out.append(h)
        return out


def batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)],
        schema=schema)


def row_slices(rb: pa.RecordBatch, text: str = "text", most: int = 8 << 20):
    """Parts of a batch with about ``most`` bytes of text each, so that what a
    task holds in Python does not follow the longest documents' batch."""
    col = rb.column(rb.schema.get_field_index(text))
    start, size = 0, 0
    lengths = pa.compute.fill_null(pa.compute.binary_length(col), 0).to_pylist()
    for i, n in enumerate(lengths):
        if i > start and size + n > most:
            yield rb.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < rb.num_rows:
        yield rb.slice(start)


def u64(x: int) -> int:
    """A 64-bit hash as a signed long."""
    return struct.unpack("<q", struct.pack("<Q", x & 0xFFFFFFFFFFFFFFFF))[0]


def fixed(df: DataFrame, **columns: Column) -> DataFrame:
    """Columns computed once: what lies behind a generator is not inlined into
    the lambdas that use it for every element."""
    made = F.struct(*[v.alias(k) for k, v in columns.items()])
    return df.select("*", F.inline(F.array(made)))
