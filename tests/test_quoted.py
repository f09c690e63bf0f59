"""Feeds with quoted line breaks, read by many tasks, equal the reader that takes a file as a whole."""

import random

import pytest
from pyspark.sql import functions as F

from fieldops.sources import io, quoted


@pytest.fixture
def small_splits(spark):
    put = {"spark.sql.files.maxPartitionBytes": "400", "spark.sql.files.openCostInBytes": "1"}
    was = {k: spark.conf.get(k) for k in put}
    for k, v in put.items():
        spark.conf.set(k, v)
    yield
    for k, v in was.items():
        spark.conf.set(k, v)


def _field(r):
    body = "".join(r.choice(['a', 'é', ' ', ',', '""', '\n', '\n\n', '1', 'xyz']) for _ in range(r.choice([0, 1, 3, 9])))
    quote = r.random() < .5 or any(c in body for c in ',"\n\r')
    return f'"{body}"' if quote else body


def _feed(r, n, end):
    """One line end per file: the whole-file reader guesses it from the file's first line break, inside quotes or not."""
    lines = [",".join(["k%d" % i, *(_field(r) for _ in range(3))]) for i in range(n)]
    return "".join(x + r.choice([end, end, 2 * end]) for x in lines)


def test_random_quoting_equals_the_whole_file_reader(spark, tmp_path, small_splits):
    r = random.Random(4)
    for i in range(4):
        (tmp_path / f"{i}.csv").write_bytes(_feed(r, 200, "\n").encode())
    (tmp_path / "9.csv").write_bytes(('k0,"' + "long\n" * 800 + '",x,""\nk1,,,\n').encode())  # one record over many splits
    (tmp_path / "empty.csv").write_bytes(b"")
    names = ["k", "a", "b", "c"]
    raw = spark.read.option("lineSep", "\n").text(f"file:{tmp_path}").select("_metadata.file_path", "_metadata.file_block_start")
    assert raw.distinct().count() > 40  # splits
    got = quoted.read_quoted(spark, f"file:{tmp_path}", names, skip=0)
    want = (spark.read.schema(", ".join(f"{n} string" for n in names)).option("multiLine", "true").option("escape", '"').csv(f"file:{tmp_path}")
            .where("k IS NOT NULL OR a IS NOT NULL"))
    assert sorted(map(repr, got.select(*names).collect())) == sorted(map(repr, want.collect()))
    for path, rows in got.groupBy("_path").agg(F.array_sort(F.collect_list(F.struct("_line", "k"))).alias("r")).collect():
        assert [tuple(x) for x in rows] == [(i + 1, f"k{i}") for i in range(len(rows))], path


def test_lines_that_end_in_cr_lf(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_bytes("".join(f'k{i},"x\r\ny{i}",z\r\n\r\n' for i in range(200)).encode())
    got = quoted.read_quoted(spark, f"file:{tmp_path}", ["k", "a", "b"], skip=0)
    assert sorted(map(tuple, got.select("k", "a", "b").collect())) == sorted((f"k{i}", f"x\r\ny{i}", "z") for i in range(200))


def test_banner_is_skipped_per_file_whatever_the_splits(spark, tmp_path, small_splits):
    for name in ("a b+c.txt", "z.txt"):
        rows = "".join(f'{name}{i},"first\nsecond, ""{i}"""\n' for i in range(300))
        (tmp_path / name).write_text('Reporte "del\ndía"\n\nGenerado\nID,Nota\n' + rows)
    got = io.read_with_banner(spark, f"file:{tmp_path}/*.txt", ["ID", "Nota"])
    assert sorted(map(tuple, got.select("_file", "_line", "ID", "Nota").collect())) == sorted(
        (name, i + 4, f"{name}{i}", f'first\nsecond, "{i}"') for name in ("a b+c.txt", "z.txt") for i in range(300))
    assert got.rdd.getNumPartitions() > 1
