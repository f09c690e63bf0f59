"""Line dedup by content-defined chunks (operator 5), native.

A text's lines are hashed (the first 32 bits of their MD5).  A rolling hash over
the hashes of ``WINDOW`` neighbouring lines cuts a chunk wherever it is 0 modulo
``DIVISOR``, so that boundaries depend on the lines around them alone, and a
passage that begins at another line elsewhere is cut at the same places.  A line
of ``LONG_LINE`` words or more also ends the chunk before it and its own, so that a passage
on one line is a chunk by itself.

Chunks of two or more lines, or of one such long line, are compared over the
whole corpus: MD5s are counted (narrow rows, combined map-side), then the bytes
of every occurrence of a repeated MD5 are compared with those of its first
occurrence, and equal ones are removed.  The first occurrence, by (doc_id,
chunk number), stays.

Cases: a null text stays null and an empty one empty; empty lines are lines, but
a chunk needs a word; rows that share a doc_id and a chunk's number keep it in
each of them, as they are one document; rows with a null doc_id come after all others
as one such document; of the copies within one document the first stays; an
empty table gives an empty result; extra columns pass through (working columns
begin with ``_l_``), but for columns named like the counts, which these replace;
very long texts are cut whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldops.llm.common import documents, fixed, staged

WINDOW = 2
DIVISOR = 3
LONG_LINE = 50
RESULTS = ("n_lines", "n_chunks", "n_removed", "lines_removed")
P1, P2, MOD = 1_000_003, 998_244_353, 2_147_483_647


def _number(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 8), 16, 10).cast("long")


def _n_words(line: Column) -> Column:
    return F.size(F.filter(F.split(line, r"[\x20\x09-\x0D]+"), lambda x: x != ""))


def chunked(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``_l_lines`` and ``_l_chunks``: per chunk (k, from, n, md5),
    md5 null where the chunk is too small to compare."""
    lines = fixed(docs, _l_lines=F.split(F.col(text), "\n"))
    lines = fixed(lines, _l_h=F.transform("_l_lines", _number),
                   _l_long=F.transform("_l_lines", lambda x: (F.length(x) >= 2 * LONG_LINE - 1) & (_n_words(x) >= LONG_LINE)))
    at = lambda a, i: F.element_at(F.col(a), i.cast("int"))
    rolling = lambda i: F.pmod(F.pmod(at("_l_h", i - 1) * P1, F.lit(MOD)) + F.pmod(at("_l_h", i) * P2, F.lit(MOD)), F.lit(DIVISOR))
    ends = F.filter(F.sequence(F.lit(1), F.size("_l_lines")), lambda i: (i == F.size("_l_lines")) | at("_l_long", i)
                    | F.coalesce(at("_l_long", F.least(i + 1, F.size("_l_lines"))), F.lit(False))
                    | F.when(i > 1, rolling(F.greatest(i, F.lit(2))) == 0).otherwise(False))
    cut = fixed(lines, _l_ends=ends)
    chunk = lambda e, k: F.struct(
        k.alias("k"), F.when(k == 0, F.lit(1)).otherwise(at("_l_ends", F.greatest(k, F.lit(1))) + 1).alias("from"), e.alias("upto"))
    cut = fixed(cut, _l_spans=F.transform("_l_ends", chunk))

    def hashed(c: Column) -> Column:
        n = c["upto"] - c["from"] + 1
        body = F.array_join(F.slice("_l_lines", c["from"], n), "\n")
        fit = ((n > 1) & body.rlike(r"[^\x20\x09-\x0D]")) | at("_l_long", c["from"])
        return F.struct(c["k"].alias("k"), c["from"].alias("from"), n.alias("n"), F.when(fit, F.md5(body.cast("binary"))).alias("md5"))

    return fixed(cut, _l_chunks=F.transform("_l_spans", hashed)).drop("_l_h", "_l_long", "_l_ends", "_l_spans")


def _body(c: Column) -> Column:
    return F.array_join(F.slice("_l_lines", c["from"], c["n"]), "\n")


def _key(id_col: str, text: str) -> list[Column]:
    """A document's key: its id (null ids last) and a hash of its text."""
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(2**63 - 1)).alias("_l_id"), F.xxhash64(text).alias("_l_th")]


def removable(docs: DataFrame, spots: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(_l_id, _l_th, gone): the numbers of the chunks to remove, per document.
    ``spots``: (_l_id, _l_th, k, from, n, md5), one row per chunk to compare."""
    at = F.struct("_l_id", "k", "_l_th")
    firsts = spots.groupBy("md5").agg(F.min(at).alias("lo"), F.max(at).alias("hi")).where("lo._l_id <> hi._l_id OR lo.k <> hi.k").select("md5", "lo")
    repeated = staged(spots.join(firsts, "md5"), "line-spots")
    # The bytes of the chunks concerned, from the documents that hold them; a document holds a bounded number.
    holds = repeated.groupBy("_l_id", "_l_th").agg(F.collect_list(F.struct("k", "from", "n", "md5", "lo")).alias("_l_cs"))
    held = docs.select(*_key(id_col, text), F.col(text).alias("_l_text")).join(holds, ["_l_id", "_l_th"]).dropDuplicates(["_l_id", "_l_th"])
    held = fixed(held, _l_lines=F.split("_l_text", "\n")).select("_l_id", "_l_th", "_l_lines", F.explode("_l_cs").alias("c"))
    bodies = staged(held.select("_l_id", "_l_th", "c.k", "c.md5", "c.lo", _body(F.col("c")).alias("body")), "line-bodies")
    is_first = (F.col("_l_id") == F.col("lo._l_id")) & (F.col("k") == F.col("lo.k"))
    original = bodies.where(is_first).groupBy("md5").agg(F.min("body").alias("original"))
    return (bodies.where(~is_first).join(original, "md5").where("body = original")
            .groupBy("_l_id", "_l_th").agg(F.collect_set("k").alias("_l_gone")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with repeated chunks cut from the texts, and the columns
    ``n_lines``, ``n_chunks``, ``n_removed`` (chunks) and ``lines_removed``.

    Texts are cut into chunks once; the chunks' places are staged without the
    text, which they meet again by the document's key."""
    narrow = docs.select(F.col(id_col), F.col(text).alias("_l_text")).where(F.col(text).isNotNull())
    cut = chunked(narrow, id_col, "_l_text")
    info = staged(cut.select(*_key(id_col, "_l_text"), F.size("_l_lines").alias("_l_nl"), "_l_chunks").dropDuplicates(["_l_id", "_l_th"]), "line-chunks")
    spots = info.select("_l_id", "_l_th", F.explode(F.filter("_l_chunks", lambda c: c["md5"].isNotNull())).alias("c")).select("_l_id", "_l_th", "c.*")
    gone = removable(docs, spots, id_col, text)
    sizes = info.join(gone, ["_l_id", "_l_th"], "left")
    is_gone = lambda c: F.coalesce(F.array_contains("_l_gone", c["k"]), F.lit(False))
    left = F.filter("_l_chunks", lambda c: ~is_gone(c))
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, c: s + c["n"])
    sizes = sizes.select("_l_id", "_l_th", F.col("_l_nl").cast("long").alias("n_lines"), F.size("_l_chunks").cast("long").alias("n_chunks"),
                         F.coalesce(F.size("_l_gone"), F.lit(0)).cast("long").alias("n_removed"),
                         (F.col("_l_nl") - total(left)).cast("long").alias("lines_removed"),
                         F.when(F.col("_l_gone").isNotNull(), left).alias("_l_left"))
    key = [c.alias(f"_k{i}") for i, c in enumerate(_key(id_col, text))]
    sizes = sizes.withColumnsRenamed({c: f"_n_{c}" for c in RESULTS})
    marked = docs.select("*", *key).join(sizes, (F.col("_k0") == F.col("_l_id")) & (F.col("_k1") == F.col("_l_th")) & F.col(text).isNotNull(), "left")
    marked = fixed(marked, _l_lines=F.when(F.col("_l_left").isNotNull(), F.split(text, "\n")))
    cleaned = F.when(F.col("_l_left").isNull(), F.col(text)).otherwise(F.array_join(F.transform("_l_left", _body), "\n"))
    return marked.select(*[(cleaned.alias(c) if c == text else F.col(f"`{c}`")) for c in docs.columns if c not in RESULTS],
                         *[F.coalesce(F.col(f"_n_{c}"), F.lit(0)).cast("long").alias(c) for c in RESULTS])


def op5_line_chunks(spark, sf_dir: str) -> DataFrame:
    out = dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_chunks", "n_removed", "lines_removed", F.md5(F.col("text").cast("binary")).alias("text_md5"),
                      F.length("text").cast("long").alias("n_chars"))


ORACLE = r"""
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
x AS (SELECT doc_id, len(ls) AS n, unnest(range(1, len(ls) + 1)) AS i, unnest(ls) AS line FROM l),
y AS (SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h,
             len(list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda w: w <> '')) >= 50 AS lg FROM x),
z AS (SELECT *, i = n OR lg OR coalesce(lead(lg) OVER w, false)
             OR coalesce(((lag(h) OVER w * 1000003) % 2147483647 + (h * 998244353) % 2147483647) % 3 = 0, false) AS cut
      FROM y WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
k AS (SELECT *, coalesce(sum(cut::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k FROM z),
c AS (SELECT doc_id, k, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS body, bool_or(lg) AS lg FROM k GROUP BY doc_id, k),
f AS (SELECT *, ((n > 1 AND regexp_matches(body, '[^\x20\x09-\x0D]')) OR lg)
              AND row_number() OVER (PARTITION BY body, (n > 1 OR lg) ORDER BY doc_id, k) > 1 AS gone FROM c)
SELECT d.doc_id, coalesce(sum(f.n), 0)::BIGINT AS n_lines, count(f.k)::BIGINT AS n_chunks, coalesce(sum(gone::INT), 0)::BIGINT AS n_removed,
       coalesce(sum(f.n) FILTER (gone), 0)::BIGINT AS lines_removed,
       CASE WHEN d.text IS NOT NULL THEN md5(coalesce(string_agg(body, chr(10) ORDER BY k) FILTER (NOT gone), '')) END AS text_md5,
       CASE WHEN d.text IS NOT NULL THEN length(coalesce(string_agg(body, chr(10) ORDER BY k) FILTER (NOT gone), '')) END::BIGINT AS n_chars
FROM documents d LEFT JOIN f USING (doc_id) GROUP BY d.doc_id, d.text
"""
