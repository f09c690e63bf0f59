"""Quality rules with adaptive thresholds (operator 8).

Per document a few counts are taken in one Arrow pass; four ratios derived from
them go into mergeable quantile sketches per (lang, source).  A sketch is a set
of (bin, count) rows with logarithmic bins of relative width ``2 * ACCURACY``
(DDSketch), so sketches merge by adding counts: partial aggregation merges them
map-side, and small groups fall back to the merged sketch of their language,
then of the corpus.  The thresholds come from those quantiles and
are joined back to the documents for the verdict.

Symbols, repeated lines and repeated words are 0 in most texts, so quartiles say
nothing of them; their fence lies above what nine tenths of a group's
texts have, by a share of a quartile of the group's values that aren't 0.  The mean
word length has fences on both sides, by the quartile range.

Cases: null text counts as empty (0 words, hence ``base_failed``); null lang or
source form groups of their own; repeated rows each count and each get a row;
an empty table gives an empty result; very long texts are counted whole; a value on
its fence stays (ties stay together); extra columns are ignored by
``measure``/``judge`` and passed through by ``filter_documents``, whose working
columns all begin with ``_q_``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldops.llm.common import WORD_SPACE, WordHashes, row_slices, staged

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
ACCURACY = 0.01  # relative error of a quantile
GAMMA = (1 + ACCURACY) / (1 - ACCURACY)
MIN_GROUP = 200  # documents a group needs for thresholds of its own
MIN_SEEN = 20  # and values that aren't 0, where the fence rests on them
#: metric -> (quartile of the values that aren't 0, its share, least distance): fences above the 90 % quantile
RARE = {"sym": ("z25", 0.5, 0.1), "dup": ("z75", 1.5, 0.1), "rep": ("z75", 1.5, 0.05)}
#: metric -> (factor on the quartile range, least quartile range): fences on both sides of the quartiles
USUAL = {"wlen": (6.0, 0.5)}
FENCES = [*RARE, *USUAL]
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def text_counts(text: str | None, hashes: WordHashes, weights: np.ndarray) -> tuple[int, ...]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines) of a text;
    n_lines: lines that hold a word."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    chars = len(text) - (len(raw) - len(raw.translate(None, WORD_SPACE)))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip(WORD_SPACE)]
    repeated = 0
    if n > WINDOW:
        h = np.array(hashes(words), dtype=np.uint64)
        k = n - WINDOW + 1
        keys = np.zeros(k, dtype=np.uint64)
        for j in range(WINDOW):
            keys += h[j:j + k] * weights[j]
        _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
        hit = np.flatnonzero(counts[inverse] > 1)
        if len(hit):
            edge = np.zeros(n + 1, dtype=np.int64)
            np.add.at(edge, hit, 1)
            np.add.at(edge, hit + WINDOW, -1)
            repeated = int((np.cumsum(edge[:-1]) > 0).sum())
    return n, chars, symbols, len(lines) - len(set(lines)), repeated, len(lines)


def _counting(text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        weights = np.random.default_rng(8).integers(1, 1 << 62, WINDOW, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for whole in batches:
            for rb in row_slices(whole, text):
                rows = [text_counts(t, hashes, weights) for t in rb.column(rb.schema.get_field_index(text)).to_pylist()]
                columns = [pa.array(list(c), pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 6
                kept = [(f, c) for f, c in zip(rb.schema, rb.columns, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [c for _, c in kept] + columns,
                    names=[f.name for f, _ in kept] + ["_q_" + c for c in COUNTS])
    return run


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts of each text as ``_q_*`` columns."""
    schema = ", ".join([f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema]
                       + [f"_q_{c} bigint" for c in COUNTS])
    return docs.mapInArrow(_counting(text), schema)


def base_failed(prefix: str = "_q_") -> Column:
    n, rep = F.col(prefix + "n_words"), F.col(prefix + "n_repeat_words")
    return (n < 20) | (100 * rep > 30 * n)


def _ratios(prefix: str = "_q_") -> dict[str, Column]:
    c = lambda x: F.col(prefix + x).cast("double")
    n, lines = F.greatest(c("n_words"), F.lit(1.0)), F.greatest(c("n_lines"), F.lit(1.0))
    return {"sym": c("n_symbols") / n, "dup": c("n_dup_lines") / lines, "rep": c("n_repeat_words") / n, "wlen": c("word_chars") / n}


def sketches(counted: DataFrame) -> DataFrame:
    """(lang, source, metric, bin, n): one sketch per group and metric.  Bin
    null holds the zeros; bin b the values in (GAMMA^(b-1), GAMMA^b].  Bins are
    few (a value's order of magnitude over the accuracy), so map-side partial
    counts are small whatever the rows of a group."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), v.alias("v")) for m, v in _ratios().items()])
    return (counted.select(F.col("_q_lang").alias("lang"), F.col("_q_source").alias("source"), F.explode(pairs).alias("p"))
            .select("lang", "source", "p.metric",
                    F.when(F.col("p.v") > 0, F.ceil(F.log(F.col("p.v")) / F.lit(math.log(GAMMA)))).cast("int").alias("bin"))
            .groupBy("lang", "source", "metric", "bin").agg(F.count(F.lit(1)).alias("n")))


def merge(sketch: DataFrame, *keys: str) -> DataFrame:
    """Sketches merged to coarser ``keys``: counts of a bin add up."""
    return sketch.groupBy(*keys, "metric", "bin").agg(F.sum("n").alias("n"))


QUANTILES = {"q25": 0.25, "q75": 0.75, "q90": 0.9}
QUANTILES_SEEN = {"z25": 0.25, "z75": 0.75}  # of the values that aren't 0


def quantiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, metric, n, seen, quantiles) from sketches; a quantile is the first bin
    at or over its rank, as the bin's middle value."""
    w = Window.partitionBy(*keys, "metric")
    ordered = w.orderBy(F.col("bin").asc_nulls_first())
    some = F.when(F.col("bin").isNotNull(), F.col("n")).otherwise(0)
    run = sketch.select("*", F.sum("n").over(ordered).alias("upto"), F.sum("n").over(w).alias("total"),
                        F.sum(some).over(ordered).alias("seen_upto"), F.sum(some).over(w).alias("seen"))
    value = F.when(F.col("bin").isNull(), F.lit(0.0)).otherwise(F.lit(2.0) * F.pow(F.lit(GAMMA), F.col("bin")) / F.lit(GAMMA + 1))
    at = [F.min(F.when(F.col("upto") >= F.ceil(F.lit(q) * F.col("total")), value)).alias(k) for k, q in QUANTILES.items()]
    at += [F.min(F.when(F.col("bin").isNotNull() & (F.col("seen_upto") >= F.ceil(F.lit(q) * F.col("seen"))), value)).alias(k) for k, q in QUANTILES_SEEN.items()]
    return run.groupBy(*keys, "metric").agg(F.max("total").alias("n"), F.max("seen").alias("seen"), *at)


def thresholds(counted: DataFrame) -> DataFrame:
    """One row per (lang, source) of the texts that pass the base rule, and from
    their sketches: ``<metric>_lo`` and ``<metric>_hi`` fences from the narrowest of group, language and corpus that has ``MIN_GROUP``
    documents and ``MIN_SEEN`` values (the corpus whatever it has)."""
    fine = staged(sketches(counted.where(~base_failed())), "quality-sketches")
    group = quantiles(fine, ["lang", "source"])
    lang = quantiles(merge(fine, "lang"), ["lang"])
    corpus = quantiles(merge(fine), [])
    g, a, c = group.alias("g"), lang.alias("a"), corpus.alias("c")
    enough = lambda x: (F.col(f"{x}.n") >= MIN_GROUP) & (F.col("g.metric").isin(*USUAL) | (F.col(f"{x}.seen") >= MIN_SEEN))
    picked = (g.join(a, (F.col("g.lang").eqNullSafe(F.col("a.lang"))) & (F.col("g.metric") == F.col("a.metric")))
              .join(c, F.col("g.metric") == F.col("c.metric"))
              .select("g.lang", "g.source", "g.metric", *[
                  F.when(enough("g"), F.col(f"g.{q}")).when(enough("a"), F.col(f"a.{q}"))
                  .otherwise(F.col(f"c.{q}")).alias(q) for q in (*QUANTILES, *QUANTILES_SEEN)]))
    out = []
    for m, (z, share, least) in RARE.items():
        out.append(F.max(F.when(F.col("metric") == m, F.col("q90") + F.greatest(F.lit(share) * F.coalesce(z, F.lit(0.0)), F.lit(least)))).alias(f"{m}_hi"))
        out.append(F.lit(-1.0).alias(f"{m}_lo"))
    for m, (k, least) in USUAL.items():
        spread = F.lit(k) * F.greatest(F.col("q75") - F.col("q25"), F.lit(least))
        out.append(F.max(F.when(F.col("metric") == m, F.col("q75") + spread)).alias(f"{m}_hi"))
        out.append(F.max(F.when(F.col("metric") == m, F.col("q25") - spread)).alias(f"{m}_lo"))
    return picked.groupBy("lang", "source").agg(*out)


def judge(counted: DataFrame, limits: DataFrame) -> DataFrame:
    """``counted`` with ``_q_base_failed`` and ``_q_kept``: joined filtering
    against the group's thresholds."""
    t = limits.select(F.col("lang").alias("_q_tl"), F.col("source").alias("_q_ts"),
                      *[F.col(f"{m}_{e}").alias(f"_q_{m}_{e}") for m in FENCES for e in ("hi", "lo")])
    inside = F.lit(True)
    for m, v in _ratios().items():
        inside = inside & (v <= F.col(f"_q_{m}_hi")) & (v >= F.col(f"_q_{m}_lo"))
    return (counted.join(t, F.col("_q_lang").eqNullSafe(F.col("_q_tl")) & F.col("_q_source").eqNullSafe(F.col("_q_ts")), "left")
            .withColumn("_q_base_failed", base_failed())
            .withColumn("_q_kept", ~F.col("_q_base_failed") & inside))


def _measured(docs: DataFrame, id_col: str, text: str, lang: str, source: str) -> DataFrame:
    narrow = docs.select(F.col(id_col).alias("_q_id"), F.col(lang).alias("_q_lang"), F.col(source).alias("_q_source"), F.col(text).alias("_q_text"))
    return measure(narrow, "_q_text").drop("_q_text")


def quality_report(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per document: its counts, ``base_failed`` and ``kept``."""
    counted = staged(_measured(docs, id_col, text, lang, source), "quality-counts")
    return judge(counted, thresholds(counted)).select(
        F.col("_q_id").alias(id_col), *[F.col("_q_" + c).alias(c) for c in COUNTS],
        F.col("_q_base_failed").alias("base_failed"), F.col("_q_kept").alias("kept"))


def filter_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``docs`` that pass, with the same columns.  Texts are
    counted twice, once for the sketches and once where they are, instead of
    being shuffled to meet their verdict."""
    counted = staged(_measured(docs, id_col, text, lang, source), "quality-counts")
    whole = measure(docs.select(F.col(text).alias("_q_text"), F.col(lang).alias("_q_lang"), F.col(source).alias("_q_source"),
                                F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("_q_row")), "_q_text")
    kept = judge(whole, thresholds(counted)).where("_q_kept")
    return kept.select(*[F.col("_q_text").alias(c) if c == text else F.col(f"_q_row.`{c}`").alias(c) for c in docs.columns])


def op8_adaptive_quality(spark, sf_dir: str) -> DataFrame:
    from fieldops.llm.common import documents
    return quality_report(documents(spark, sf_dir))


#: The same verdicts by plain SQL over the whole table.
ORACLE = r"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, row_number() OVER () AS rid FROM documents),
w AS (SELECT rid, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
win AS (SELECT rid, i, array_to_string(ws[i:i+7], ' ') AS k FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)),
rep AS (SELECT rid, count(DISTINCT p) AS n FROM (
          SELECT rid, unnest(range(i, i + 8)) AS p FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM win) WHERE c > 1) GROUP BY rid),
m AS (SELECT d.doc_id, d.lang, d.source, len(ws)::BIGINT AS n_words,
             length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
             coalesce(rep.n, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines
      FROM d JOIN w USING (rid) LEFT JOIN rep USING (rid)),
r AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
             n_symbols::DOUBLE / greatest(n_words, 1) AS sym, n_dup_lines::DOUBLE / greatest(n_lines, 1) AS dup,
             n_repeat_words::DOUBLE / greatest(n_words, 1) AS rep, word_chars::DOUBLE / greatest(n_words, 1) AS wlen FROM m),
ok AS (SELECT * FROM r WHERE NOT base_failed),
v AS (SELECT lang, source, 'sym' AS metric, sym AS x FROM ok UNION ALL SELECT lang, source, 'dup', dup FROM ok
      UNION ALL SELECT lang, source, 'rep', rep FROM ok UNION ALL SELECT lang, source, 'wlen', wlen FROM ok),
b AS (SELECT *, CASE WHEN x > 0 THEN ceil(ln(x) / {lg}) END AS bin FROM v),
g AS (SELECT lang, source, metric, 0 AS lvl, bin FROM b UNION ALL SELECT lang, NULL, metric, 1, bin FROM b UNION ALL SELECT NULL, NULL, metric, 2, bin FROM b),
c AS (SELECT lang, source, metric, lvl, bin, count(*) AS n FROM g GROUP BY ALL),
u AS (SELECT *, sum(n) OVER (PARTITION BY lang, source, metric, lvl ORDER BY bin NULLS FIRST) AS upto,
             sum(n) OVER (PARTITION BY lang, source, metric, lvl) AS total,
             sum(CASE WHEN bin IS NULL THEN 0 ELSE n END) OVER (PARTITION BY lang, source, metric, lvl ORDER BY bin NULLS FIRST) AS seen_upto,
             sum(CASE WHEN bin IS NULL THEN 0 ELSE n END) OVER (PARTITION BY lang, source, metric, lvl) AS seen,
             CASE WHEN bin IS NULL THEN 0.0 ELSE 2.0 * pow({g}, bin) / {g1} END AS val FROM c),
q AS (SELECT lang, source, metric, lvl, max(total) AS n, max(seen) AS seen, min(val) FILTER (upto >= ceil(0.25 * total)) AS q25,
             min(val) FILTER (upto >= ceil(0.75 * total)) AS q75, min(val) FILTER (upto >= ceil(0.9 * total)) AS q90,
             min(val) FILTER (bin IS NOT NULL AND seen_upto >= ceil(0.25 * seen)) AS z25,
             min(val) FILTER (bin IS NOT NULL AND seen_upto >= ceil(0.75 * seen)) AS z75 FROM u GROUP BY ALL),
p AS (SELECT a.lang, a.source, a.metric,
             unnest([CASE WHEN a.n >= {mg} AND (a.metric = 'wlen' OR a.seen >= {ms}) THEN struct_pack(q25 := a.q25, q75 := a.q75, q90 := a.q90, z25 := a.z25, z75 := a.z75)
                  WHEN l.n >= {mg} AND (a.metric = 'wlen' OR l.seen >= {ms}) THEN struct_pack(q25 := l.q25, q75 := l.q75, q90 := l.q90, z25 := l.z25, z75 := l.z75)
                  ELSE struct_pack(q25 := t.q25, q75 := t.q75, q90 := t.q90, z25 := t.z25, z75 := t.z75) END], recursive := true)
      FROM q a JOIN q l ON l.lvl = 1 AND l.metric = a.metric AND l.lang IS NOT DISTINCT FROM a.lang
               JOIN q t ON t.lvl = 2 AND t.metric = a.metric WHERE a.lvl = 0),
h AS (SELECT lang, source, max(q90 + greatest(0.5 * coalesce(z25, 0), 0.1)) FILTER (metric = 'sym') AS sym_hi,
             max(q90 + greatest(1.5 * coalesce(z75, 0), 0.1)) FILTER (metric = 'dup') AS dup_hi,
             max(q90 + greatest(1.5 * coalesce(z75, 0), 0.05)) FILTER (metric = 'rep') AS rep_hi,
             max(q75 + 6 * greatest(q75 - q25, 0.5)) FILTER (metric = 'wlen') AS wlen_hi,
             max(q25 - 6 * greatest(q75 - q25, 0.5)) FILTER (metric = 'wlen') AS wlen_lo FROM p GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed,
       NOT base_failed AND sym <= sym_hi AND dup <= dup_hi AND rep <= rep_hi AND wlen <= wlen_hi AND wlen >= wlen_lo AS kept
FROM r LEFT JOIN h ON r.lang IS NOT DISTINCT FROM h.lang AND r.source IS NOT DISTINCT FROM h.source
""".replace("{lg}", repr(math.log(GAMMA))).replace("{g1}", repr(GAMMA + 1)).replace("{g}", repr(GAMMA)).replace("{mg}", str(MIN_GROUP)).replace("{ms}", str(MIN_SEEN))
