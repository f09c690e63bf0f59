"""Secret scans by character Markov models (operator 3), native.

Base rules find assignments, access keys and long hexadecimal runs.  Beside
them, every other run of ``CANDIDATE`` characters is scored by two first-order
Markov models, of random strings and of ordinary identifiers: the mean
log-likelihood ratio of its character pairs.  Runs that reach ``MIN_RATIO`` nats
a pair become spans of kind ``markov``; base spans always stay.

Labelled samples: random strings are digests in hexadecimal, base 64 and its
letters and digits (``N_RANDOM`` of each, made by Spark) and what the base rules
find; ordinary ones are the words of a document sample outside base spans, and
pairs of such words joined as identifiers are.  The sample is bounded: documents
are taken by a hash of their text, about ``SAMPLE_DOCS`` of them at any size.  The
model is a table of 80 x 80 numbers, all that reaches the driver.

Cases: null and empty texts have no span and the hash of the empty string; ties
(spans of two kinds with one start) go in the order assign, access, hex, markov;
repeated rows each get a row; a null doc_id is passed through; very long texts
are scanned whole; an empty table gives an empty result (the models then rest on
the generated strings); extra columns are ignored, or passed through by
``redact`` (working columns begin with ``_s_``).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldops.llm.common import documents, fixed

#: The base rules.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ["assign", "access", "hex", "markov"]

LEAST_RUN = 20
CANDIDATE = f"[A-Za-z0-9+/_=-]{{{LEAST_RUN},}}"
MIN_RATIO = 0.75
SAMPLE_DOCS = 2000
N_RANDOM = 2000
FIRST, WIDTH = 43, 80  # the characters + to z
SMOOTHING = 0.5


def _place(kind: str, matches: Column, gaps: Column, least: Column) -> Column:
    """Spans of ``matches``: match i starts after gaps 0 to i and the matches before.  ``least``: whether each one counts."""
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<kind:int,start:int,stop:int>>").alias("out"))
    zipped = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(matches)).alias("g"), matches.alias("m"), least.alias("ok"))

    def step(s: Column, x: Column) -> Column:
        start = s["at"] + F.length(x["g"])
        stop = start + F.length(x["m"])
        span = F.struct(F.lit(KINDS.index(kind)).alias("kind"), start.alias("start"), stop.alias("stop"))
        return F.struct(stop.alias("at"), F.when(x["ok"], F.concat(s["out"], F.array(span))).otherwise(s["out"]).alias("out"))

    return F.aggregate(zipped, empty, step, lambda s: s["out"])


def _spans(kind: str, text: str, quick: str, pattern: str, least: Column) -> Column:
    """Spans of a kind; only texts that hold a match of ``quick`` are taken apart.
    ``pattern`` must be such that what it doesn't match can be skipped."""
    t, p = F.col(text), F.lit(pattern)
    found = _place(kind, F.regexp_extract_all(t, p, F.lit(0)), F.split(t, pattern, -1), least)
    return F.when(t.rlike(quick), found).otherwise(F.array().cast("array<struct<kind:int,start:int,stop:int>>"))


def base_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``_s_base``: the base rules' spans, by start and kind."""
    t = F.col(text)
    always = lambda pattern: F.transform(F.regexp_extract_all(t, F.lit(pattern), F.lit(0)), lambda x: F.lit(True))
    long_enough = F.transform(F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(2)), lambda x: F.length(x) >= LEAST["assign"])
    # A run matches greedily, so the length bound may stand in the pattern where a shorter run leaves nothing to match.
    access, hexa = f"AKIA[A-Z0-9]{{{LEAST['access'] - 4},}}", f"[0-9a-f]{{{LEAST['hex']},}}"
    spans = F.concat(_spans("assign", text, ASSIGN, ASSIGN, long_enough), _spans("access", text, access, access, always(access)),
                     _spans("hex", text, hexa, hexa, always(hexa)))
    order = lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["kind"] - b["kind"])
    return fixed(docs, _s_base=F.coalesce(F.array_sort(spans, order), F.array().cast("array<struct<kind:int,start:int,stop:int>>")))


def _pairs(strings: DataFrame) -> DataFrame:
    """(a, b, n): how often character code b follows a in column ``s``."""
    code = lambda i: F.ascii(F.substring(F.col("s"), i, F.lit(1))) - FIRST
    near = strings.where(F.length("s") > 1).select("s", F.explode(F.sequence(F.lit(2), F.length("s"))).alias("i"))
    return (near.select(code(F.col("i") - 1).alias("a"), code(F.col("i")).alias("b"))
            .where(f"a BETWEEN 0 AND {WIDTH - 1} AND b BETWEEN 0 AND {WIDTH - 1}").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")))


def train(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The table of log-likelihood ratios, WIDTH x WIDTH in one row."""
    spark = docs.sparkSession
    n = docs.count()
    sample = docs.select(F.col(text).alias("_s_text")).where(F.pmod(F.xxhash64("_s_text"), F.lit(max(1, -(-n // SAMPLE_DOCS)))) == 0)
    sample = base_spans(sample, "_s_text")
    digest = spark.range(N_RANDOM).select(F.sha2(F.col("id").cast("string"), 256).alias("x"))
    b64 = F.base64(F.unhex("x"))
    made = digest.select(F.explode(F.array("x", b64, F.translate(b64, "+/=", ""))).alias("s"))
    found = sample.select(F.explode("_s_base").alias("b"), "_s_text").select(
        F.substring(F.col("_s_text"), F.col("b.start") + 1, F.col("b.stop") - F.col("b.start")).alias("s")).select(
        F.regexp_extract("s", r"([A-Za-z0-9+/_.=-]+)$", 1).alias("s"))
    # Words outside base spans: the text with the base matches blanked.
    rest = sample.select(F.when(F.size("_s_base") > 0, F.regexp_replace(F.regexp_replace("_s_text", ASSIGN, " "), r"AKIA[A-Z0-9]+|[0-9a-f]{24,}", " "))
                         .otherwise(F.col("_s_text")).alias("t"))
    words = rest.select(F.regexp_extract_all("t", F.lit(r"[A-Za-z0-9+/_=-]{2,}"), F.lit(0)).alias("w"))
    joint = F.transform(F.sequence(F.lit(1), F.size("w") - 1, F.lit(1)), lambda i: F.concat(
        F.element_at("w", i), F.when(i % 3 == 0, "_").when(i % 3 == 1, "-").otherwise(""), F.initcap(F.element_at("w", i + 1))))
    ordinary = words.select(F.explode(F.concat("w", F.when(F.size("w") > 1, joint).otherwise(F.array().cast("array<string>")))).alias("s"))
    counts = _pairs(made.unionByName(found)).withColumn("kind", F.lit(0)).unionByName(_pairs(ordinary).withColumn("kind", F.lit(1)))
    table = np.zeros((2, WIDTH, WIDTH))
    for r in counts.collect():  # at most 2 * WIDTH * WIDTH rows
        table[r["kind"], r["a"], r["b"]] += r["n"]
    used = 67  # characters a candidate may hold
    logs = np.log((table + SMOOTHING) / (table.sum(axis=2, keepdims=True) + SMOOTHING * used))
    return (logs[0] - logs[1]).reshape(-1)


def _outside_base(run: Column) -> Column:
    """The pieces of a candidate run outside the base spans that are long enough to be scored."""
    piece = lambda start, stop: F.array(F.struct(run["kind"].alias("kind"), start.alias("start"), stop.alias("stop")))
    put = lambda s, stop: F.when(stop - s["at"] >= LEAST_RUN, F.concat(s["out"], piece(s["at"], stop))).otherwise(s["out"])
    begin = F.struct(run["start"].alias("at"), F.array().cast("array<struct<kind:int,start:int,stop:int>>").alias("out"))
    over = F.filter("_s_base", lambda b: (b["start"] < run["stop"]) & (b["stop"] > run["start"]))  # by start
    step = lambda s, b: F.struct(F.greatest(s["at"], b["stop"]).alias("at"), put(s, b["start"]).alias("out"))
    return F.aggregate(over, begin, step, lambda s: put(s, run["stop"]))


def scan(docs: DataFrame, model: np.ndarray | None = None, text: str = "text") -> DataFrame:
    """``docs`` with ``_s_base`` and ``_s_spans`` (all spans, by start and kind)."""
    weights = F.lit(train(docs, text) if model is None else model)
    found = fixed(base_spans(docs, text), _s_runs=_spans("markov", text, CANDIDATE, CANDIDATE,
                  F.transform(F.regexp_extract_all(F.col(text), F.lit(CANDIDATE), F.lit(0)), lambda x: F.lit(True))))
    clear = F.flatten(F.transform("_s_runs", _outside_base))
    runs = fixed(found, _s_tokens=F.transform(clear, lambda r: F.struct(r.alias("r"), F.split(F.substring(F.col(text), r["start"] + 1, r["stop"] - r["start"]), "").alias("c"))))

    def ratio(c: Column) -> Column:
        code = lambda i: F.ascii(F.element_at(c, i.cast("int"))) - FIRST
        pair = lambda i: F.element_at(weights, (code(i - 1) * WIDTH + code(i) + 1).cast("int"))
        n = F.size(F.filter(c, lambda x: x != ""))
        return F.aggregate(F.sequence(F.lit(2), n), F.lit(0.0), lambda s, i: s + pair(i)) / (n - 1)

    more = F.transform(F.filter("_s_tokens", lambda x: ratio(x["c"]) >= MIN_RATIO), lambda x: x["r"])
    order = lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["kind"] - b["kind"])
    spans = F.when(F.size("_s_tokens") > 0, F.array_sort(F.concat("_s_base", F.coalesce(more, F.array().cast("array<struct<kind:int,start:int,stop:int>>"))), order)).otherwise(F.col("_s_base"))
    return fixed(runs, _s_spans=spans).drop("_s_runs", "_s_tokens")


def _listed(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["stop"])), ",")


def secret_report(docs: DataFrame, id_col: str = "doc_id", text: str = "text", model: np.ndarray | None = None) -> DataFrame:
    narrow = docs.select(F.col(id_col).alias("_s_id"), F.col(text).alias("_s_text"))
    found = scan(narrow, model, "_s_text")
    n = lambda spans, k: F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(k))).cast("long").alias("n_" + k)
    return found.select(F.col("_s_id").alias(id_col), n("_s_base", "assign"), n("_s_base", "access"), n("_s_base", "hex"), n("_s_spans", "markov"),
                        F.sha2(_listed("_s_base").cast("binary"), 256).alias("base_sha256"), _listed("_s_spans").alias("spans"))


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", model: np.ndarray | None = None) -> DataFrame:
    """``docs`` with every span (overlapping ones together) replaced by ``mark``."""
    found = scan(docs, model, text)
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(s: Column, x: Column) -> Column:
        fresh = F.concat(s["out"], F.substring(F.col(text), s["at"] + 1, x["start"] - s["at"]), F.lit(mark))
        return F.struct(F.greatest(s["at"], x["stop"]).alias("at"), F.when(x["start"] >= s["at"], fresh).otherwise(s["out"]).alias("out"))

    whole = F.aggregate("_s_spans", begin, step, lambda s: F.concat(s["out"], F.substring(F.col(text), s["at"] + 1, F.length(F.col(text)))))
    return found.select(*[(F.when(F.size("_s_spans") > 0, whole).otherwise(F.col(c)).alias(c) if c == text else F.col(f"`{c}`")) for c in docs.columns])


def op3_markov_secrets(spark, sf_dir: str) -> DataFrame:
    return secret_report(documents(spark, sf_dir))
