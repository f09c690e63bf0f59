"""Spelling variant grouping over a reduced alphabet (operator 13).

Words that differ by one inserted, deleted or replaced code point are near.
Letters are hashed to a few symbols; words that are near have reduced words that
are equal or one edit apart, as an edit of the word is at most one edit of its
reduced word.  So:

1. The words of all texts are counted (partial sums before the shuffle, so that a
   frequent word is one row a task) and the vocabulary is staged.
2. Every word generates the one-edit neighbourhood of its reduced word: itself, every
   deletion and every replacement by a later symbol.  A neighbour by insertion is the
   deletion of the longer word and a replacement by an earlier symbol is the
   later one of the other word, so each pair is met, and met once.
3. The neighbours join the reduced vocabulary by their 64-bit hash.
4. Pairs are verified on the original strings.

The number of symbols follows the vocabulary (``symbols_for``), so that the words
that share a reduced word stay few and the neighbourhoods short: the joined rows
grow about in proportion to the vocabulary.  What is left of a common reduced
word's rows is split by Spark's skew join.

A word's form is its near word of largest count if that is at least ``RATIO``
times its own; forms are followed to the last by pointer jumping.  Counts at
least double on the way, so the rounds follow the logarithm of a logarithm; each
is staged and only a sum reaches the driver.

Cases: null and empty texts have no words; ties between forms go to the smallest
word in code-point order; repeated rows count each; a null id changes no word; an
empty table gives an empty result; extra columns are ignored.  Very long texts
are read whole, very long words have long neighbourhoods (words and symbols / 2 a
letter).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from fieldops.llm.common import documents, fixed, staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = r"[a-zÀ-ÿ]+"  # of texts in which A-Z became a-z
LETTERS = LOWER + "".join(map(chr, range(0xC0, 0x100)))
#: Symbols of reduced words, in the order of their characters.
SYMBOLS = "".join(map(chr, range(0x30, 0x70)))
LEAST_LETTERS = 5
LEAST_COUNT = 3
RATIO = 2
DELETE_ONE_IN = 97


def altered(doc_id: Column, run: Column) -> Column:
    """The run, or for one (id, run) in ``DELETE_ONE_IN`` the run without one code point, both chosen by a hash."""
    h = F.crc32(F.concat(doc_id.cast("string"), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % DELETE_ONE_IN == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def vocabulary(docs: DataFrame, id_col: str | None = "doc_id", text: str = "text", least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): words of ``least_letters`` or more that occur ``least_count`` times or more; with ``id_col``, after ``altered``."""
    lower = F.regexp_extract_all(F.translate(F.col(text), UPPER, LOWER), F.lit(RUN), F.lit(0))
    runs = docs.select((F.col(id_col) if id_col else F.lit(None)).alias("_v_id"), F.explode(lower).alias("run")).where(F.length("run") >= least_letters)
    words = runs.select((altered(F.col("_v_id"), F.col("run")) if id_col else F.col("run")).alias("word"))
    # The length of what is left is tested on the sums: on the key it would be pushed down and every hash be taken twice.
    sums = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.max(F.length("word")).alias("size"))
    return sums.where((F.col("n") >= least_count) & (F.col("size") >= least_letters)).select("word", "n")


def symbols_for(words: int) -> int:
    """So many symbols that words of six letters have about as many reduced words as there are words."""
    return max(4, min(len(SYMBOLS), round(words ** (1 / 6))))


def reduced(word: Column, symbols: int) -> Column:
    """The word with every letter hashed to one of ``symbols`` symbols."""
    return F.translate(word, LETTERS, "".join(SYMBOLS[ord(c) % symbols] for c in LETTERS))


def _neighbours(r: Column, symbols: int) -> Column:
    """Hashes of the neighbours of a reduced word: deletions and replacements by later symbols."""
    head = lambda i: F.substring(r, F.lit(1), i - 1)
    tail = lambda i: F.substring(r, i + 1, F.length(r))
    later = lambda i: F.slice(F.array(*[F.lit(s) for s in SYMBOLS[:symbols]]), F.ascii(F.substring(r, i, F.lit(1))) - ord(SYMBOLS[0]) + 2, symbols)
    places = F.sequence(F.lit(1), F.length(r))
    replaced = F.flatten(F.transform(places, lambda i: F.transform(later(i), lambda s: F.xxhash64(F.concat(head(i), s, tail(i))))))
    return F.concat(F.array_distinct(F.transform(places, lambda i: F.xxhash64(F.concat(head(i), tail(i))))), replaced)


def near_pairs(words: DataFrame, symbols: int) -> DataFrame:
    """(a, an, b, bn): every pair of near words of (word, n) once, with their counts."""
    d = fixed(words.where(F.length("word") > 0), _v_r=reduced(F.col("word"), symbols))
    lookup = d.select(F.xxhash64("_v_r").alias("key"), F.col("word").alias("b"), F.col("n").alias("bn"))
    own = F.struct(F.xxhash64("_v_r").alias("key"), F.lit(True).alias("own"))
    others = F.transform(_neighbours(F.col("_v_r"), symbols), lambda k: F.struct(k.alias("key"), F.lit(False).alias("own")))
    probe = d.select(F.col("word").alias("a"), F.col("n").alias("an"), F.inline(F.concat(F.array(own), others)))
    # Words with one reduced word meet both ways, all others once.
    met = probe.join(lookup, "key").where(~F.col("own") | (F.col("a") < F.col("b")))
    return met.where(F.levenshtein("a", "b", 1) == 1).select("a", "an", "b", "bn")


def forms(words: DataFrame, pairs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n)."""
    side = lambda x, y: F.struct(F.col(x).alias("word"), F.col(y).alias("near"), F.col(y + "n").alias("near_n"))
    both = pairs.select(F.inline(F.array(side("a", "b"), side("b", "a"))))  # one pass: a union would find the pairs twice
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("k"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"))
    d = words.join(best, "word", "left")
    taken = -F.col("best.m") >= ratio * F.col("n")
    return d.select("word", "n", F.coalesce("k", F.lit(0)).cast("long").alias("n_near"), F.when(taken, F.col("best.near")).alias("form"),
                    F.when(taken, -F.col("best.m")).cast("long").alias("form_n"))


def roots(formed: DataFrame) -> DataFrame:
    """(word, root) of the words with a form: the last of the forms that follow."""
    def kept(d: DataFrame) -> tuple[DataFrame, int]:
        seen = Observation()
        out = staged(d.observe(seen, F.count(F.when(F.col("moved"), 1)).alias("moved")), "forms")
        return out.drop("moved"), seen.get["moved"]

    now, moved = kept(formed.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"), F.lit(True).alias("moved")))
    while moved:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now, moved = kept(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
    return now


def group_variants(words: DataFrame, ratio: int = RATIO, symbols: int | None = None) -> DataFrame:
    """word, form, root, n, n_near and form_n for every row of (word, n); words are distinct."""
    held = staged(words.select("word", F.col("n").cast("long").alias("n")), "vocabulary")
    formed = staged(forms(held, near_pairs(held, symbols or symbols_for(held.count())), ratio), "word-forms")
    return (formed.join(roots(formed), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def op13_spelling_variants(spark, sf_dir: str) -> DataFrame:
    return group_variants(vocabulary(documents(spark, sf_dir)))
