"""Periodic run detection by maximal pairs (operator 11).

A run is a stretch of consecutive words with smallest period q, at least
``MIN_WORDS`` and ``MIN_PERIODS`` times q words long, that no neighbouring word
extends.  Its first word and the word q later begin a maximal pair: the
l = length - q words from there are equal, the words before them differ and so
do the words after.  So a text's runs are the maximal pairs of distance d and
common length l with l >= (MIN_PERIODS - 1) * d and l + d >= MIN_WORDS, and
nothing has to be extended:

* Words become numbers, and a batch's texts one suffix array (prefix doubling in
  NumPy, each text with numbers of its own).  A pair needs l of at least
  ``least_common`` words, so only texts in which that many words in a row come
  twice (a rolling hash finds them, equal windows always meet) are sorted.
* The LCP-interval tree is walked bottom-up.  A node of l common words holds its
  positions in order, whole and as lists per left word.  Children are merged
  into the largest one; every position of the smaller looks for positions within
  d <= l / (MIN_PERIODS - 1) under another left word.  Occurrences that close lie in one
  arithmetic progression, whose members but the first share their left word, so
  two of the lists are looked at, the first and the last near one's.  The work is
  O(n log^2 n) and the pairs found; those number at most one per multiple of a
  run's period.
* A multiple of the smallest period gives the same stretch again; the smallest
  distance of a stretch is kept.

Texts are worked on in parts of about 8 MB, a longer text by itself: memory
follows the longest text (4 bytes a word and level of doubling, the words themselves).

Cases: null and empty texts have no words and no run; repeated rows get a row
each; a null id is passed through; a tie between runs is left to the caller, who
gets all of them by start, then period; an empty table gives an empty result;
extra columns are ignored.  Very long texts are searched whole.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldops.llm.common import batch, documents, fixed, row_slices, words_of

MIN_WORDS = 24
MIN_PERIODS = 3
BASE = 0xD6E8FEB86659FD93  # of the rolling hash, odd
KEEP_WORDS = 2_000_000  # words whose numbers a worker remembers (a cache)
WORD = r"[^\x20\x09-\x0D]+"

RUN = "struct<start:long,length:long,period:long>"


class _Numbers(dict):
    """word -> number, given out on first sight."""

    def __init__(self):
        super().__init__()
        self.next = count().__next__

    def __missing__(self, word: bytes) -> int:
        n = self[word] = self.next()
        return n


def least_common(min_words: int, min_periods: int) -> int:
    """Common words that the maximal pair of any run has at least."""
    return min(max((min_periods - 1) * d, min_words - d) for d in range(1, min_words + 1))


def _repeating(ids: np.ndarray, doc: np.ndarray, width: int) -> np.ndarray:
    """Texts (numbers) in which ``width`` words in a row come twice; by a rolling hash, so a rare one more may be named."""
    if len(ids) < width:
        return np.empty(0, doc.dtype)
    h = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    power = np.cumprod(np.full(len(ids), BASE, np.uint64))
    back = np.cumprod(np.full(len(ids), pow(BASE, -1, 1 << 64), np.uint64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((h ^ (h >> np.uint64(32))) * power)])
    window = (sums[width:] - sums[:-width]) * back[:len(ids) - width + 1]
    first, last = doc[:len(window)], doc[width - 1:]
    window = (window ^ (first.astype(np.uint64) * np.uint64(0x94D049BB133111EB)))[first == last]
    order = np.argsort(window)
    return np.unique(first[first == last][order[1:][window[order[1:]] == window[order[:-1]]]])


def _suffixes(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of ``ids``, and the common words of each suffix with the one before it."""
    n = len(ids)
    levels = [np.unique(ids, return_inverse=True)[1].astype(np.int32) + 1]  # ranks by 1, 2, 4 .. words
    width = 1
    while levels[-1].max(initial=0) < n:
        rank = levels[-1].astype(np.int64)
        after = np.zeros(n, np.int64)
        after[:max(0, n - width)] = rank[width:]
        levels.append(np.unique(rank * (n + 1) + after, return_inverse=True)[1].astype(np.int32) + 1)
        width *= 2
    order = np.empty(n, np.int64)
    order[levels[-1] - 1] = np.arange(n)
    a, b, common = order[:-1].copy(), order[1:].copy(), np.zeros(n, np.int64)
    for k in range(len(levels) - 2, -1, -1):
        rank = np.append(levels[k], [0])
        same = (rank[np.minimum(a, n)] == rank[np.minimum(b, n)]) & (np.maximum(a, b) < n)
        common[1:] += same << k
        a += same << k
        b += same << k
    return order, common


class _Node:
    """Positions of an LCP interval: all in order, and in order per left word."""
    __slots__ = ("every", "lists")

    def __init__(self, position: int, left: int):
        self.every, self.lists = [position], {left: [position]}


def _merge(one: _Node, other: _Node, common: int, left: np.ndarray, least: int, periods: int, found: list) -> _Node:
    """The union of two children of a node of ``common`` words; its maximal pairs go to ``found``."""
    if len(one.every) < len(other.every):
        one, other = other, one
    reach, lowest = common // (periods - 1), max(1, least - common)
    if reach >= lowest:
        every, lists = one.every, one.lists
        for p in other.every:
            a, b = bisect_left(every, p - reach), bisect_right(every, p + reach)
            if a == b:
                continue
            mine = left[p]
            for word in {left[every[a]], left[every[b - 1]]} - {mine}:
                near = lists[word]
                for q in near[bisect_left(near, p - reach):bisect_right(near, p + reach)]:
                    if abs(p - q) >= lowest:
                        found.append((min(p, q), abs(p - q), common))
    for p in other.every:
        insort(one.every, p)
    for word, places in other.lists.items():
        if word in one.lists:
            for p in places:
                insort(one.lists[word], p)
        else:
            one.lists[word] = places
    return one


def maximal_pairs(ids: np.ndarray, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """(place, distance, common words) of every maximal pair that meets the length constraints."""
    least, found = least_common(min_words, min_periods), []
    if len(ids) < min_words:
        return found
    order, common = _suffixes(ids)
    left = [-1, *ids[:-1].tolist()]
    order, common = order.tolist(), common.tolist()
    stack: list[tuple[int, _Node]] = []  # open intervals: common words, children so far
    for i, here in enumerate([*common[1:], 0]):  # here: common words with the next suffix
        if common[i] < least and here < least:
            continue
        node = _Node(order[i], left[order[i]])
        while stack and stack[-1][0] > here:  # intervals that end with this suffix
            depth, whole = stack.pop()
            node = _merge(whole, node, depth, left, min_words, min_periods, found)
        if stack and stack[-1][0] == here:
            stack[-1] = (here, _merge(stack[-1][1], node, here, left, min_words, min_periods, found))
        elif here >= least:
            stack.append((here, node))
    return found


def runs_of(ids: np.ndarray, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    smallest: dict[tuple[int, int], int] = {}
    for start, distance, common in maximal_pairs(ids, min_words, min_periods):
        key = (start, distance + common)
        smallest[key] = min(distance, smallest.get(key, distance))
    return sorted((start, length, period) for (start, length), period in smallest.items())


def _search(min_words: int, min_periods: int):
    width = least_common(min_words, min_periods)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = _Numbers()
        for whole in batches:
            for rb in row_slices(whole, "text"):
                if len(numbers) > KEEP_WORDS:
                    numbers = _Numbers()
                texts = [words_of(t) for t in rb.column(1).to_pylist()]
                sizes = [len(w) for w in texts]
                ids = np.fromiter((numbers[w] for t in texts for w in t), np.int64, sum(sizes))
                ends = np.cumsum([0, *sizes])
                found: list[list] = [[] for _ in texts]
                kept: list[bytes | None] = [b" ".join(w) for w in texts]
                for i in _repeating(ids, np.repeat(np.arange(len(texts)), sizes), width).tolist():
                    found[i] = runs_of(ids[ends[i]:ends[i + 1]], min_words, min_periods)
                    if found[i]:
                        stay = np.ones(sizes[i], bool)
                        for start, length, period in found[i]:
                            stay[start + period:start + length] = False
                        kept[i] = b" ".join([texts[i][j] for j in np.flatnonzero(stay).tolist()])
                runs = [[{"start": s, "length": n, "period": p} for s, n, p in r] for r in found]
                yield batch(schema, [rb.column(0), pa.array(sizes, pa.int64()), runs, pa.array(kept, pa.binary()).cast(pa.string())])

    schema = pa.schema([("id", pa.int64()), ("n_words", pa.int64()),
                        ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))), ("collapsed", pa.string())])
    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> DataFrame:
    """Per row: the id, ``n_words``, ``runs`` (array of start, length and period
    in words) and ``collapsed``, the words joined by one space without those that
    a run holds after its first period."""
    if min_words < 2 or min_periods < 3:
        raise ValueError("a run has at least two words and three periods")
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    return narrow.mapInArrow(_search(min_words, min_periods), f"id long, n_words long, runs array<{RUN}>, collapsed string").withColumnRenamed("id", id_col)


def with_planted(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text): a tenth of the texts, chosen by a hash of the id, go on
    periodically from some word on, so that a corpus of known runs is searched."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0)))
    d = fixed(docs.select(id_col, text), _r_words=words, _r_g=F.floor(h / 10))
    n = F.size("_r_words")
    d = fixed(d, _r_a=F.when(n > 0, F.col("_r_g") % n))
    d = fixed(d, _r_p=1 + F.floor((n - F.col("_r_a")) / (3 + F.col("_r_g") % 8)))
    a, p = F.col("_r_a"), F.col("_r_p")
    planted = F.array_join(F.transform("_r_words", lambda w, i: F.when(i < a, w).otherwise(F.get("_r_words", (a + (i - a) % p).cast("int")))), " ")
    return d.select(id_col, F.when(a.isNotNull(), planted).otherwise(F.col(text)).alias(text))


def strongest(runs: str) -> Column:
    """The run of greatest length / period, compared exactly; ties: smallest start, then period."""
    ahead = lambda x, y: F.when(
        x["length"] * y["period"] != y["length"] * x["period"], F.signum(y["length"] * x["period"] - x["length"] * y["period"])).when(
        x["start"] != y["start"], F.signum(x["start"] - y["start"])).otherwise(F.signum(x["period"] - y["period"])).cast("int")
    return F.get(F.array_sort(runs, ahead), F.lit(0))


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted(documents(spark, sf_dir)))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    best = found.withColumn("best", strongest("runs"))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
