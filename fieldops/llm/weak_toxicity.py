"""Toxicity by weak supervision (operator 9).

1. A bounded sample of labelled training rows (``SAMPLE``, by a hash of the id;
   rows with crc32(doc_id) mod 5 = 0 are held out and never looked at) is turned
   into feature sets: words, and their first 4, 5 and 6 letters.
2. Voters: one per word of a fixed lexicon, a few text patterns, terms mined from
   the sample (a term most of whose texts are toxic), one voter against, and the
   human label itself.
3. A generative label model gives every voter class-conditional firing rates (its
   accuracy) and all pairs of voters their correlation given the class: votes
   are Gaussian around their class means with one shrunken covariance, fitted by
   expectation and maximisation.  Correlated voters thus share their weight
   instead of being counted twice.  Its posteriors are the training labels.
4. A logistic regression on the features that are associated with the posteriors
   is trained by gradient descent.
5. All documents are scored in one Arrow pass.

The models are small (hundreds of voters, thousands of weights) and fitted on
the driver from the sample's feature numbers; nothing else reaches it.

Cases: null and empty texts have no feature and get the intercept's score; null
ids are held out (they have no checksum) and scored; rows that repeat a labelled
id each count; a null label is no label; without any training row, or with one
class alone, the lexicon and pattern voters decide; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldops.llm.common import documents, read, row_slices

SAMPLE = 12_000  # labelled training rows, at most in expectation, at any size
BUCKETS = 1 << 20
PREFIXES = (4, 5, 6)
MINED = 200  # voters mined from the sample
LEAST_TEXTS, LEAST_SHARE = 4, 0.8  # toxic texts and their share that a mined term needs
SHRINK = 0.2  # of the covariance towards its diagonal
ROUNDS, STEPS = 20, 300
RIDGE = 2e-4
LEXICON = ("idiot moron stupid loser scum trash worthless pathetic clown disgusting dumb fool garbage filth filthy imbecile jerk ugly vermin coward liar "
           "crap damn bastard freak creep psycho retard kill die hate idiota imbécil estúpido estúpida basura asco payaso tonto cerdo "
           "abruti crétin débile ordure dégoûtant connard imbécile idiote stupide merde dumm dumme trottel abschaum müll "
           "ekelhaft versager wertlos schwein arschloch").split()
PATTERNS = [r"\byou(?:'re| are| r)\s+(?:a|an|so|such|all|just|the)?\s*(?:idiot|moron|stupid|loser|scum|trash|worthless|pathetic|clown|disgusting|dumb|fool)",
            r"\b(?:shut up|go to hell|get lost|drop dead|hate you|kill yourself)\b", r"!{3,}", r"\b[A-Z]{5,}\b(?:\W+[A-Z]{4,}\b){2,}"]
WORDS = re.compile(r"[^\W\d_]+")
N_FIXED = len(LEXICON) + len(PATTERNS)


class Features:
    """text -> (feature numbers, fixed votes)."""

    def __init__(self):
        self.known: dict[str, tuple[int, ...]] = {}
        self.lexicon = {w: i for i, w in enumerate(LEXICON)}
        self.patterns = [re.compile(p, re.I if i < 2 else 0) for i, p in enumerate(PATTERNS)]

    def numbers(self, word: str) -> tuple[int, ...]:
        got = self.known.get(word)
        if got is None:
            if len(self.known) > 300_000:
                self.known.clear()
            made = {"w" + word} | {f"{n}{word[:n]}" for n in PREFIXES if len(word) > n}
            got = self.known[word] = tuple(zlib.crc32(x.encode("utf-8", "surrogatepass")) % BUCKETS for x in made)
        return got

    def __call__(self, text: str | None) -> tuple[np.ndarray, list[int]]:
        if not text:
            return np.empty(0, dtype=np.int32), []
        words = set(WORDS.findall(text.lower()))
        found = {n for w in words for n in self.numbers(w)}
        votes = sorted(self.lexicon[w] for w in words & self.lexicon.keys())
        votes += [len(LEXICON) + i for i, p in enumerate(self.patterns) if p.search(text)]
        return np.fromiter(found, dtype=np.int32, count=len(found)), votes


@dataclass
class Model:
    features: np.ndarray  # sorted feature numbers
    weights: np.ndarray
    fixed: np.ndarray  # weights of the fixed voters
    intercept: float

    def score(self, found: np.ndarray, votes: list[int]) -> float:
        z = self.intercept + float(self.fixed[votes].sum())
        if len(self.features) and len(found):
            at = np.searchsorted(self.features, found)
            at[at == len(self.features)] = 0
            z += float(self.weights[at[self.features[at] == found]].sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def label_model(votes: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posteriors of class 1, each voter's (firing rate in class 0, in class 1),
    and the voters' correlations given the class.  ``votes``: texts x voters, 0
    or 1; ``start``: first guess of the posteriors."""
    post = start.astype(float)
    n, k = votes.shape
    mean = np.zeros((2, k))
    spread = np.eye(k)
    for _ in range(ROUNDS):
        prior = np.clip(post.mean(), 1e-3, 1 - 1e-3)
        mean[0] = ((1 - post) @ votes + 0.05) / ((1 - post).sum() + 1)
        mean[1] = (post @ votes + 0.05) / (post.sum() + 1)
        a, b = votes - mean[0], votes - mean[1]
        spread = ((a * (1 - post)[:, None]).T @ a + (b * post[:, None]).T @ b) / n
        ridge = np.diag(np.maximum(np.diag(spread), 1e-4))
        inverse = np.linalg.inv((1 - SHRINK) * spread + SHRINK * ridge + 1e-6 * np.eye(k))
        w = inverse @ (mean[1] - mean[0])
        z = (votes - (mean[0] + mean[1]) / 2) @ w + np.log(prior / (1 - prior))
        new = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        done = np.abs(new - post).max() < 1e-4
        post = new
        if done:
            break
    sd = np.sqrt(np.maximum(np.diag(spread), 1e-12))
    return post, mean.T, spread / sd[:, None] / sd[None, :]


def fit(sets: list[np.ndarray], fixed: list[list[int]], labels: np.ndarray) -> Model:
    """The classifier from the sample's features, fixed votes and labels."""
    own = np.full(N_FIXED, 4.0)
    own[len(LEXICON) + 2:] = 0.5  # shouting alone is no insult
    bare = Model(np.empty(0, dtype=np.int32), np.empty(0), own, -2.5)
    n = len(sets)
    if n < 20 or labels.min() == labels.max():
        return bare
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    names, col = np.unique(np.concatenate(sets), return_inverse=True) if len(row) else (np.empty(0, dtype=np.int32), row)
    toxic = np.bincount(col, weights=labels[row].astype(float), minlength=len(names))
    seen = np.bincount(col, minlength=len(names))
    good = np.flatnonzero((toxic >= LEAST_TEXTS) & (toxic >= LEAST_SHARE * seen))
    good = good[np.lexsort((names[good], -toxic[good]))][:MINED]
    votes = np.zeros((n, N_FIXED + len(good) + 2))
    for i, f in enumerate(fixed):
        votes[i, f] = 1
    place = np.full(len(names), -1)
    place[good] = N_FIXED + np.arange(len(good))
    hit = place[col] >= 0
    votes[row[hit], place[col[hit]]] = 1
    votes[:, -2] = votes[:, :-2].sum(axis=1) == 0  # the voter against
    votes[:, -1] = labels
    alive = np.flatnonzero(votes.std(axis=0) > 0)
    post, _, _ = label_model(votes[:, alive], np.where(labels == 1, 0.95, 0.05))

    # Features whose share of toxic posteriors is far from the corpus' own; the fixed voters always.
    p = post.mean()
    mass = np.bincount(col, weights=post[row], minlength=len(names))
    z = (mass - seen * p) / np.sqrt(np.maximum(seen * p * (1 - p), 1e-9))
    use = np.flatnonzero((seen >= 3) & (np.abs(z) > 4))
    where = np.full(len(names), -1)
    where[use] = np.arange(len(use))
    sel = where[col] >= 0
    r, c = np.concatenate([row[sel], np.repeat(np.arange(n), [len(f) for f in fixed])]), np.concatenate([where[col[sel]], len(use) + np.array([x for f in fixed for x in f], dtype=int)])
    k = len(use) + N_FIXED
    order = np.argsort(r, kind="stable")
    r, c = r[order], c[order]
    w, b = np.zeros(k), np.log(p / (1 - p))
    m, v, mb, vb = np.zeros(k), np.zeros(k), 0.0, 0.0
    for t in range(1, STEPS + 1):  # Adam on the whole sample
        zz = np.bincount(r, weights=w[c], minlength=n) + b
        d = (1 / (1 + np.exp(-np.clip(zz, -30, 30))) - post) / n
        g, gb = np.bincount(c, weights=d[r], minlength=k) + RIDGE * w, d.sum()
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g, 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        w -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        b -= 0.05 * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.999**t)) + 1e-9)
    # What the sample never showed keeps the lexicon's own weight.
    shown = np.bincount(c, minlength=k)[len(use):] > 0
    return Model(names[use], w[:len(use)], np.where(shown, w[len(use):], own), float(b))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    extract = Features()
    for whole in batches:
        for rb in row_slices(whole, "text"):
            rows = [extract(t) for t in rb.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([rb.column(0), pa.array([np.sort(f) for f, _ in rows], pa.list_(pa.int32())), pa.array([x for _, x in rows], pa.list_(pa.int32()))],
                                             names=["toxic", "found", "votes"])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Fit on labelled rows that are not held out, a bounded sample of them."""
    known = labels.select(F.col(id_col).cast("long").alias("_t_id"), F.col(label).alias("toxic")).where(F.col("toxic").isin(0, 1) & ~held_out(F.col("_t_id")))
    step = max(1, -(-known.count() // SAMPLE))
    chosen = lambda c: F.pmod(F.xxhash64(c, F.lit(9)), F.lit(step)) == 0
    rows = docs.select(F.col(id_col).cast("long").alias("_t_doc"), F.col(text).alias("text")).where(chosen(F.col("_t_doc")) & ~held_out(F.col("_t_doc")))
    sample = rows.join(known.where(chosen(F.col("_t_id"))), F.col("_t_doc") == F.col("_t_id")).select(F.col("toxic").cast("int").alias("toxic"), "text")
    got = sample.mapInArrow(_features, "toxic int, found array<int>, votes array<int>").orderBy(F.xxhash64("found", "toxic")).toArrow()

    def lists(name: str) -> list[np.ndarray]:
        """A list column as views of its numbers, not as Python objects."""
        out: list[np.ndarray] = []
        for chunk in got.column(name).chunks:
            at = np.concatenate([[0], np.cumsum(chunk.value_lengths().to_numpy(zero_copy_only=False))]).astype(int)
            flat = chunk.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
            out += [flat[i:j] for i, j in zip(at[:-1], at[1:], strict=True)]
        return out

    return fit(lists("found"), [v.tolist() for v in lists("votes")], got.column("toxic").to_numpy().astype(int))


def _scoring(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extract = Features()
        for whole in batches:
            for rb in row_slices(whole, "text"):
                scores = [model.score(*extract(t)) for t in rb.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([rb.column(0), rb.column(1), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())],
                                                 names=["doc_id", "held_out", "score", "predicted"])
    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col).cast("long")).alias("held_out"), F.col(text).alias("text")).mapInArrow(
        _scoring(model), "doc_id long, held_out boolean, score double, predicted int")


def op9_weak_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return score(docs, train(docs, read(spark, sf_dir, "labels")))
