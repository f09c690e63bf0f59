"""Operators 11 to 13 against brute force, and their edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from fieldops.llm import license_scan, periodic_runs, spelling_variants

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, n_words string, word string, runs string"
EDGES = ["", None, " \n\t", "word", "A b", "x" * 5000, "é 🎈 日本 " * 50, "tie tie tie", "tie tie tie", "go " * 60, "Under The MIT License. " * 3]


def edges(spark):
    rows = [(i, t, "clash", None, "clash") for i, t in enumerate(EDGES)]
    return spark.createDataFrame([*rows, rows[-1], (None, "a null id " * 12, None, None, None), (None, None, None, None, None)], DOCS)


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# ------------------------------------------------------------------ periodic runs

def runs_by_brute_force(w, least=24, periods=3):
    """Every period's stretches, compared word by word."""
    found, n = {}, len(w)
    for p in range(1, n // periods + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            if j > i and j + p - i >= max(least, periods * p):
                found.setdefault((i, j + p - i), p)
            i = max(j, i + 1)
    return sorted((s, size, p) for (s, size), p in found.items())


def expected_runs(doc_id, text):
    w = WORD.findall(text or "")
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    runs = runs_by_brute_force(w)
    gone = {i for s, size, p in runs for i in range(s + p, s + size)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{size},{p}\n" for s, size, p in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_runs_of_random_words_against_brute_force():
    r = random.Random(11)
    for _ in range(1500):
        w = [r.randrange(r.choice([1, 2, 3, 30])) for _ in range(r.randrange(1, 130))]
        for _ in range(r.randrange(3)):
            a, p = r.randrange(len(w)), r.randrange(1, 9)
            for i in range(a + p, r.randrange(len(w) + 1)):
                w[i] = w[i - p]
        least, periods = r.choice([(24, 3), (6, 3), (8, 4), (3, 3)])
        assert periodic_runs.runs_of(np.array(w), least, periods) == runs_by_brute_force(w, least, periods)


def test_runs_of_long_texts_are_found_in_near_linear_work():
    assert periodic_runs.runs_of(np.arange(200_000) % 3) == [(0, 200_000, 3)]
    passage = np.arange(20)
    apart = np.concatenate([np.r_[passage, 1000 + i] for i in range(5000)])  # one passage after 5,000 other words
    assert periodic_runs.runs_of(apart) == []
    inner = np.r_[np.tile(np.arange(4), 8), 99]
    nested = np.tile(inner, 4)  # runs inside the periods of a run
    assert periodic_runs.runs_of(nested) == runs_by_brute_force(nested.tolist())


def test_op11_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(periodic_runs, "documents", lambda spark, sf_dir: documents(spark).select("doc_id", "text").unionByName(edges(spark).select("doc_id", "text")))
    got = sorted(map(tuple, periodic_runs.op11_periodic_runs(spark, SF).collect()), key=repr)
    rows = [*documents(spark).select("doc_id", "text").collect(), *edges(spark).select("doc_id", "text").collect()]
    assert got == sorted((expected_runs(*r) for r in rows), key=repr)
    assert sum(r[1] > 0 for r in got) > 10


def test_periodic_runs_operator_outputs(spark):
    rows = {r.doc_id: r for r in periodic_runs.periodic_runs(edges(spark)).collect()}
    assert [tuple(x) for x in rows[9].runs] == [(0, 60, 1)] and rows[9].collapsed == "go" and rows[1].n_words == 0 and rows[1].collapsed == ""
    assert [tuple(x) for x in rows[6].runs] == [(0, 150, 3)]
    assert periodic_runs.periodic_runs(edges(spark).limit(0)).collect() == []
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(edges(spark), min_periods=2)


# ------------------------------------------------------------------ licences

LICENSED = [
    "Released under the MIT License.", "under the mit license under the MIT-license", "Apache License, Version 2.0 and CC BY-NC 4.0", "cc by\nnc" * 3,
    "Permission is hereby granted, free of charge, to any human obtaining one copy of this software",
    "under the free and unencumbered software released into the public domain", "licence under mit the", "Éunder the mit license", "under\x00the\x7fmit license",
    "Licensed under the GNU General Public License, version 3", "GNU General Public License version 3 or GNU General Public License, version 2",
    "redistribution and use in source and binary forms; " * 40, "the of and " * 3000 + "under the mit license", "apache license version",
    "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
]


def licences_by_brute_force(texts):
    """Every template at every place of every text."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    templates = [(t, t.text.split(), license_scan._places(t)) for t in license_scan.TEMPLATES]
    known = {w for _, ws, _ in templates for w in ws}
    cut = [word.findall((t or "").translate(str.maketrans(license_scan.UPPER, license_scan.LOWER))) for t in texts]
    df = Counter(w for ws in cut for w in set(ws) & known)
    for ws in cut:
        matches = []
        for t, words, keys in templates:
            lead = sorted(set(words) & set(ws), key=lambda w: (df[w], w))[:license_scan.RARE]
            for o in range(-len(words), len(ws)):
                stands = [0 <= o + j < len(ws) and ws[o + j] == x for j, x in enumerate(words)]
                if all(all(stands[i:i + n]) for i, n in keys) and len({x for x, s in zip(words, stands, strict=True) if s and x in lead}) >= license_scan.AGREE:
                    matches.append((t.label, t.base, o, sum(stands) / len(words)))
        starts = [m[2] for m in matches if m[1]]
        yield (len(ws), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted({m[0] for m in matches if m[1]})),
               ",".join(sorted({m[0] for m in matches})), max((m[3] for m in matches), default=0.0))


def test_op12_against_brute_force_and_sql(spark):
    texts = LICENSED + EDGES
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in license_scan.license_report(docs).collect()}
    want = list(licences_by_brute_force(texts))
    assert [got[i] for i in range(len(texts))] == want
    assert want[0][1] == 1 and want[1][1] == 2 and want[9][5] == "gpl-3" and want[10][5] == "gpl-2,gpl-3" and want[11][5] == "bsd"
    c = duckdb.connect()
    c.register("documents", docs.toPandas())
    assert sorted(c.execute(license_scan.ORACLE).fetchall(), key=repr) == sorted(((i, *x) for i, x in enumerate(want)), key=repr)


def test_op12_base_places_of_the_table(spark):
    got = {r.doc_id: r for r in license_scan.op12_license_scan(spark, SF).collect()}
    phrases = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]
    n = 0
    for r in documents(spark).collect():
        ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", r.text.translate(str.maketrans(license_scan.UPPER, license_scan.LOWER)))
        places = [(i, x) for p, x in phrases for i in range(len(ws)) if ws[i:i + len(p.split())] == p.split()]
        g = got[r.doc_id]
        assert (g.n_words, g.n_base, g.base_labels) == (len(ws), len(places), ",".join(sorted({x for _, x in places})))
        assert (g.first_word, g.last_word) == (min((i for i, _ in places), default=None), max((i for i, _ in places), default=None))
        assert set(filter(None, g.base_labels.split(","))) <= set(g.labels.split(","))
        n += len(places)
    assert n == 3  # places that the small table holds


def test_license_edges(spark):
    got = license_scan.license_report(edges(spark)).collect()
    assert len(got) == len(EDGES) + 3 and {r.n_base for r in got if r.doc_id == 10} == {3}
    assert {(r.n_words, r.n_base, r.first_word, r.labels, r.score) for r in got if r.doc_id in (0, 1, 2)} == {(0, 0, None, "", 0.0)}
    assert license_scan.license_report(edges(spark).limit(0)).collect() == []
    assert license_scan.scan(edges(spark).withColumnRenamed("word", "labels")).columns == ["doc_id", "text", "n_words", "labels", "runs", "_l_n", "_l_matches"]


# ------------------------------------------------------------------ spelling variants

def words_by_brute_force(rows):
    total = Counter()
    for doc_id, text in rows:
        for w in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(str.maketrans(spelling_variants.UPPER, spelling_variants.LOWER))
            if doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{w}".encode())
                if h % 97 == 0:
                    w = w[:h % len(w)] + w[h % len(w) + 1:]
            total[w] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i, x in enumerate(a) if x != b[i]), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def variants_by_brute_force(words):
    """Near words by their deletions, each pair compared in full."""
    holes = defaultdict(set)
    for w in words:
        for x in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))}:
            holes[x].add(w)
    near = {w: {x for h in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))} for x in holes[h] if one_edit(w, x)} for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        yield (w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None)


def test_op13_against_brute_force(spark):
    rows = documents(spark).select("doc_id", "text").collect()
    want = sorted(variants_by_brute_force(words_by_brute_force(rows)))
    got = sorted(map(tuple, spelling_variants.op13_spelling_variants(spark, SF).collect()))
    assert got == want
    assert sum(r[1] is not None for r in got) > 50


@pytest.mark.parametrize("symbols", [1, 4, 9])
def test_variants_of_random_words(spark, symbols):
    r = random.Random(symbols)
    words = {"".join(r.choice("abcxÀÿ÷") for _ in range(r.randrange(1, 5))): r.randrange(1, 60) for _ in range(250)}
    words |= {"z" * 40: 5, "z" * 41: 11, "z" * 39 + "y": 30, "chain" + "s" * 5: 1, "chain" + "s" * 6: 2, "chain" + "s" * 7: 4, "chain" + "s" * 8: 8, "chain" + "s" * 9: 16}
    got = spelling_variants.group_variants(spark.createDataFrame(list(words.items()), "word string, n long"), symbols=symbols)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(variants_by_brute_force(words), key=repr)


def test_variant_edges(spark):
    assert spelling_variants.group_variants(spelling_variants.vocabulary(edges(spark).limit(0))).collect() == []
    got = {r.word: r.n for r in spelling_variants.vocabulary(edges(spark), id_col=None, least_letters=4).collect()}
    assert got["null"] == 12 and got["under"] == 6 and "word" not in got
    assert {r.word: r.n for r in spelling_variants.vocabulary(edges(spark)).collect()} == words_by_brute_force(
        edges(spark).select("doc_id", "text").collect())
