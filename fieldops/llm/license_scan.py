"""License scans by a positional index of rare words (operator 12), native.

Licence templates are word lists with mandatory key phrases; a phrase that the
base rules look for is a template that is one key phrase.  The index holds for
every template word its places there, and its document frequency in the corpus
(all documents are counted).

1. A text is cut into words once.  Its licence words are its words that stand in any
   template; a template is open for a text that holds all words of its
   key phrases.  Only texts with an open template go on with their words.
2. Each open template is looked up by the ``RARE`` of its words that have the
   highest IDF among the text's licence words.  A word at place p of the text that stands
   at place j of the template (its posting) says that the template begins at
   p - j.  Beginnings on which ``AGREE`` different rare words agree stay: the
   postings' intersection by relative position.
3. There the key phrases are verified word by word.  The share of the template's
   words that stand in place is the match's score.

Every true place of a phrase survives step 2, as all its words are in place.
All steps but the count of document frequencies work inside a row, so no key
gathers rows; the counts are at most one row a template word and are all that
reaches the driver.  The work on a text is linear in its licence words.

Cases: null and empty texts have no words, no place and score 0; a phrase that
occurs twice counts twice; ties between equally rare words go by the word;
repeated rows get a row each; a null id is passed through; an empty table gives an
empty result; extra columns are ignored.  Very long texts are scanned whole.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldops.llm.common import documents, fixed, staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word: letters, digits and everything beyond ASCII, after A-Z became a-z.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RARE = 4
AGREE = 2


class Template(NamedTuple):
    label: str
    text: str
    keys: Sequence[str] = ()  # mandatory phrases; none: the whole text is one
    base: bool = False


#: The base rules' phrases, then the opening words of public licences.
TEMPLATES = [
    Template("mit", "under the mit license", base=True),
    Template("apache-2", "apache license version 2", base=True),
    Template("cc-by-nc", "cc by nc", base=True),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
             ["permission is hereby granted free of charge"]),
    Template("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
             ["you may not use this file except in compliance with the license"]),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
             ["redistribution and use in source and binary forms"]),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
             ["permission to use copy modify", "with or without fee"]),
    Template("gpl-2", "licensed under the gnu general public license version 2", ["gnu general public license version 2"]),
    Template("gpl-3", "licensed under the gnu general public license version 3", ["gnu general public license version 3"]),
    Template("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
             ["under the terms of the gnu general public license"]),
    Template("lgpl", "licensed under the gnu lesser general public license version", ["gnu lesser general public license"]),
    Template("agpl-3", "licensed under the gnu affero general public license version 3", ["gnu affero general public license"]),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    Template("epl-2", "made available under the terms of the eclipse public license 2 0", ["eclipse public license"]),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ["free and unencumbered software"]),
    Template("cc-by", "licensed under a creative commons attribution 4 0 international license", ["creative commons attribution 4 0 international"]),
    Template("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license", ["creative commons attribution sharealike"]),
    Template("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license", ["creative commons attribution noncommercial"]),
    Template("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
             ["waived all copyright and related or neighboring rights"]),
]

PLACE = "struct<start:int,matched:int>"


def _places(t: Template) -> list[tuple[int, int]]:
    """(place, words) of each key phrase in the template's words."""
    words, out = t.text.split(), []
    for phrase in t.keys or [t.text]:
        k = phrase.split()
        at = next((i for i in range(len(words) - len(k) + 1) if words[i:i + len(k)] == k), None)
        if at is None:
            raise ValueError(f"key phrase {phrase!r} isn't in the template {t.text!r}")
        out.append((at, len(k)))
    return out


def vocabulary(templates: Sequence[Template]) -> list[str]:
    return sorted({w for t in templates for w in t.text.split()})


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _words(xs: Sequence[str]) -> Column:
    return F.array(*[F.lit(x) for x in xs])


def cut(docs: DataFrame, templates: Sequence[Template], text: str) -> DataFrame:
    """``docs`` with ``_l_n`` (words), ``_l_found`` (licence words), ``_l_open``
    (numbers of the open templates) and, where there are any, ``_l_words``."""
    t = F.translate(F.col(text), UPPER, LOWER)
    d = fixed(docs, _l_all=F.coalesce(F.regexp_extract_all(t, F.lit(WORD), F.lit(0)), F.array().cast("array<string>")))
    d = fixed(d, _l_found=F.array_intersect("_l_all", _words(vocabulary(templates))))
    needs = [sorted({w for i, n in _places(x) for w in x.text.split()[i:i + n]}) for x in templates]
    known = F.array(*[F.struct(F.lit(i).alias("t"), _words(ws).alias("need")) for i, ws in enumerate(needs)])
    opens = F.transform(F.filter(known, lambda k: F.forall(k["need"], lambda w: F.array_contains("_l_found", w))), lambda k: k["t"])
    d = fixed(d, _l_open=F.when(F.size("_l_found") >= min(map(len, needs)), opens).otherwise(F.array().cast("array<int>")))
    return d.select(*docs.columns, F.size("_l_all").cast("long").alias("_l_n"), "_l_found", "_l_open",
                    F.when(F.size("_l_open") > 0, F.col("_l_all")).alias("_l_words"))


def frequencies(cuts: DataFrame) -> dict[str, int]:
    """Documents that hold each licence word: at most one row a template word."""
    return {r["w"]: r["n"] for r in cuts.select(F.explode("_l_found").alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}


def index(templates: Sequence[Template], df: dict[str, int]) -> Column:
    """The index as one literal: per template its label, words, key phrases and
    its different words, the highest IDF first, with their places."""
    def one(t: Template) -> Column:
        words = t.text.split()
        ranked = sorted(set(words), key=lambda w: (df.get(w, 0), w))
        return F.struct(
            F.lit(t.label).alias("label"), F.lit(t.base).alias("base"), _words(words).alias("words"),
            F.array(*[F.struct(F.lit(i).alias("at"), _words(words[i:i + n]).alias("phrase")) for i, n in _places(t)]).alias("keys"),
            F.array(*[F.struct(F.lit(w).alias("w"), F.array(*[F.lit(j) for j, x in enumerate(words) if x == w]).alias("js")) for w in ranked]).alias("ranked"))
    return F.array(*map(one, templates))


def _look_up(t: Column, rare: int, agree: int) -> Column:
    """The verified places of one template of the index in a row of ``cut``."""
    lead = F.slice(F.filter(t["ranked"], lambda x: F.array_contains("_l_found", x["w"])), 1, rare)
    begins = lambda x: F.array_distinct(F.flatten(F.transform(
        F.filter("_l_hits", lambda h: h["w"] == x["w"]), lambda h: F.transform(x["js"], lambda j: h["p"] - j))))
    # Each rare word names a beginning once; one that ``agree`` of them name stands that often in a row.
    agreed = _bind(F.array_sort(F.flatten(F.transform(lead, begins))), lambda s: F.array_distinct(
        F.filter(s, lambda o, i: F.coalesce(F.get(s, i - (agree - 1)) == o, F.lit(False)))))
    holds = lambda o, k: F.when(o + k["at"] >= 0, F.slice("_l_words", o + k["at"] + 1, F.size(k["phrase"])) == k["phrase"]).otherwise(False)
    verified = F.filter(agreed, lambda o: F.forall(t["keys"], lambda k: holds(o, k)))
    in_place = lambda o: F.size(F.filter(t["words"], lambda w, j: F.coalesce(F.get("_l_words", o + j) == w, F.lit(False))))
    return F.transform(verified, lambda o: F.struct(o.alias("start"), in_place(o).alias("matched")))


def scan(docs: DataFrame, text: str = "text", templates: Sequence[Template] = TEMPLATES, rare: int = RARE, agree: int = AGREE) -> DataFrame:
    """``docs`` (working columns begin with ``_l_``) with ``_l_n`` and ``_l_matches``: per verified place its
    ``label``, ``base``, ``start`` (word number of the template's first word, under 0 where the template's head is cut off) and ``score``."""
    cuts = staged(cut(docs, templates, text), "license-words")
    known = index(templates, frequencies(cuts))
    hits = F.filter(F.transform("_l_words", lambda w, i: F.struct(w.alias("w"), i.alias("p"))), lambda h: h["w"].isin(vocabulary(templates)))
    d = fixed(cuts, _l_hits=F.when(F.size("_l_open") > 0, hits))
    match = lambda t, m: F.struct(t["label"].alias("label"), t["base"].alias("base"), m["start"].alias("start"),
                                  (m["matched"] / F.size(t["words"])).alias("score"))
    per = F.transform("_l_open", lambda n: _bind(F.get(known, n), lambda t: F.transform(_look_up(t, rare, agree), lambda m: match(t, m))))
    none = F.array().cast("array<struct<label:string,base:boolean,start:int,score:double>>")
    return fixed(d, _l_matches=F.when(F.size("_l_open") > 0, F.flatten(per)).otherwise(none)).select(*docs.columns, "_l_n", "_l_matches")


def license_report(docs: DataFrame, id_col: str = "doc_id", text: str = "text", templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """Per row: words, the base phrases' places, labels and the best match's score (see the query's contract)."""
    found = scan(docs.select(F.col(id_col).alias("_l_id"), F.col(text).alias("_l_text")), "_l_text", templates)
    d = fixed(found, _l_base=F.filter("_l_matches", lambda m: m["base"]))
    listed = lambda ms: F.array_join(F.array_sort(F.array_distinct(F.transform(ms, lambda m: m["label"]))), ",")
    starts = F.transform("_l_base", lambda m: m["start"])
    return d.select(
        F.col("_l_id").alias(id_col), F.col("_l_n").alias("n_words"), F.size("_l_base").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        listed("_l_base").alias("base_labels"), listed("_l_matches").alias("labels"),
        F.coalesce(F.array_max(F.transform("_l_matches", lambda m: m["score"])), F.lit(0.0)).alias("score"))


def op12_license_scan(spark, sf_dir: str) -> DataFrame:
    return license_report(documents(spark, sf_dir))


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)


def oracle(templates: Sequence[Template] = TEMPLATES, rare: int = RARE, agree: int = AGREE) -> str:
    """The same result in DuckDB: every alignment of every template is counted, without an index."""
    words = [(n, j, w) for n, t in enumerate(templates) for j, w in enumerate(t.text.split())]
    keys = [(n, j) for n, t in enumerate(templates) for j in sorted({i + x for i, size in _places(t) for x in range(size)})]
    sizes = [(n, t.label, str(t.base).lower(), len(t.text.split()), sum(k[0] == n for k in keys)) for n, t in enumerate(templates)]
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+'), []) AS ws FROM documents),
tw(t, j, w) AS (VALUES {_values(words)}),
kp(t, j) AS (VALUES {_values(keys)}),
info(t, label, base, size, n_key) AS (VALUES {", ".join(f"({n}, '{a}', {b}, {c}, {k})" for n, a, b, c, k in sizes)}),
places AS (
  SELECT rid, p - 1 AS p, w FROM (SELECT rid, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS p FROM d)
  WHERE w IN (SELECT w FROM tw)),
df AS (SELECT w, count(DISTINCT rid) AS n FROM places GROUP BY w),
lead_words AS (
  SELECT rid, t, w FROM (
    SELECT rid, t, w, row_number() OVER (PARTITION BY rid, t ORDER BY n, w) AS r
    FROM (SELECT DISTINCT rid, w FROM places) JOIN (SELECT DISTINCT t, w FROM tw) USING (w) JOIN df USING (w))
  WHERE r <= {rare}),
aligned AS (
  SELECT p.rid, tw.t, p.p - tw.j AS start, count(*) AS matched, count(kp.j) AS key_matched, count(DISTINCT l.w) AS agreed
  FROM places p JOIN tw ON p.w = tw.w LEFT JOIN kp ON kp.t = tw.t AND kp.j = tw.j
       LEFT JOIN lead_words l ON l.rid = p.rid AND l.t = tw.t AND l.w = p.w
  GROUP BY ALL),
found AS (
  SELECT rid, label, base, start, matched::DOUBLE / size AS score
  FROM aligned JOIN info USING (t) WHERE agreed >= {agree} AND key_matched = n_key),
per AS (
  SELECT rid, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
  FROM found GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN per USING (rid)"""


ORACLE = oracle()
