"""Operators of the llm subpackage: small cases, brute force, round trips, held-out accuracy."""

import base64
import hashlib
import html
import io
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fieldops.llm import (
    adaptive_quality, collision_ann, graph, host_consensus, line_chunks, markov_secrets, mixture_packing, queries, tensor_minhash, unigram_codec,
    warc_salvage, weak_toxicity,
)

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def docs_of(spark, *texts):
    return frame(spark, [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)])


def duck():
    c = duckdb.connect()
    for t in ("documents", "pages", "labels", "embeddings"):
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle(spark, name):
    mine = queries.QUERIES[name](spark, SF).toPandas()
    want = duck().execute(queries.ORACLE[name]).df()
    assert sorted(mine.columns) == sorted(want.columns)
    rows = lambda d: sorted(map(repr, d[sorted(d.columns)].astype(object).where(d.notna(), None).itertuples(index=False, name=None)))
    norm = lambda r: [re.sub(r"(\d+)\.0\b", r"\1", x) for x in r]
    assert norm(rows(mine)) == norm(rows(want))


EDGES = ["", None, " \n\t", "word", "A b", "x" * 5000, "é 🎈 日本 " * 50, "tie tie tie", "tie tie tie"]


def test_every_document_operator_handles_edges_and_empty_tables(spark):
    rows = [(i, t, None if i % 2 else "en", None if i % 3 else "s", None, "clash") for i, t in enumerate(EDGES)] + [(None, "null id here", None, None, None, "x"), (1, None, None, None, None, "x")]
    schema = DOCS + ", n_words string"
    full, none = frame(spark, rows, schema), frame(spark, [], schema)
    model = weak_toxicity.fit([], [], np.array([], dtype=int))
    codec = unigram_codec.load_model(unigram_codec.default_model())
    for f in (adaptive_quality.quality_report, adaptive_quality.filter_documents, line_chunks.dedup_lines, tensor_minhash.near_classes, tensor_minhash.keep_one,
              markov_secrets.secret_report, markov_secrets.redact, mixture_packing.pack, lambda d: weak_toxicity.score(d, model), lambda d: unigram_codec.encode(d, codec)):
        assert f(none).collect() == []
        out = f(full).collect()
        if f not in (adaptive_quality.filter_documents, tensor_minhash.keep_one, mixture_packing.pack):
            assert len(out) == len(rows)


def test_host_consensus(spark):
    page = ('<html><head><title>t</title><script>var a="</p>";</script></head><body><header>Site</header><nav><a href=x>Home</a></nav>'
            '<div class="cookie-notice">We use cookies</div><div class="post-{n}"><h1>Title  {n}</h1><p>First &amp; <b>bold</b>\n text {n}, long enough to count.<p>Second&nbsp;one'
            '<form><p>Search</form><div class="ad">Buy</div><ul><li>a<li>b</ul></div><aside>Side</aside><section id="comments"><p>A reader comment that is quite long, longer than the article itself. ' + "blah " * 50 +
            '</section><footer>&copy; 2020</footer>')
    rows = [(n, f"http://Host.example/{n}", page.replace("{n}", str(n))) for n in range(5)] + [(9, None, None), (10, "http://x/", ""), (11, "bad", "<p>a < b &lt; c <!-- open")]
    got = {r.page_id: r for r in host_consensus.extract(frame(spark, rows, "page_id long, url string, html string")).collect()}
    assert len(got) == 8
    assert got[3].text == "Title 3\nFirst & bold text 3, long enough to count.\nSecond one\na\nb"
    assert got[9].text == got[10].text == "" and got[9].n_chars == 0
    assert got[11].text == "a < b < c"
    assert host_consensus.extract(frame(spark, [], "page_id long, url string, html string")).collect() == []


def test_host_consensus_on_pages(spark):
    pages = duck().execute("select page_id, html from pages").fetchall()
    got = {r.page_id: r.text for r in host_consensus.op1_host_consensus(spark, SF).collect()}
    for page_id, h in pages:
        body = re.search("<article>(.*?)(</article>|$)", h, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split("</?(?:p|h1)>", body)]
        assert got[page_id] == "\n".join(b for b in blocks if b)


def test_collision_ann_recall_and_ties(spark):
    rows = duck().execute("select vec_id, embedding from embeddings order by vec_id").fetchall()
    x = np.array([r[1] for r in rows], dtype=float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    got = collision_ann.op2_collision_ann(spark, SF).collect()
    hit = total = 0
    for i, (vec_id, _) in enumerate(rows):
        if vec_id % 50 == 0:
            s = x @ x[i]
            s[i] = -9
            want = {rows[j][0] for j in np.argsort(-s)[:5]}
            mine = {r.vec_id: r.score for r in got if r.query_id == vec_id}
            hit, total = hit + len(want & mine.keys()), total + 5
            assert all(abs(s[[r[0] for r in rows].index(v)] - c) < 1e-6 for v, c in mine.items())
    assert hit >= 0.9 * total
    few = [(0, [1.0, 0.0]), (3, [2.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 1.0]), (4, [0.0, 0.0]), (5, None), (6, [float("nan"), 1.0]), (7, [None, 1.0]), (8, []), (None, [1.0, 1.0])]
    t = frame(spark, few, "vec_id long, embedding array<float>")
    out = collision_ann.nearest(t, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r.vec_id, round(r.score, 9)) for r in out] == [(1, 1.0), (3, 1.0), (2, 0.0)]
    assert collision_ann.nearest(t.limit(0), F.col("vec_id") == 0).collect() == []


def _base(t):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    spans = [(m.start(), 0, m.end(), "assign") for m in assign.finditer(t) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))


def test_markov_secrets(spark):
    r = random.Random(3)
    token = "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(44))
    extra = [f"é🎈 the key is {token} ok", "api_key='abc' Token: secret=token = abcdef1", "AKIA" + "A1" * 8 + " AKIAB2", "no password: x", "the_quick_brown_fox_jumped_over_words and extraordinarily-longwinded-identifier",
             "password=" + "deadbeef" * 4]
    texts = [t or "" for (t,) in duck().execute("select text from documents").fetchall()] + extra
    d = frame(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    got = {x.doc_id: x for x in markov_secrets.secret_report(d).collect()}
    for i, t in enumerate(texts):
        assert got[i].base_sha256 == hashlib.sha256(_base(t).encode()).hexdigest()
        assert set(filter(None, _base(t).split(","))) <= set(got[i].spans.split(","))
    n = len(texts) - len(extra)
    at = extra[0].index(token)
    assert got[n].spans == f"markov:{at}:{at + 44}" and got[n + 4].spans == ""
    red = {x.doc_id: x.text for x in markov_secrets.redact(d).collect()}
    assert red[n] == "é🎈 the key is [SECRET] ok" and red[n + 5] == "[SECRET]" and red[n + 4] == extra[4]


def test_unigram_codec_against_brute_force_and_library(spark):
    model = unigram_codec.load_model(unigram_codec.default_model())
    codec = unigram_codec.Codec(model)
    by_piece = {p: i for i, p in enumerate(model.pieces) if model.kinds[i] in (1, 4)}

    def brute(text):
        s = codec.marked(text).encode()
        best = {0: 0.0}
        for i in range(len(s)):
            if i not in best:
                continue
            width = len(s[i:].decode("utf-8", "ignore")[0].encode())
            for j in range(i + 1, min(len(s), i + model.longest) + 1):
                p = by_piece.get(s[i:j])
                score = model.scores[p] if p is not None else model.unknown if j == i + width else None
                if score is not None and best[i] + score > best.get(j, -1e300):
                    best[j] = best[i] + score
        return best[len(s)]

    def score(ids):
        out, run = 0.0, b""
        for i in ids:
            if model.kinds[i] == unigram_codec.BYTE:
                run += codec.plain[i]
                try:
                    run.decode()
                    out, run = out + model.unknown, b""
                except UnicodeDecodeError:
                    pass
            else:
                out += model.scores[i]
        return out

    texts = ["", "  two  spaces ", "plain words here", "日本語 🎈🎈 ñandú\n\tx", "▁mark", "a" * 300, "퟿"] + [t[:400] for (t,) in duck().execute("select text from documents limit 25").fetchall()]
    for t, raw in zip(texts, codec.encode(texts), strict=True):
        ids = np.frombuffer(raw, "<u4").tolist()
        assert codec.decode(ids) == t.replace("▁", " ")
        if t:
            assert abs(score(ids) - brute(t)) < 1e-6
    out = unigram_codec.op4_unigram_codec(spark, SF).collect()
    assert out and all(r.round_trip for r in out)
    assert codec.decode(None) == "" and codec.decode([-1, 10**6, 1]) == ""


def test_line_chunks_shift_and_keep(spark):
    passage = [f"shared line number {i} of the passage" for i in range(12)]
    long = "one " * 60
    a, b, c = "\n".join(["own a", *passage, "end a"]), "\n".join(["own b", "another b", "third b", *passage, "end b"]), f"x\n{long}\ny"
    d = docs_of(spark, a, b, c, f"z {1}\n{long}", None, "")
    got = {r.doc_id: r for r in line_chunks.dedup_lines(d).collect()}
    assert got[0].text == a and got[2].text == c and got[4].text is None and got[5].text == ""
    assert got[1].lines_removed >= 6 and got[1].text.startswith("own b") and got[1].text.endswith("end b")
    assert got[3].text == "z 1"


def test_warc_round_trip_and_salvage(spark, tmp_path):
    want = {r[0]: (r[1] or "") for r in duck().execute("select page_id, html from pages").fetchall()}
    got = {r.page_id: r for r in warc_salvage.op6_warc_salvage(spark, SF).collect()}
    assert got.keys() == want.keys()
    for i, h in want.items():
        raw = h.encode()
        assert got[i].payload_bytes == len(raw) and got[i].payload_digest == base64.b32encode(hashlib.sha1(raw).digest()).decode()
    pages = frame(spark, [(1, "u", "same"), (2, None, "same"), (3, "a b\n", ""), (4, "u", None), (5, "u", "other")], "page_id long, url string, html string")
    m = warc_salvage.write_archives(pages, f"file:{tmp_path}/w")
    r = {x.record_id: x for x in warc_salvage.read_archives(m).collect()}
    kinds = {k[10:-1]: (x.warc_type, x.refers_to, x.payload_length) for k, x in r.items()}
    assert kinds == {"1": ("revisit", "<urn:page:2>", 4), "2": ("response", None, 4), "3": ("revisit", "<urn:page:4>", 0), "4": ("response", None, 0), "5": ("response", None, 5)}
    assert warc_salvage.read_archives(warc_salvage.write_archives(pages.limit(0), f"file:{tmp_path}/e")).collect() == []

    for pack in (warc_salvage.member, lambda x: x):
        parts = [pack(warc_salvage.record(i, "http://x/", (f"<p>{i}" * 40).encode(), None, False)) for i in range(8)]
        whole = bytearray(b"".join(parts))
        at = len(b"".join(parts[:3])) - 30
        whole[at:at + 4] = b"\0\1\2\3"
        broken = bytes(whole[:-7]) + b""
        out = list(warc_salvage.salvage(io.BytesIO(broken), len(broken)))
        assert [x[4]["warc-record-id"] for x in out if x[0] == "record"] == [f"<urn:page:{i}>" for i in (0, 1, 3, 4, 5, 6)]
        assert [(x[1], x[2]) for x in out if x[0] == "gap"] == [(len(b"".join(parts[:2])), len(parts[2])), (len(b"".join(parts[:7])), len(parts[7]) - 7)]
        assert sum(x[2] for x in out) == len(broken)
    assert list(warc_salvage.salvage(io.BytesIO(b"junk" * 10), 40)) == [("gap", 0, 40, "neither a member nor a version line", {}, None)]


def test_near_duplicates_hot_cluster(spark):
    r = random.Random(1)
    base = [f"w{r.randrange(10**6)}" for _ in range(120)]
    texts = [" ".join(base)]
    for i in range(150):
        w = list(base)
        for _ in range(r.randrange(1, 12)):
            w[r.randrange(len(w))] = f"x{i}{r.randrange(10**6)}"
        texts.append(" ".join(w))
    texts += ["a b", "A  B\n", "", None, "solo"]
    got = {x.doc_id: x for x in tensor_minhash.near_classes(docs_of(spark, *texts)).collect()}
    sets = [{tuple(w[i:i + 2]) for i in range(len(w) - 1)} or ({tuple(w)} if w else set()) for w in ((t or "").lower().split() for t in texts)]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if x in (a, b) else x for x in root]
    assert [got[i].component_id for i in range(len(texts))] == root
    assert [got[i].n_shingles for i in range(len(texts))] == [len(s) for s in sets]


def test_connected_components(spark):
    e = frame(spark, [(i, i + 1) for i in range(40) if i != 20] + [(5, 5), (None, 3)], "a long, b long")
    got = {r.node: r.root for r in graph.connected_components(e).collect()}
    assert got == {i: 0 if i <= 20 else 21 for i in range(41)}
    assert graph.connected_components(e.limit(0)).collect() == []


def test_quality_keeps_clean_and_drops_symbol_noise(spark):
    r = random.Random(5)
    clean = [" ".join(r.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(r.randrange(10**6)) for _ in range(60)) for _ in range(60)]
    noisy = [" ".join(w + "###" for w in t.split()) for t in clean[:3]]
    got = {x.doc_id: x for x in adaptive_quality.quality_report(docs_of(spark, *clean, *noisy)).collect()}
    assert all(got[i].kept for i in range(60)) and not any(got[60 + i].kept for i in range(3))
    kept = adaptive_quality.filter_documents(docs_of(spark, *clean, *noisy))
    assert kept.count() == 60 and kept.columns == corpus_pipeline.COLUMNS


def test_quality_fences_follow_the_group_and_each_rejects_a_planted_text(spark):
    r = random.Random(6)
    word = lambda: f"{r.choice('alpha beta gamma delta epsilon zeta eta theta'.split())}{r.randrange(10**6)}"
    lines = lambda n=8, k=15: [" ".join(word() for _ in range(k)) for _ in range(n)]

    def mild(i, much):
        x = lines()
        if i % (15 if much == 1 else 5) == 1:
            x[0] += " " + "#" * 10 * much
        if i % 15 == 2:
            x += ["one short line"] * (1 + much)
        if i % 15 == 3:
            x += [" ".join(x[0].split()[:8 + much])]
        return "\n".join(x)

    rows = [(1000 * g + i, mild(i, much), lang, "s", 0) for g, (lang, much) in enumerate((("en", 1), ("fr", 3))) for i in range(300)]
    bad = ["\n".join(x.replace(" ", "### ") for x in lines()), "\n".join([*lines(), *["one short line"] * 8]),
           "\n".join([*(x := lines()), " ".join(x[0].split()[:15] + x[1].split()[:5])]), "\n".join(" ".join(word() * 3 for _ in range(15)) for _ in range(8))]
    docs = frame(spark, rows + [(5000 + i, t, "en", "s", 0) for i, t in enumerate(bad)])
    got = {x.doc_id: x for x in adaptive_quality.quality_report(docs).collect()}
    assert [(got[5000 + i].base_failed, got[5000 + i].kept) for i in range(4)] == [(False, False)] * 4
    assert sum(got[k].kept for k in got if k < 5000) >= 0.98 * 600
    limits = adaptive_quality.thresholds(adaptive_quality._measured(docs, "doc_id", "text", "lang", "source")).orderBy("lang").collect()
    assert all(limits[0][f"{m}_hi"] < limits[1][f"{m}_hi"] for m in ("sym", "dup", "rep")) and limits[0]["rep_hi"] < 0.3


def test_toxicity_label_model_and_held_out(spark):
    r = np.random.default_rng(0)
    y = (r.random(4000) < 0.3).astype(int)
    fire = lambda hit, miss: (r.random(4000) < np.where(y == 1, hit, miss)).astype(float)
    a = fire(0.8, 0.1)
    votes = np.stack([a, a, fire(0.7, 0.05), fire(0.5, 0.5)], axis=1)
    post, rates, correlation = weak_toxicity.label_model(votes, votes[:, 2] * 0.8 + 0.1)
    assert ((post > 0.5) == y).mean() > 0.85 and correlation[0, 1] > 0.99 and abs(correlation[0, 2]) < 0.2
    assert rates[0, 1] > rates[0, 0] + 0.4
    got = {x.doc_id: x for x in weak_toxicity.op9_weak_toxicity(spark, "/root/testdata/sf0.01").collect()}
    labels = duckdb.sql("select doc_id, toxic from '/root/testdata/sf0.01/labels.parquet'").fetchall()
    for i, x in got.items():
        assert x.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= x.score <= 1 and x.predicted == int(x.score >= 0.5)
    pos = np.array([got[i].score for i, t in labels if t == 1 and got[i].held_out])
    neg = np.array([got[i].score for i, t in labels if t == 0 and got[i].held_out])
    assert np.mean([(neg < p).mean() + 0.5 * (neg == p).mean() for p in pos]) > 0.8 and (neg >= 0.5).mean() < 0.05


def test_packing(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    odd = ["a  b", " lead", "trail ", "\n\n x", "tab\there", "don't  stop\n", " x y", "日本 語", "x\x1cy z", "it's we'll  'quoted'\n", ""]
    texts = [x or "" for (x,) in duck().execute("select text from documents").fetchall()] + odd
    encode = mixture_packing.Encoder()
    want = [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(encode(x), "<u2").tolist() for x in texts] == want
    d = frame(spark, [(i, x, None, f"s{i % 4}" if i % 7 else None, 0) for i, x in enumerate(texts)])
    pieces = mixture_packing.pack(d, group_bytes=200_000).collect()
    place, seen = {}, {i: 0 for i in range(len(texts))}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == place.get(p.sequence_id, 0)
        place[p.sequence_id] = p.offset + p.length
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        ids = want[p.doc_id] + [1]
        assert p.start == seen[p.doc_id] and p.doc_tokens == len(ids) and p.length > 0
        seen[p.doc_id] += p.length
        assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start:p.start + p.length], "<u4").tobytes())
    assert all(seen[i] == len(want[i]) + 1 for i in seen)
    groups = {s >> 24 for s in place}
    assert max(place.values()) <= 2048 and sum(n < 2048 for n in place.values()) <= len(groups)


def test_round_robin_shares():
    turns = list(mixture_packing.take_turns([50_000, 30_000, 20_000], [0.5, 0.3, 0.2], [0, 0, 0], 1000))
    assert all(sum(n for _, n in t) == 1000 for t in turns)
    assert all(abs(n - 1000 * (0.5, 0.3, 0.2)[q]) <= 1 for t in turns for q, n in t)
    ahead = list(mixture_packing.take_turns([10_000, 10_000], [0.5, 0.5], [300.0, -300.0], 1000))
    assert dict(ahead[0]) == {0: 800, 1: 200}


def test_pipeline(spark):
    docs = corpus_pipeline.documents(spark, SF)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.staged(stage(spark, docs, SF), "t")
        assert out.columns == corpus_pipeline.COLUMNS and 0 < out.count() <= docs.count()
        docs = out
    assert not any(_base(r.text) for r in docs.collect())
    assert docs.where("n_chars <> length(text)").count() == 0
    pieces = mixture_packing.pack(docs)
    assert pieces.select("doc_id").distinct().count() == docs.count()
    assert corpus_pipeline.run(spark, SF).count() == pieces.count()
    assert os.path.exists(SF)
