"""Texts that the operators once left out in part."""

import random
import string

from fieldops.llm import host_consensus, line_chunks, markov_secrets

PAGES = "page_id long, url string, html string"


def _words(n, seed):
    return " ".join(f"word{seed}x{i}" for i in range(n))


def test_article_outside_its_largest_container_stays(spark):
    lead, body, small = _words(12, 1), "".join(f"<p>{_words(30, i)}</p>" for i in range(9)), _words(40, 77)
    chrome = "<nav><a href=x>Home</a></nav>", '<div class="links"><a href=a>One link that is quite long here</a></div><footer>Foot</footer>'
    nested = f"<body>{chrome[0]}<article><h1>Title N</h1><p>{lead}</p><div class=body>{body}</div></article>{chrome[1]}</body>"
    sections = f"<body>{chrome[0]}<div id=c><section class=one>{body}</section><section class=two><p>{small}</p></section></div>{chrome[1]}</body>"
    flat = f"<body>{chrome[0]}<h1>Title N</h1><div class=text>{body}</div><footer>Foot</footer></body>"
    beside = f"<body><div>Login</div><div class=text>{body}</div><div>7 readers</div></body>"
    rows = [(10 * k + n, f"http://h{k}.example/{n}", h) for k, h in enumerate((nested, sections, flat, beside)) for n in range(3)]
    got = {r.page_id: r.text for r in host_consensus.extract(spark.createDataFrame(rows, PAGES)).collect()}
    paragraphs = [_words(30, i) for i in range(9)]
    assert got[1] == "\n".join(["Title N", lead, *paragraphs])
    assert got[11] == "\n".join([*paragraphs, small])
    assert got[21] == "\n".join(["Title N", *paragraphs])
    assert got[31] == "\n".join(paragraphs)


def test_minority_layout_of_a_host_is_whole(spark):
    article = "".join(f"<p>{_words(30, i)}</p>" for i in range(9))
    common = f"<body><div class=text>{article}</div></body>"
    other = f"<body><ul><li><a href=1>One link of a list</a></li></ul><div class=text>Photo.</div><td><div class=story>{article}</div></body>"
    rows = [(n, f"http://h.example/{n}", other if n == 9 else common) for n in range(10)]
    got = {r.page_id: r.text for r in host_consensus.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got[9] == got[0] == "\n".join(_words(30, i) for i in range(9))


def test_secret_beside_a_base_span_in_one_run_goes(spark):
    r = random.Random(5)
    key = "".join(r.choice(string.ascii_letters + string.digits + "+/") for _ in range(40))
    access = "AKIA" + "A1" * 8
    texts = [f"é {access}/{key} ok", f"{'0123456789abcdef' * 2}_{key}", f"{key}-{access}+{key}", f"{access}/short ok"]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    d = docs.unionByName(spark.createDataFrame([(10**9 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    model = markov_secrets.train(d)
    mine = d.where(f"doc_id >= {10**9}")
    assert [x.text for x in markov_secrets.redact(mine, model=model).orderBy("doc_id").collect()] == [
        "é [SECRET][SECRET] ok", "[SECRET][SECRET]", "[SECRET][SECRET][SECRET]", "[SECRET]/short ok"]
    spans = [x.spans for x in markov_secrets.secret_report(mine, model=model).orderBy("doc_id").collect()]
    assert spans[0] == "access:2:22,markov:22:63" and spans[2] == "markov:0:41,access:41:61,markov:61:102"


def _texts(spark, pages):
    rows = [(i, f"http://h{i}.example/{n}", h) for i, h in enumerate(pages) for n in range(3)]
    return {r.page_id: r.text for r in host_consensus.extract(spark.createDataFrame(rows, PAGES)).collect()}


def test_wrappers_named_after_what_stands_beside_keep_the_article(spark):
    paragraphs = [_words(30, i) for i in range(9)]
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    beside = f'<div class="sidebar"><p>{_words(25, 50)}</p></div><div class="footer-links"><p>{_words(20, 51)}</p></div>'
    names = ["layout sidebar-right", "content-with-sidebar", "social-issues", "market-share-report", "has-footer", "widget-area"]
    got = _texts(spark, [f'<body><div class="{n}"><h1>Title N</h1>{body}{beside}</div></body>' for n in names])
    assert [got[i] for i in range(len(names))] == ["\n".join(["Title N", *paragraphs])] * len(names)
    got = _texts(spark, [f'<body><div class="{n}"><div class="text">{body}</div>{beside}</div></body>' for n in names])
    assert [got[i] for i in range(len(names))] == ["\n".join(paragraphs)] * len(names)


def test_header_of_an_article_stays_and_nested_boilerplate_goes(spark):
    lead, body = _words(15, 70), "".join(f"<p>{_words(30, i)}</p>" for i in range(9))
    paragraphs = [_words(30, i) for i in range(9)]
    comments = "".join(f"<li><article class=comment-body><p>{_words(60, 80 + i)}</p></article></li>" for i in range(9))
    page = (f'<body><header><h1>Site</h1><p>Slogan</p></header><div class="site-header"><h1>Logo</h1></div><article><header class="entry-header"><h1>Title</h1>'
            f'<p>{lead}</p></header>{body}<div class="share">Share this</div><div class="related-posts"><p>Two</p></div><footer>By me</footer></article>'
            f'<section id="comments"><ol>{comments}</ol></section></body>')
    assert _texts(spark, [page])[0] == "\n".join(["Title", lead, *paragraphs])
    formula = f"<body><article>{body}<p>where <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p><xmp>a <b> &amp; c</xmp></article></body>"
    assert _texts(spark, [formula])[0] == "\n".join([*paragraphs, "where x=2 holds", "a <b> &amp; c"])


def test_hot_host_clashing_columns_and_repeated_pages(spark):
    body = "".join(f"<p>{_words(30, i)}</p>" for i in range(9))
    rows = [(i, "http://hot.example/x" if i % 3 else f"http://h{i}.example/", f"<body><div class=text>{body}</div></body>", "a", 1) for i in range(90)]
    rows += [rows[1], rows[1], (None, None, None, None, None)]
    got = host_consensus.extract(spark.createDataFrame(rows, PAGES + ", host string, salt int")).collect()
    assert len(got) == 93 and {r.text for r in got} == {"\n".join(_words(30, i) for i in range(9)), ""}


def test_line_counts_replace_columns_of_their_names(spark):
    passage = "\n".join(_words(9, i) for i in range(8))
    rows = [(i, passage, "x", -1) for i in range(3)] + [(None, None, None, None)]
    got = line_chunks.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, n_lines string, n_removed int"))
    assert got.columns == ["doc_id", "text", "n_lines", "n_chunks", "n_removed", "lines_removed"]
    by_id = {r.doc_id: r for r in got.collect()}
    assert by_id[0].text == passage and by_id[0].n_lines == 8 and by_id[None].n_lines == 0
    assert by_id[1].n_removed > 0 and by_id[1].lines_removed > 0
