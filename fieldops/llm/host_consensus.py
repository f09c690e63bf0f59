"""Main text of pages by consensus of each host's pages (operator 1).

1. Every page is parsed once; the text blocks outside boilerplate are credited to
   the containers around them (their parent in full, the next one by half, less
   what lies in links), and the best container votes for its generalised path:
   the tags from the root with their classes, digits replaced by ``#``.
2. Votes are counted per (host, path) in Spark; each host keeps its ``PATHS``
   paths with most votes.
3. Every page is extracted anew by the first of its host's paths that holds most
   of its credited text; a page where none does uses its own best container.
   Either is widened on the page: to the enclosing article or main, and to the
   parent while that adds no block made of links (to the whole body only where
   what it adds is headings and long blocks in the main).

Boilerplate is dropped wherever it stands: navigation, page headers and footers,
sidebars, notices, adverts, forms, scripts, styles, comments, by tag, role, or
the words of class and id.  A name of several words says less, and a wrapper may
be named after what stands beside it, so an element is not dropped by its name
if it holds the main, a heading of the first level with a long block, or, where its name
says something else besides, most of the page's credited text and each article
and main (reader comments excepted); nor is a header inside an article.

Cases: null or empty html has an empty text; a null url or one without a host
belongs to the host ''; equal votes go to the smaller path; broken markup
(unclosed elements, comments, quotes, a cut-off page) is read as browsers do, in
the main; repeated rows each get a row; an empty table gives an empty result;
extra columns are ignored; very long pages are parsed whole, one at a time.  Pages
of a host that holds more than a ``HOT``-th of all are dealt over several tasks.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldops.llm.common import read, row_slices, staged

PATHS = 5  # of a host
HOT = 1000
DEALT = 64  # tasks for the pages of a hot host
LONG = 40  # characters of a block that counts in full
WORDS_OF_PATH = 24  # elements of a path, from the innermost
#: Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp svg".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                  "header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul caption".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTAINERS = frozenset("article blockquote body center dd div dl main ol section table tbody td tr ul figure details".split())
ENDS_P = BLOCK - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend", "summary"}
#: an opening tag ends an open element of these names, up to the scope
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
        "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
        "tbody": ({"tbody", "thead", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"})}
DROP_TAGS = frozenset("head nav header footer aside form button select option menu dialog input object canvas video audio map search".split()) | RAW
DROP_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar toolbar dialog alert alertdialog".split())
#: words that mark boilerplate wherever they stand in a class or id, or as a beginning of a word
DROP_WORDS = frozenset("ad ads adv advert adverts footer menus nav sidebar notices consent gdpr popup modal newsletter pagination pager toolbar widget "
                       "widgets disqus masthead sponsor sponsored signup copyright".split())
DROP_STARTS = ("advert", "sidebar", "cookie", "navbar", "navig", "breadcrumb", "footer", "sponsor", "topbar", "toolbar", "submenu")
#: words that do so as the whole name or its last word, and some as its first
DROP_LAST = frozenset("header menu side aside notice alert banner overlay promo share sharing social related recommended subscribe subscription login "
                      "search form teaser skip hidden".split())
DROP_FIRST = frozenset("menu banner promo share sharing related recommended subscribe login search teaser skip".split())
#: words and beginnings that mark reader comments
TALK = ("comment", "respond", "reply", "replies", "disqus")
BESIDE = frozenset(("no", "has", "with", "without"))  # before such a word: a page that has it, not the thing
NEVER_BY_CLASS = frozenset(("html", "body", "main", "article"))
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*+"|'[^']*+')*+)>""")
ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'=<>`]++)))?""")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(raw)} if raw and not raw.isspace() else {}


def _dropped(tag: str, at: dict[str, str], in_article: bool) -> str:
    """'' (stays), 'surely', or by its name alone: 'named', 'pure' if the name says nothing else, 'talk' for reader comments."""
    if tag == "header" and in_article:
        return ""
    if tag in DROP_TAGS:
        return "surely"
    if not at:
        return ""
    if "hidden" in at or at.get("aria-hidden") == "true" or "display:none" in at.get("style", "").replace(" ", "").lower():
        return "surely"
    if at.get("role", "").lower() in DROP_ROLES:
        return "surely"
    if tag in NEVER_BY_CLASS:
        return ""
    found, said = 0, 0
    for name in f"{at.get('class', '')} {at.get('id', '')}".split():
        words = [w.lower() for w in WORD.findall(name) if not w.isdigit()]
        said += len(words)
        for i, w in enumerate(words):
            if i and words[i - 1] in BESIDE or w == "header" and in_article:
                continue
            if w.startswith(TALK):
                return "talk"
            found += w in DROP_WORDS or w.startswith(DROP_STARTS) or (w in DROP_LAST and i == len(words) - 1) or (w in DROP_FIRST and i == 0)
    return "" if not found else "pure" if found == said else "named"


def _step(tag: str, at: dict[str, str]) -> str:
    classes = sorted({re.sub(r"\d+", "#", c) for c in at.get("class", "").split()})
    return ".".join([tag, *classes])


def _credit(text: str, linked: int) -> float:
    return max(0.0, len(text) - 2.0 * linked) * (1.0 if len(text) >= LONG else 0.5)


class Page:
    """Blocks of a page outside boilerplate: (text, characters in links, container,
    whether it is a heading) and containers: (path, parent), both in page order."""

    def __init__(self, html: str | None):
        self.blocks: list[tuple[str, int, int, bool]] = []
        self._named: list[list] = []  # elements dropped by name: a wrapper's name, holds main, holds h1, articles and mains in it
        self._articles = 0  # articles and mains of the page
        self._under: list[tuple[int, ...]] = []  # of each block
        self._names: tuple[int, ...] = ()
        self.containers: list[tuple[str, int]] = [("", -1)]
        self._text: list[str] = []
        self._linked = 0
        self._owner = 0
        self._heading = False
        if html:
            self._parse(html)
            self._judge()

    def _flush(self) -> None:
        if self._text:
            text = " ".join("".join(self._text).split())
            if text:
                self.blocks.append((text, min(self._linked, len(text)), self._owner, self._heading))
                self._under.append(self._names)
            self._text, self._linked = [], 0

    def _judge(self) -> None:
        """Drop the blocks of elements with a boilerplate name, but for those that hold the article."""
        if not self._named:
            return
        credits = [_credit(b[0], b[1]) for b in self.blocks]
        inside, long = [0.0] * len(self._named), [False] * len(self._named)
        for b, c, under in zip(self.blocks, credits, self._under, strict=True):
            for k in under:
                inside[k] += c
                long[k] = long[k] or (len(b[0]) >= LONG and 2 * b[1] <= len(b[0]) and not b[3])
        whole = sum(credits)
        gone = {k for k, (wrapper, main, h1, articles) in enumerate(self._named)
                if not (main or (h1 and long[k]) or (wrapper and 2 * inside[k] > whole and articles == self._articles))}
        self.blocks = [b for b, under in zip(self.blocks, self._under, strict=True) if gone.isdisjoint(under)]

    def _parse(self, html: str) -> None:
        stack: list[tuple[str, str, int, bool, tuple[int, ...]]] = []  # name, path, container, dropped, named elements around
        links = 0
        pos, end = 0, len(html)

        def pop_to(i: int) -> None:
            nonlocal links
            for x in stack[i:]:
                links -= x[0] == "a"
                if x[0] in BLOCK:
                    self._flush()
            del stack[i:]

        while pos < end:
            lt = html.find("<", pos)
            stop = end if lt < 0 else lt
            if stop > pos:
                self._said(html[pos:stop], stack, links)
            if lt < 0:
                break
            if html.startswith("<!--", lt):
                close = html.find("-->", lt + 2 if html.startswith("<!-->", lt) else lt + 4)
                pos = end if close < 0 else close + 3
                continue
            if html.startswith(("<!", "<?"), lt):
                close = html.find(">", lt)
                pos = end if close < 0 else close + 1
                continue
            m = TAG.match(html, lt)
            if not m:
                if lt + 1 < end and (html[lt + 1].isalpha() or html[lt + 1] == "/"):  # a cut-off tag or an open quote
                    close = html.find(">", lt)
                    pos = end if close < 0 else close + 1
                else:
                    self._said("<", stack, links)
                    pos = lt + 1
                continue
            pos = m.end()
            tag = m[2].lower()
            if m[1]:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        pop_to(i)
                        break
                    if tag not in BLOCK and stack[i][0] in BLOCK:
                        break
                continue
            if tag == "br":
                self._said(" ", stack, links)
                continue
            if tag in ENDS_P:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == "p":
                        pop_to(i)
                        break
                    if stack[i][0] in BLOCK:
                        break
            if tag in ENDS:
                closes, scope = ENDS[tag]
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in scope:
                        break
                    if stack[i][0] in closes:
                        pop_to(i)
                        if tag not in ("tr", "tbody", "tfoot"):
                            break
            if tag in BLOCK:
                self._flush()
            if tag in RAW:
                close = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(html, pos)
                after = html.find(">", close.end()) if close else -1
                if tag == "xmp" and close:  # shown as it stands
                    self._said(entities.escape(html[pos:close.start()]), stack, links)
                    self._flush()
                pos = after + 1 if after >= 0 else end
                continue
            if tag in VOID or m[3].endswith("/") and tag not in BLOCK and tag != "a":
                continue
            at = _attributes(m[3])
            _, path, owner, dropped, names = stack[-1] if stack else ("", "", 0, False, ())
            if not dropped:
                why = _dropped(tag, at, any(x[0] in ("article", "main") for x in stack))
                dropped = why == "surely"
                if why and not dropped:
                    names = (*names, len(self._named))
                    self._named.append([why == "named", False, False, 0])
                self._articles += tag in ("article", "main")
                for k in names if tag in ("main", "h1", "article") else ():
                    self._named[k][1] |= tag == "main"
                    self._named[k][2] |= tag == "h1"
                    self._named[k][3] += tag != "h1"
            path = ">".join([*path.split(">")[-WORDS_OF_PATH + 1:], _step(tag, at)]) if path else _step(tag, at)
            if tag in CONTAINERS and not dropped:
                self.containers.append((path, owner))
                owner = len(self.containers) - 1
            links += tag == "a"
            stack.append((tag, path, owner, dropped, names))
        self._flush()

    def _said(self, raw: str, stack: list, links: int) -> None:
        if stack and stack[-1][3]:
            return
        text = entities.unescape(raw) if "&" in raw else raw
        if not self._text:
            if text.isspace():
                return
            self._owner, self._names = (stack[-1][2], stack[-1][4]) if stack else (0, ())
            self._heading = any(x[0] in HEADINGS for x in stack[-4:])
        self._text.append(text)
        if links:
            self._linked += len(text)

    def best(self) -> int:
        """The container with most credit; of equals the first."""
        credit = [0.0] * len(self.containers)
        for text, linked, owner, _ in self.blocks:
            c = _credit(text, linked)
            credit[owner] += c
            parent = self.containers[owner][1]
            if parent >= 0:
                credit[parent] += c / 2
        return max(range(len(credit)), key=lambda i: (credit[i], -i))

    def widened(self, wanted: set[int]) -> set[int]:
        """The wanted containers, each widened as far as the article goes."""
        # per container, of the blocks inside it: blocks, those made of links, characters, those of headings and long blocks
        held = [[0, 0, 0, 0] for _ in self.containers]
        for text, linked, owner, heading in self.blocks:
            n = len(text)
            for k, v in enumerate((1, 2 * linked > n, n, n * (heading or n >= LONG))):
                held[owner][k] += v
        for i in range(len(held) - 1, 0, -1):
            parent = self.containers[i][1]
            for k in range(4):
                held[parent][k] += held[i][k]
        tag = [path.rpartition(">")[2].partition(".")[0] for path, _ in self.containers]
        out = set()
        for i in wanted:
            a = i
            while a >= 0 and tag[a] not in ("article", "main"):
                a = self.containers[a][1]
            if a >= 0 and held[a][0] > held[i][0]:
                i = a
            up = i
            while tag[up] != "main" and (up := self.containers[up][1]) >= 0:
                blocks, links, chars, full = (x - y for x, y in zip(held[up], held[i], strict=True))
                if not blocks:
                    continue
                if links or (tag[up] in ("body", "") and 2 * full <= chars):
                    break
                i = up
            out.add(i)
        return out

    def inside(self, wanted: set[int]) -> list[tuple[str, int, int, bool]]:
        """Blocks inside the wanted containers, in page order."""
        inside: list[bool] = []
        for i, (_, parent) in enumerate(self.containers):
            inside.append(i in wanted or (parent >= 0 and inside[parent]))
        return [b for b in self.blocks if inside[b[2]]]

    def by_paths(self, paths: list[str]) -> str:
        whole = sum(_credit(b[0], b[1]) for b in self.blocks)
        for p in paths:
            hits = {i for i, (path, _) in enumerate(self.containers) if path == p}
            blocks = self.inside(self.widened(hits)) if hits else []
            if blocks and (2 * sum(_credit(b[0], b[1]) for b in blocks) > whole or not whole):
                return "\n".join(b[0] for b in blocks)
        return "\n".join(b[0] for b in self.inside(self.widened({self.best()})))


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for rb in row_slices(whole, "html"):
            paths = []
            for h in rb.column(1).to_pylist():
                p = Page(h)
                paths.append(p.containers[p.best()][0] if p.blocks else None)
            yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(paths, pa.string())], names=["host", "path"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for rb in row_slices(whole, "html"):
            texts = [Page(h).by_paths(p or []) for h, p in zip(rb.column(2).to_pylist(), rb.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [rb.column(0), rb.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])


def _host(url: str):
    return F.coalesce(F.regexp_extract(F.lower(F.col(url)), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))


def host_votes(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, path, n): votes of each host's pages for a path."""
    return (pages.select(_host(url).alias("host"), F.col(html).alias("html")).mapInArrow(_votes, "host string, path string")
            .groupBy("host", "path").agg(F.count(F.lit(1)).alias("n")))


def consensus_paths(votes: DataFrame) -> DataFrame:
    """(host, paths): each host's paths by falling number of votes."""
    rank = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("n"), "path"))
    return (votes.where("path IS NOT NULL").withColumn("r", rank).where(F.col("r") <= PATHS).groupBy("host")
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "path"))), lambda x: x["path"]).alias("paths")))


def extract(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    votes = staged(host_votes(pages, url, html), "host-votes")
    total = votes.agg(F.sum("n")).first()[0] or 0
    # Fewer than HOT hosts hold more than a HOT-th of all pages each, so their list may be broadcast.
    hot = votes.groupBy("host").agg(F.sum("n").alias("n")).where(F.col("n") * HOT > total).select("host", F.lit(DEALT).alias("dealt"))
    paths = consensus_paths(votes).join(F.broadcast(hot), "host", "left").select(
        "host", "paths", F.explode(F.sequence(F.lit(0), F.coalesce("dealt", F.lit(1)) - 1)).alias("salt"))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"), _host(url).alias("host"))
    rows = rows.join(F.broadcast(hot), "host", "left").withColumn("salt", F.pmod(F.xxhash64("page_id", "url", "html"), F.coalesce("dealt", F.lit(1))).cast("int"))
    return rows.join(paths, ["host", "salt"], "left").select("page_id", "url", "html", "paths").mapInArrow(
        _texts, "page_id long, url string, text string, n_chars long")


def op1_host_consensus(spark, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))
