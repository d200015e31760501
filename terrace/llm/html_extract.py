"""Main text of web pages by consensus host paths.

A first pass scores the containers of every page: a block of running text
counts for the container that directly holds it, by its length less that of
its links, and for all containers around, less where one holds other containers
beside its own: an article of an introduction and sections, of a lead and a
body, or of prose and tables scores higher than any part.  Containers are named
by their generalised path: tags from the root, each with its class or id words,
numbers made equal.  Spark adds up the scores of a path over the pages of a
host, and the highest sum wins the host.  The second pass takes the text of
every element of a page at the winning path; a page that has none there falls
back on its own best container.

Inside the chosen elements menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles and reader comments are left out, by tag, role
and words of class and id, unless such an element turns out to hold most of
the page's running text and so to be a wrapper of the article.  Blocks end
at block-level tags and line breaks; character references are decoded, white
space inside a block becomes one space, blocks are joined by one newline.

Null and empty pages, and pages without text, give the empty text.  Pages whose
url is null or has no host vote as one host "".  Broken markup is read as it
comes: unknown, unclosed and stray end tags do no harm.  Repeated rows are
extracted alike, each vote counts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.common import bytes_of, narrow_batches, stage

BROADCAST_BYTES = 8 << 20

# HTML tag names by their role.
_BLOCKS = frozenset("""address article blockquote body caption center dd details div dl dt fieldset figcaption figure
    h1 h2 h3 h4 h5 h6 hgroup hr html li main ol p pre search section summary table tbody td tfoot th thead tr ul""".split())
_CONTAINERS = frozenset("article body center details div fieldset html main section table tbody td".split())
_DROPPED = frozenset("""aside audio button canvas dialog datalist embed footer form frame frameset header head iframe
    input label map menu nav noframes noscript object option select svg template textarea title video""".split())
_RAW = frozenset("script style noscript textarea title template iframe noframes xmp svg".split())
_VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
_ENDS_P = _BLOCKS | {"aside", "footer", "form", "header", "menu", "nav"}
# Class and id words of elements that are no part of an article.
_NOISE = frozenset("""ad ads adbox adsense advert advertisement advertisements advertising adverts alert banner breadcrumb
    breadcrumbs byline cookie cookies comment commentlist comments consent disqus disclaimer footer gdpr header legal login
    masthead menu menus modal nav navbar navigation newsletter notice notices notification pager pagination paywall popup
    promo promoted promotion recommended related replies respond responses search share sharing sidebar signup skip social
    sponsor sponsored subscribe tags toolbar topbar widget widgets""".split())
_SMALL_NOISE = frozenset("ad ads advert advertisement comment comments promo promoted related reply sponsored".split())
_QUALIFIERS = frozenset("has no with without".split())
# Words of boxes that can hold more running text than a short article; parts of the page's layout, which as a part
# of a longer word often name a wrapper of the article and its neighbours; tags that can be such a wrapper.
_RIVALS = frozenset("comment commentlist comments disqus recommended related replies reply respond responses".split())
_LAYOUT = frozenset("banner header masthead menu menus nav navbar navigation search sidebar toolbar topbar widget widgets".split())
_WRAPPERS = frozenset("form header label object".split())
# Grades of left-out elements, and the share of the running text from which one is taken for the article's wrapper.
_WRAP, _BOX, _RIVAL = 1, 2, 3
_SHARES = {_WRAP: 0.5, _BOX: 0.9, _RIVAL: 1.0}
_RUNNING, _LEAST = 25, 200  # characters of a block of running text; of all in a box or rival that is kept
_TITLES = frozenset("h1 h2 h3 h4 h5 h6 hgroup p li dt dd caption figcaption summary blockquote".split())
# What a container passes on to the one around: all inside an article and to one that has text of its own beside it,
# such as a title; else, to one that holds more than it, parts of an article nearly all, others less, so that
# containers beside each other are kept from a tenth, which boilerplate that nothing marks seldom reaches; an
# article is the whole as a rule.
_PASSED = {"section": 0.98, "details": 0.98, "fieldset": 0.98, "table": 0.98, "tbody": 0.98, "td": 0.98,
           "div": 0.9, "article": 0.5, "main": 0.5}
_ALONE = 0.999  # to one that holds nothing else
_TAG_OF = re.compile(r"[^.#]*")
_ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
_END = {tag: re.compile(rf"</{tag}\b[^>]*>", re.I) for tag in ("script", "style")}
_EMPTY = re.compile(r"(?:^|[\s\"'])/$")   # not the slash that ends an unquoted value
_NAMES = re.compile(r"\b(class|id|role)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?", re.I)
_WORDS = re.compile(r"[^\W_]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_NUMBER = re.compile(r"\d+")


def _grade(word: str, listed: frozenset, whole: bool) -> int:
    """How surely a class or id word names something that is no part of an article; 0: it does not.

    A word names a role alone or as the part that others qualify: "ad", "site-footer", "comments-list";
    "with-sidebar" and the like speak of the element's neighbours.  ``whole``: only alone.
    """
    parts = [x.lower() for x in _WORDS.findall(_CAMEL.sub(" ", word))]
    if not parts or parts[0] in _QUALIFIERS or whole and len(parts) > 1:
        return 0
    noise = listed.intersection(parts)
    if not noise:
        return 0
    return _RIVAL if noise & _RIVALS else _WRAP if len(parts) > 1 and noise <= _LAYOUT else _BOX


def _describe(tag: str, attributes: str) -> tuple[str, int]:
    """(generalised name of an element, its grade as no part of an article)."""
    grade = (_WRAP if tag in _WRAPPERS else _RIVAL) if tag in _DROPPED else 0
    if not attributes or "=" not in attributes:
        return tag, grade
    name = [tag]
    listed = _SMALL_NOISE if tag == "article" else _NOISE
    ids: list[str] = []
    section = tag == "section"
    for found in _NAMES.finditer(attributes):
        kind = found[1].lower()
        value = unescape(found[2] or found[3] or found[4] or "")
        if kind == "role":
            grade = max(grade, _BOX if value.strip().lower() in _ROLES else 0)
            continue
        words = value.split()
        name += sorted(("." if kind == "class" else "#") + _NUMBER.sub("0", w).replace(">", "_") for w in words)
        if kind == "class":
            section = section or "section" in words
            grade = max([grade, *(_grade(w, listed, False) for w in words)])
        else:
            ids += words
    # ids of headings, paragraphs and sections are made of their titles: anchors
    if tag not in _TITLES:
        grade = max([grade, *(_grade(w, listed, section) for w in ids)])
    if tag in ("html", "body", "main"):
        grade = 0
    return "".join(name), grade


def _ends(html: str, tag: str) -> dict[int, int]:
    """Where the content of each element of a tag begins -> behind its end tag; unclosed ones are not in it."""
    tags = re.compile(rf"<!--.*?(?:-->|\Z)|<(/?){tag}(?=[\s/>])((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S | re.I)
    begun: list[int] = []
    out: dict[int, int] = {}
    for found in tags.finditer(html):
        if found[1]:
            if begun:
                out[begun.pop()] = found.end()
        elif found[1] is not None and not _EMPTY.search(found[2]):
            begun.append(found.end())
    return out


class Blocks:
    """The text blocks of a page with the containers that hold them.

    ``rows``: (path, parent path, element number, text, characters inside links).
    """

    def __init__(self, html: str | None):
        self.rows: list[tuple[str, str, tuple[int, ...], str, int]] = []
        self.paths: dict[int, str] = {0: ""}
        self._read(html or "")

    def _read(self, html: str) -> None:
        # open elements: (tag, element number, path, its number as a left-out one or 0, the text before an inline
        # one); containers get numbers of their own
        open_: list[tuple[str, int, str, int, tuple | None]] = [("", 0, "", 0, None)]
        grades = [0]                    # by the number of a left-out element
        text: list[str] = []
        inline: dict[str, int] = {}     # open inline elements by tag: the left-out ones and those of their tag inside
        ends: dict[str, dict[int, int]] = {}
        linked, link, count, at, out, begin = 0, 0, 0, 0, 0, 0
        rows: list[list] = []           # [place, path, inside, text, linked, open left-out elements, in an inline one]

        def flush() -> None:
            nonlocal linked
            if text:
                block = " ".join(unescape("".join(text)).split())
                if block:
                    inside = tuple(dict.fromkeys(e[1] for e in open_))
                    rows.append([begin, open_[-1][2], inside, block, linked, [e[3] for e in open_ if e[3]] if out else [],
                                 open_[-1][4] is not None])
                text.clear()
            linked = 0

        def close(upto: int, own: bool = False) -> None:
            """Close the elements from ``upto`` on; ``own``: by the end tag of the first of them."""
            nonlocal out, linked, begin
            while len(open_) > upto:
                flush()
                top = open_.pop()
                out -= top[3] > 0
                if top[4] is None:
                    continue
                inline[top[0]] -= 1
                if not inline[top[0]]:
                    del inline[top[0]]
                if top[3]:
                    mine = [r for r in rows[top[4][3]:] if top[3] in r[5]]
                    # without an end tag it ends where its first block begins
                    if not (own and len(open_) == upto):
                        for r in mine[1:] if mine and mine[0][6] else mine:
                            r[5].remove(top[3])
                    text[:], linked, begin = list(top[4][0]), top[4][1], top[4][2]

        def block_at() -> int:
            """The innermost open element that is not an inline one."""
            k = len(open_) - 1
            while open_[k][4] is not None:
                k -= 1
            return k

        size = len(html)
        while at < size:
            found = _TAG.search(html, at)
            piece = html[at:found.start()] if found else html[at:]
            if piece:
                if not text:
                    begin = at
                text.append(piece)
                if link:
                    linked += len(piece)
            if not found:
                break
            at = found.end()
            tag = (found[2] or "").lower()
            if not tag:
                continue
            if found[1]:
                if tag == "a":
                    link = 0
                if tag in _ENDS_P or tag in _DROPPED or tag in inline:
                    for k in range(len(open_) - 1, 0, -1):
                        if open_[k][0] == tag:
                            close(k, own=True)
                            break
                    else:
                        flush()
                continue
            if tag == "a":
                link = 1
                if "a" in inline and open_[block_at() + 1:]:    # links do not nest
                    for k in range(len(open_) - 1, block_at(), -1):
                        if open_[k][0] == "a":
                            close(k, own=True)
                            break
            elif tag == "br":
                flush()
            if tag in ("script", "style"):
                end = _END[tag].search(html, at)
                at = end.end() if end else size
                continue
            if tag in _RAW:
                flush()
                if not _EMPTY.search(found[3]):
                    if tag not in ends:
                        ends[tag] = _ends(html, tag)
                    at = ends[tag].get(at, at)  # without an end tag: on behind the start tag
                continue
            if tag in _VOID or found[3].endswith("/") and tag not in _BLOCKS:
                if tag == "hr":
                    flush()
                continue
            name, grade = _describe(tag, found[3])
            left = 0
            if grade:
                left = len(grades)
                grades.append(grade)
                out += 1
            if tag in _ENDS_P or tag in _DROPPED:
                flush()
                if open_[-1][0] == "head" and tag in _BLOCKS:   # its end tag may be left out
                    close(len(open_) - 1)
                if open_[block_at()][0] == "p" and tag in _ENDS_P:
                    close(block_at())
                same = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "td": ("td", "th"), "th": ("td", "th"),
                        "tr": ("tr", "td", "th")}.get(tag)
                while same and open_[block_at()][0] in same:
                    close(block_at())
                top = open_[-1]
                if tag in _CONTAINERS:
                    count += 1
                    path = f"{top[2]}>{name}"
                    self.paths[count] = path
                    open_.append((tag, count, path, left, None))
                else:
                    open_.append((tag, top[1], top[2], left, None))
            elif grade or tag in inline:
                # inline elements neither end a block nor hold others; left-out ones are kept to their end tag
                top = open_[-1]
                open_.append((tag, top[1], top[2], left, (tuple(text), linked, begin, len(rows))))
                inline[tag] = inline.get(tag, 0) + 1
                if grade:
                    text.clear()
                    linked = 0
        close(1)
        flush()
        wrappers = self._wrappers(rows, grades) if len(grades) > 1 else set()
        self.rows = [(r[1], "", r[2], r[3], r[4]) for r in sorted(rows, key=lambda r: r[0])
                     if not r[5] or wrappers.issuperset(r[5])]

    @staticmethod
    def _wrappers(rows: list[list], grades: list[int]) -> set[int]:
        """The left-out elements that hold the article: most of the running text, next to which that of more
        surely left-out ones does not count."""
        held = {g: [0] * len(grades) for g in _SHARES}
        for _, _, _, block, linked, left, _ in rows:
            worth = len(block) - 2 * linked
            if worth >= _RUNNING:
                for g in range(max((grades[m] for m in left), default=_WRAP), _RIVAL + 1):
                    held[g][0] += worth     # of the page
                    for m in left:
                        held[g][m] += worth
        return {m for m, g in enumerate(grades) if m and held[g][m] >= (1 if g == _WRAP else _LEAST)
                and (held[g][m] > _SHARES[g] * held[g][0] or held[g][m] == held[g][0])}


    def votes(self) -> dict[str, float]:
        """Score by path of the page's containers: what they hold directly and what the containers in them pass on."""
        score: dict[str, float] = {}
        for path, _, _, text, linked in self.rows:
            worth = max(0, len(text) - 2 * linked)
            if worth:
                score[path] = score.get(path, 0.0) + worth
        parts: dict[str, list[str]] = {}
        for path in list(score):
            while path:
                around = path.rpartition(">")[0]
                known = parts.setdefault(around, [])
                if path in known:
                    break
                known.append(path)
                path = around
        for around in sorted(parts, key=lambda p: -p.count(">") if p else 1):
            inside = parts[around]
            tags = [_TAG_OF.match(name)[0] for name in around.split(">")]
            own = around in score
            for path in inside:
                if "article" in tags or own and tags[-1] not in ("", "html", "body"):
                    passed = 1.0
                elif len(inside) == 1 and not own:
                    passed = _ALONE
                else:
                    passed = _PASSED.get(_TAG_OF.match(path.rpartition(">")[2])[0], _PASSED["div"])
                score[around] = score.get(around, 0.0) + score[path] * passed
        return score

    def at(self, path: str) -> list[str]:
        """Blocks inside any element at ``path``, in page order."""
        chosen = {n for n, p in self.paths.items() if p == path}
        return [text for _, _, inside, text, _ in self.rows if not chosen.isdisjoint(inside)]

    def main(self, path: str | None) -> str:
        found = self.at(path) if path is not None else []
        if not found:
            votes = self.votes()
            if votes:
                found = self.at(max(sorted(votes), key=votes.get))
            else:
                found = [text for _, _, _, text, _ in self.rows]
        return "\n".join(found)


def host_of(url: Column) -> Column:
    """After the first "://" up to "/", "?", "#" or the end, with A-Z lower-cased; empty without one."""
    host = F.regexp_extract(url, r"^[\s\S]*?://([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(host, upper, lower), F.lit(""))


def winning_paths(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, path): the path with the most text over the host's pages; ties go to the smaller path."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths, scores = [], [], []
            for host, page in zip(batch.column(0), batch.column(1)):
                for path, score in Blocks(page.as_py()).votes().items():
                    hosts.append(host.as_py())
                    paths.append(path)
                    scores.append(round(1000 * score))
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string()),
                                              pa.array(scores, pa.int64())], names=["host", "path", "score"])

    narrow_batches(pages.sparkSession)
    votes = pages.select(host_of(F.col(url)).alias("host"), F.col(html).alias("html")).mapInArrow(
        run, "host string, path string, score long")
    sums = votes.groupBy("host", "path").agg(F.sum("score").alias("score"))
    return sums.groupBy("host").agg(F.min_by("path", F.struct(-F.col("score"), "path")).alias("path"))


def extract(pages: DataFrame, url: str = "url", html: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text of each; a column of that name is replaced."""
    winners = stage(winning_paths(pages, url, html), "html-paths")
    # one row a host: broadcast only if it is measured to be small, else hosts and pages are joined
    # on the host, where a host with many pages is split over tasks
    small = bytes_of(winners, "host", "path") <= BROADCAST_BYTES
    right = winners.select(F.col("host").alias("__llm_host"), F.col("path").alias("__llm_path"))
    joined = pages.join(F.broadcast(right) if small else right, host_of(F.col(url)) == right["__llm_host"], "left").drop(
        "__llm_host")
    kept = [c for c in pages.columns if c.lower() != out.lower()]
    joined = joined.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{html}`").alias("__llm_html"), "__llm_path")
    page_at, path_at = len(kept), len(kept) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [Blocks(page.as_py()).main(path.as_py())
                     for page, path in zip(batch.column(page_at), batch.column(path_at))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:page_at], pa.array(texts, pa.string())],
                                             names=[*kept, out])

    narrow_batches(pages.sparkSession)
    schema = T.StructType([*joined.schema.fields[:page_at], T.StructField(out, T.StringType())])
    return joined.mapInArrow(run, schema)
