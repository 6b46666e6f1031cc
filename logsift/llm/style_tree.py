"""Main text of web pages by a site style tree.

The DOMs of all pages of a host are merged: elements with the same path of
tags and classes are one style node.  A node's presentation importance is the
entropy of its children's layouts over the host's pages; its content
importance falls as the same texts recur on more pages.  Branches of low
composite importance are removed from each page.  What HTML itself marks as
not being the article (menus, footers, forms, adverts by class and so on) has
no importance on any host.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsift.llm.common import checkpoint, small_batches
from logsift.llm.words import cut_rows

#: Hosts whose removed branches may be broadcast.
BROADCAST_HOSTS = 20_000
#: Paths of removed branches that may be broadcast with them.
BROADCAST_PATHS = 100_000
#: Pages with copies whose numbers may be broadcast.
BROADCAST_COPIES = 100_000
#: Levels of the style tree; deeper elements count as their ancestor there.
LEVELS = 64

# Fixed values of HTML: element classes.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = set("script style textarea title iframe xmp".split())
RAW = RAW_TEXT | set("noscript template svg math object select button canvas audio video".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br img".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
          "body": {"head"}}
SCOPE = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}
NOT_MAIN = set("nav footer aside form head dialog menu".split())
ROLES = set("navigation banner contentinfo complementary search dialog alert menu form".split())
#: Class and id words that mark what is not the article.
HINTS = set("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu menubar breadcrumb breadcrumbs
footer sidebar widget comment comments commentlist disqus replies reply respond cookie cookies consent gdpr notice banner popup modal newsletter subscribe
subscription paywall share sharing social related recommended masthead toolbar pagination pager copyright disclaimer login signup""".split())
#: Class and id words of containers that are never around the article, with
#: words for the containers themselves (``comment-list``, ``related-posts``).
COMMENTS = set("comment comments commentlist disqus replies respond trackbacks pingbacks".split())
RELATED = set("related recommended recommendations teaser teasers".split())
ADS = set("ad ads advert adverts advertisement sponsor sponsored promo promotion".split())
PARTS = set("""area areas block body box boxes card cards container content feed form grid group holder inner item items link links list news panel pane post
posts article articles section sections slot slots story stories thread unit wrap wrapper""".split())
#: Class and id words of a wrapper's state (``no-sidebar``, ``menu-open``): it is around the article.
STATES = set("no non without has have with open opened closed collapsed expanded enabled disabled".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
PROTECTED = set("p h1 h2 h3 h4 h5 h6 li blockquote pre td th dd dt figcaption article main".split())

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_ATTR = re.compile(r"[\s/]*([^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
_NAMES = set("class id role hidden style".split())
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


@dataclass
class Element:
    tag: str
    path: str
    level: int
    off: bool  # by HTML's own marks or a class or id, not the article
    main: bool  # inside article or main
    hard: bool = False  # by HTML's own marks, or in a container that is never around the article
    advert: bool = False  # in a container of adverts
    children: list[str] = field(default_factory=list)


@dataclass
class Page:
    blocks: list[tuple[Element, str]]
    elements: list[Element]

    def has_main(self) -> bool:
        return any(e.main and not e.off for e in self.elements)


def _parts(name: str) -> set[str]:
    return {w.lower() for w in _WORD.findall(name)}


def never_main(tag: str, main: bool, classes: list[str], ids: list[str]) -> set[str]:
    """The kinds of container (comments, related, adverts) that an element's
    classes and ids make it: some word of the kind, and else only words for
    containers.  Inside an article, ids of one topic word (``advertising``)
    and marks of paragraphs and inline elements come from the topic."""
    if tag in ("html", "body") or tag in HEADINGS or tag in INLINE or (main and tag in PROTECTED and tag not in ("li", "article")):
        return set()
    out = set()
    for name in classes + ids:
        parts = _parts(name)
        for kind, words in (("comments", COMMENTS | ({"reply"} if len(parts) > 1 or tag == "article" else set())), ("related", RELATED), ("adverts", ADS)):
            if parts & words and parts <= words | PARTS:
                if kind == "comments" or not main or (name in classes and tag != "li") or len(parts) > 1:
                    out.add(kind)
    return out


def hinted(tag: str, main: bool, classes: list[str], ids: list[str]) -> bool:
    """If classes or ids mark an element as not the article.  Inside an article
    or main only a whole class of a container does; ids and parts of classes
    there come from headings and topics."""
    if tag in ("html", "body", "article", "main") or tag in HEADINGS:
        return False
    if main:
        return tag not in PROTECTED and tag not in INLINE and any(c.lower() in HINTS for c in classes)
    parts = [_parts(c) for c in classes + ids]
    return any(p & HINTS and not p & STATES for p in parts)


def _attributes(html: str, at: int) -> tuple[int, list[tuple[str, str]]]:
    """The end of a start tag whose name ends at ``at``, and the attributes that
    matter.  A tag that the page's end cuts off ends there."""
    out, size = [], len(html)
    while at < size:
        m = _ATTR.match(html, at)
        if m.end() == at:
            if html[at] == ">":
                return at + 1, out
            at += 1  # a stray equals sign
            continue
        at = m.end()
        name = m[1].lower()
        if name in _NAMES:
            out.append((name, m[2] or m[3] or m[4] or ""))
    return size, out


class _Open:
    """The stack of open elements, with the places of each tag and of the
    elements that are not inline, so that closing one needs no search."""

    def __init__(self, root: Element):
        self.stack, self.places, self.blocks = [root], {}, [0]

    def push(self, e: Element) -> None:
        self.places.setdefault(e.tag, []).append(len(self.stack))
        if e.tag not in INLINE:
            self.blocks.append(len(self.stack))
        self.stack.append(e)

    def cut(self, k: int) -> None:
        while len(self.stack) > k:
            e = self.stack.pop()
            self.places[e.tag].pop()
            if self.blocks[-1] == len(self.stack):
                self.blocks.pop()

    def last(self, *tags: str) -> int:
        """The innermost place of any of the tags, 0 if none is open."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)


def parse(html: str | None) -> Page:
    """The elements and text blocks of a page, in time linear in its length.
    A block ends at the start or end of any element that is not inline;
    unclosed and stray tags are repaired as browsers do, roughly."""
    html = html or ""
    root = Element("", "", 0, False, False)
    open_, elements, blocks, words = _Open(root), [root], [], []
    owner = root
    closes: dict[str, int] = {}  # tags that have no end tag from this place on

    def flush() -> None:
        nonlocal words
        text = " ".join(unescape("".join(words)).split())
        if text:
            blocks.append((owner, text))
        words = []

    def put(text: str) -> None:
        nonlocal owner
        if not words:
            owner = open_.stack[open_.blocks[-1]]
        words.append(text)

    at, size = 0, len(html)
    while at < size:
        end = html.find("<", at)
        end = size if end < 0 else end
        if end > at:
            put(html[at:end])
        if end == size:
            break
        m = _TAG.match(html, end)
        if not m:
            if html.startswith("<!--", end):
                at = html.find("-->", end + 4)
                at = size if at < 0 else at + 3
            elif html.startswith(("<!", "<?", "</"), end):
                at = html.find(">", end)
                at = size if at < 0 else at + 1
            else:
                put("<")
                at = end + 1
            continue
        tag = m[2].lower()
        at, attributes = _attributes(html, m.end())
        if m[1]:
            k = open_.last(tag)
            if tag in INLINE:
                if k > open_.blocks[-1]:
                    open_.cut(k)
            else:
                flush()
                if k:
                    open_.cut(k)
            continue
        if tag in RAW:
            if html[at - 2 : at] != "/>" and closes.get(tag, size) > at:
                close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
                if close:
                    at = close.end()
                else:
                    closes[tag] = at
                    at = size if tag in RAW_TEXT else at
            put(" ")
            continue
        if tag in VOID:
            if tag not in INLINE:
                flush()
            elif words:
                words.append(" " if tag == "br" else "")
            continue
        if tag not in INLINE:
            flush()
            open_.cut(open_.blocks[-1] + 1)  # a block ends open inline elements
            if open_.stack[-1].tag == "p":
                open_.cut(len(open_.stack) - 1)
            if tag in CLOSES:
                k = open_.last(*CLOSES[tag])
                if k > open_.last(*SCOPE.get(tag, ())):
                    open_.cut(k)
        top = open_.stack[-1]
        hint, label, off = False, tag, tag in NOT_MAIN or (tag == "header" and not top.main)
        never: set[str] = set()
        if attributes:
            classes: list[str] = []
            ids: list[str] = []
            for name, value in attributes:
                if name in ("class", "id"):
                    (classes if name == "class" else ids).extend(value.split())
                    label += "." + re.sub(r"\d+", "0", " ".join(value.split()))
                elif name == "role":
                    off |= value.lower() in ROLES
                elif name == "hidden":
                    off = True
                elif re.search(r"display\s*:\s*none", value):
                    off = True
            hint = hinted(tag, top.main, classes, ids)
            never = never_main(tag, top.main, classes, ids)
        label = label.replace(">", "")
        if len(label) > 100:  # paths stay short
            label = f"{tag}.{xxhash.xxh3_64_hexdigest(label)}"
        top.children.append(label)
        main = tag in ("article", "main")
        hard = top.hard or off or bool(never - {"adverts"})
        advert = top.advert or "adverts" in never
        # another class or id around an article or main says nothing of what is in it
        here = Element(tag, f"{top.path}>{label}" if top.level < LEVELS else top.path, top.level + 1,
                       hard or advert or (not main and (top.off or hint)), top.main or main, hard, advert)
        elements.append(here)
        open_.push(here)
    flush()
    page = Page(blocks, elements)
    if not page.has_main() and any(e.advert and e.main and not e.hard for e in elements):
        _clear_adverts(page)
    return page


def _clear_adverts(page: Page) -> None:
    """The page's only articles are inside what a class calls an advert: that
    is a wrapper of the page, and they are the article."""
    for e in page.elements:
        if e.advert and e.main and not e.hard:
            e.off = False


def _site(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^\s*(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))


def _shares(pages: DataFrame) -> DataFrame:
    """``host``, ``html`` and ``share`` of each page: one over the number of
    pages of its host with the same html.  Copies say nothing of what recurs,
    so all of them together count as one page."""
    keyed = pages.select(_site(F.col("url")).alias("host"), F.coalesce("html", F.lit("")).alias("html")).withColumn("_copy", F.xxhash64("html"))
    copies = checkpoint(keyed.groupBy("host", "_copy").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1"))
    few = copies.limit(BROADCAST_COPIES + 1).count() <= BROADCAST_COPIES
    return (keyed.join(F.broadcast(copies) if few else copies, ["host", "_copy"], "left")
            .select("host", "html", (1 / F.coalesce("_n", F.lit(1))).alias("share")))


def _features(pages: DataFrame) -> DataFrame:
    """Per host, style node and feature: different pages, occurrences ``c`` on
    them and the sum of ``c ln c``, added up in each task first.  Kind 0 is the layout of a
    node's children on a page (runs of one label count once), kind 1 a text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut_rows(batches, "html"):
            sums: dict[tuple[str, str, int, int], list[float]] = {}
            for host, html, share in zip(*(batch.column(name).to_pylist() for name in ("host", "html", "share"))):
                page = parse(html)
                layouts: dict[str, list[str]] = {}
                for e in page.elements:
                    labels = [c for k, c in enumerate(e.children) if not k or c != e.children[k - 1]]
                    layouts.setdefault(e.path, []).append("|".join(labels))
                own = Counter((e.path, 1, xxhash.xxh3_64_intdigest(t) >> 1) for e, t in page.blocks)
                own.update((p, 0, xxhash.xxh3_64_intdigest("\n".join(dict.fromkeys(s))) >> 1) for p, s in layouts.items())
                for (path, kind, feature), c in own.items():
                    s = sums.setdefault((host, path, kind, feature), [0.0, 0.0, 0.0])
                    s[0] += share
                    s[1] += share * c
                    s[2] += share * c * math.log(c)
            keys, values = list(sums), list(sums.values())
            cols = [pa.array([k[i] for k in keys], t) for i, t in enumerate((pa.string(), pa.string(), pa.int32(), pa.int64()))]
            cols += [pa.array([v[i] for v in values], t) for i, t in enumerate((pa.float64(), pa.float64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays(cols, names=["host", "path", "kind", "feature", "pages", "c", "clogc"])

    rows = _shares(pages).mapInArrow(run, "host string, path string, kind int, feature long, pages double, c double, clogc double")
    whole = lambda name: F.round(F.sum(name)).cast("long").alias(name)  # noqa: E731  (the shares of a page's copies add up to 1)
    return rows.groupBy("host", "path", "kind", "feature").agg(whole("pages"), whole("c"), F.sum("clogc").alias("clogc"))


def importance(pages: DataFrame, gamma: float = 0.9) -> DataFrame:
    """The style tree's nodes: ``host``, ``path``, ``pages`` and the composite
    importance ``imp``: ``(1 - gamma ** l)`` parts of the layout entropy and
    ``gamma ** l`` parts of the mean content importance below the node, where
    ``l`` counts its layouts.  A text on ``m`` of ``m`` pages has none; pages of
    a host with the same html are one."""
    rows = checkpoint(_features(pages))
    layout = rows.filter("kind = 0").groupBy("host", "path").agg(
        F.sum("pages").alias("m"), F.count(F.lit(1)).alias("l"), F.sum(F.col("pages") * F.log("pages")).alias("s"))
    base = F.log(F.greatest(F.col("m"), F.lit(2)).cast("double"))
    layout = layout.select("host", "path", "m", "l", F.when(F.col("m") < 2, 1.0).otherwise((F.log("m") - F.col("s") / F.col("m")) / base).alias("node_imp"))
    entropy = (F.log("c") - F.col("clogc") / F.col("c")) / base  # of one text over the node's pages
    texts = (rows.filter("kind = 1").join(layout.select("host", "path", "m"), ["host", "path"])
             .groupBy("host", "path").agg(F.sum(F.when(F.col("m") < 2, 1.0).otherwise(1 - F.least(entropy, F.lit(1.0)))).alias("w"), F.count(F.lit(1)).alias("k")))
    steps = F.split("path", ">")
    above = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda i: F.array_join(F.slice(steps, F.lit(1), i), ">"))
    below = texts.select("host", "w", "k", F.explode(above).alias("path")).groupBy("host", "path").agg((F.sum("w") / F.sum("k")).alias("content"))
    fade = F.pow(F.lit(gamma), F.col("l"))
    return layout.join(below, ["host", "path"]).select(
        "host", "path", F.col("m").alias("pages"), ((1 - fade) * F.col("node_imp") + fade * F.col("content")).alias("composite"), "content",
        F.least("content", (1 - fade) * F.col("node_imp") + fade * F.col("content")).alias("imp"))


class _Branches:
    """Removed branches of a host, and which paths lie in one."""

    def __init__(self, gone: list[str]):
        self.gone, self.known = set(gone), {}

    def hold(self, path: str) -> bool:
        if not self.gone:
            return False
        if path not in self.known:
            steps = path.split(">")
            self.known[path] = any(">".join(steps[:k]) in self.gone for k in range(1, len(steps) + 1))
        return self.known[path]


def extract(pages: DataFrame, threshold: float = 0.25, min_pages: int = 5, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """Per row: ``page_id``, ``url``, ``text`` (blocks of the main text joined
    by newlines), ``n_chars`` and ``n_removed`` (blocks that the style tree
    alone removed).

    A branch goes if its importance is under ``threshold`` on a host with at
    least ``min_pages`` different pages that have it; paragraphs, headings, lists and
    tables of an ``article`` or ``main`` stay.  If a page has such an element,
    only blocks inside one count.  Containers of comments, related articles and
    adverts go with all that is in them, articles too.  Null or empty html gives empty text; a null
    url is a host of its own name.  Repeated rows each give a row; empty tables
    give no rows; other columns are ignored.
    """
    small_batches(pages.sparkSession)
    src = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    nodes = importance(src.select("url", "html"))
    low = nodes.filter((F.col("imp") < threshold) & (F.col("pages") >= min_pages) & (F.col("path") != ""))
    gone = checkpoint(low.groupBy("host").agg(F.sort_array(F.collect_set("path")).alias("gone")))  # one row per host
    size = gone.agg(F.count(F.lit(1)).alias("hosts"), F.coalesce(F.sum(F.size("gone")), F.lit(0)).alias("paths"),
                    F.coalesce(F.sum(F.length(F.array_join("gone", ""))), F.lit(0)).alias("chars")).first()
    few = size["hosts"] <= BROADCAST_HOSTS and size["paths"] <= BROADCAST_PATHS and size["chars"] <= 100 * BROADCAST_PATHS
    with_low = src.withColumn("host", _site(F.col("url"))).join(F.broadcast(gone) if few else gone, "host", "left").select("page_id", "url", "html", "gone")
    kind = src.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut_rows(batches, "html"):
            texts, removed = [], []
            for html, gone_here in zip(batch.column("html").to_pylist(), batch.column("gone").to_pylist()):
                page = parse(html)
                bad = _Branches(gone_here or ())
                has_main = page.has_main()
                keep, lost = [], 0
                for e, text in page.blocks:
                    if e.off or (has_main and not e.main):
                        continue
                    guarded = e.main and e.tag in PROTECTED
                    if not guarded and bad.hold(e.path):
                        lost += 1
                    else:
                        keep.append(text)
                texts.append("\n".join(keep))
                removed.append(lost)
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array(removed, pa.int64())], names=["page_id", "url", "text", "n_chars", "n_removed"])

    return with_low.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long, n_removed long")
