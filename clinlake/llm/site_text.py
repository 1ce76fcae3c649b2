"""Main text of pages by removal of site templates.

A page is parsed into blocks and the element subtrees that hold them, by hash. Subtrees are counted per host over all
pages in Spark, and those that recur across many pages of their host are deleted, as are elements that are no text by
their meaning (menus, headers, footers, sidebars, notices, adverts, forms, scripts, comments). What stands in `main` or
`article` is the page's own text: it is never counted as template. Pages are parsed twice, once for the hashes and once
for the text, so that no text is stored or shuffled; the hashes of the templates are sent to all tasks.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce
from hashlib import blake2b
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.llm.common import mix, stage

#: A subtree is template if it is on at least this many pages of its host, and on at least this share of them. One that
#: holds other elements is template on ENOUGH_PAGES, however many the host has; a lone heading or paragraph is not.
MIN_PAGES = 3
MIN_SHARE = 0.2
ENOUGH_PAGES = 20
#: Hashes of templates that are sent to the tasks at once (16 MB). Beyond, pages are read host group by host group.
MAX_KEYS = 2_000_000

# Elements of HTML by their role.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noembed", "noframes"}
DROPPED = RAW | {
    "head", "nav", "header", "footer", "aside", "form", "button", "select", "dialog", "menu", "svg", "canvas", "datalist",
}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "rp", "rt",
    "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img",
}
CLOSES_P = {
    "address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form", "h1",
    "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul",
}
CLOSES_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_NAMES_OF_FURNITURE = {
    "ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "cookie", "cookies", "consent", "footer", "header", "masthead", "menu",
    "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "popup", "promo", "sidebar", "social", "sponsor", "sponsored", "subscribe", "toolbar",
}
_PLACES_OF_FURNITURE = {"site", "page", "main", "top", "bottom", "left", "right", "global", "primary", "secondary", "reader", "user", "cookie", "mobile"}
_LISTS_OF_FURNITURE = {"list", "bar", "section", "area", "box", "wrapper", "container"}
#: Whole class names and ids: the names, behind a place, and before a kind of list.
DROPPED_NAMES = (
    _NAMES_OF_FURNITURE
    | {f"{place}-{name}" for place in _PLACES_OF_FURNITURE for name in _NAMES_OF_FURNITURE}
    | {f"{name}-{kind}" for name in _NAMES_OF_FURNITURE for kind in _LISTS_OF_FURNITURE}
)
DROPPED_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar"}
ARTICLES = {"main", "article"}

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>?|<\?[^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>", re.S)
_NAMES = re.compile(r"""(?:^|\s)(class|id|role)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_SPACE = re.compile(r"\s+")
_STRUCTURE = {"html", "body"}
_SCOPES = {"article", "main", "body", "table", "td", "th", "section", "aside", "nav", "footer", "header"}


def _furniture(tag: str, attributes: str) -> tuple[bool, bool]:
    """Whether an element is no text by its tag or role, and whether by its class names or id alone."""
    if tag in DROPPED:
        return True, False
    if not attributes or tag in _STRUCTURE or tag in ARTICLES:
        return False, False
    named = False
    for m in _NAMES.finditer(attributes):
        name, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if name == "role" and value in DROPPED_ROLES:
            return True, False
        named = named or name != "role" and not DROPPED_NAMES.isdisjoint(value.replace("_", "-").split())
    return False, named


class _Node:
    """An element: whether it is dropped by its tag or by its name, whether it stands in an article, its first block, what it holds."""

    __slots__ = ("tag", "parent", "dropped", "named", "article", "first", "hash", "inner", "chars", "articles")

    def __init__(self, tag: str, parent: _Node | None, dropped: bool, named: bool, first: int):
        self.tag, self.parent, self.first, self.named = tag, parent, first, named
        self.dropped = dropped or parent is not None and parent.dropped
        self.article = tag in ARTICLES or parent is not None and parent.article
        self.hash = blake2b(tag.encode("utf-8", "surrogatepass"), digest_size=8)
        self.inner, self.chars, self.articles = False, 0, int(tag in ARTICLES and not self.dropped)


class Page:
    """The blocks of a page and the subtrees that hold them.

    Unclosed elements end where their parent ends; a paragraph ends at the next block. An element that is furniture by its
    name alone is kept where it holds every article of the page or, on a page without one, most of its text. The scan is linear: a `<`
    behind the last `>` opens nothing, and an end tag without an open element is passed over.
    """

    def __init__(self, html: str):
        self.texts: list[tuple[str, _Node]] = []
        #: First block, end, hash, and whether other elements stand in it.
        self.trees: list[tuple[int, int, int, bool]] = []
        self._stack, self._text, self._open = [_Node("", None, False, False, 0)], [], Counter()
        self._parse(html)
        self.kept = self._kept()

    def _flush(self) -> None:
        said = _SPACE.sub(" ", unescape("".join(self._text))).strip()
        self._text.clear()
        if said:
            node = self._stack[-1]
            node.hash.update(said.encode("utf-8", "surrogatepass"))
            node.chars += 0 if node.dropped else len(said)
            self.texts.append((said, node))

    def _push(self, tag: str, dropped: bool, named: bool) -> None:
        self._stack.append(_Node(tag, self._stack[-1], dropped, named, len(self.texts)))
        self._open[tag] += 1

    def _close(self) -> None:
        node = self._stack.pop()
        self._open[node.tag] -= 1
        digest, parent = node.hash.digest(), node.parent
        parent.hash.update(digest)
        parent.inner = parent.inner or node.tag not in INLINE
        parent.chars += node.chars
        parent.articles += node.articles
        if node.tag not in _STRUCTURE and node.first < len(self.texts):
            self.trees.append((node.first, len(self.texts), int.from_bytes(digest, "big", signed=True), node.inner))

    def _close_to(self, tags: set[str], stop: set[str]) -> None:
        """Close the innermost element of these tags and all in it, unless an element of stop is open in between."""
        if not any(self._open[t] for t in tags):
            return
        for i in range(len(self._stack) - 1, 0, -1):
            if self._stack[i].tag in tags:
                while len(self._stack) > i:
                    self._close()
                return
            if self._stack[i].tag in stop:
                return

    def _parse(self, html: str) -> None:
        at, last = 0, html.rfind(">")
        while (m := _TAG.search(html, at, last + 1)) is not None:
            self._text.append(html[at : m.start()])
            at, tag = m.end(), (m[2] or "").lower()
            if not tag:
                if m[0].startswith("<!--") and not m[0].endswith("-->"):
                    at = len(html)
                continue
            dropped, named = (False, False) if m[1] else _furniture(tag, m[3])
            # Inline elements leave no trace, unless they are dropped or stand in a dropped inline element.
            if tag in INLINE:
                if m[1] and self._stack[-1].tag in INLINE:
                    self._flush()
                    self._close_to({tag}, set())
                elif not m[1] and tag not in VOID and (dropped or named or self._stack[-1].tag in INLINE):
                    self._flush()
                    self._push(tag, dropped, named)
                continue
            self._flush()
            if m[1]:
                self._close_to({tag}, _SCOPES - {tag})
                continue
            if tag in CLOSES_P:
                self._close_to({"p"}, _SCOPES | {"div", "li", "blockquote", "button"})
            if tag in CLOSES_SAME:
                self._close_to(CLOSES_SAME[tag], {"ul", "ol", "dl", "table", "select"})
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(html, at)
                at = end.end() if end else len(html)
            elif tag not in VOID:
                self._push(tag, dropped, named)
        self._text.append(html[at:])
        self._flush()
        while len(self._stack) > 1:
            self._close()

    def _kept(self) -> list[bool]:
        """Whether each block stands in no dropped element."""
        root, verdict = self._stack[0], {}

        def gone(node: _Node) -> bool:
            chain = []
            while node is not None and id(node) not in verdict:
                chain.append(node)
                node = node.parent
            lost = verdict[id(node)] if node is not None else False
            for n in reversed(chain):
                holds = n.articles == root.articles if root.articles else 2 * n.chars > root.chars
                lost = lost or n.dropped or n.named and not holds
                verdict[id(n)] = lost
            return lost

        return [not gone(node) for _, node in self.texts]

    def countable(self) -> dict[int, bool]:
        """Hashes of the subtrees with text of their own, outside articles, and whether they hold other elements."""
        own = np.cumsum([0, *(k and not node.article for k, (_, node) in zip(self.kept, self.texts))])
        return {h: inner for first, end, h, inner in self.trees if own[end] > own[first]}

    def text(self, templates: Callable[[np.ndarray], np.ndarray]) -> str:
        """The kept blocks that stand in no template; articles are never template."""
        cut = np.zeros(len(self.texts) + 1, np.int64)
        if self.trees:
            found = templates(np.array([h for _, _, h, _ in self.trees], np.int64))
            for (first, end, _, _), hit in zip(self.trees, found):
                if hit:
                    cut[first] += 1
                    cut[end] -= 1
        inside = np.cumsum(cut)
        return " ".join(t for (t, node), k, n in zip(self.texts, self.kept, inside) if k and (node.article or not n))


def blocks(html: str) -> list[tuple[str | None, bool]]:
    """The blocks of a page: text (null in dropped elements) and whether it is an article's."""
    page = Page(html)
    return [(t if k else None, node.article) for (t, node), k in zip(page.texts, page.kept)]


def host(url: str = "url") -> str:
    return f"translate(coalesce(regexp_extract({url}, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _rows(pages: DataFrame) -> DataFrame:
    return pages.select(
        F.coalesce(F.col("page_id").cast("long"), F.lit(0)).alias("page_id"),
        F.col("page_id").isNotNull().alias("known"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    ).withColumn("host", F.expr(host()))


def _keys(site: str, trees: np.ndarray) -> np.ndarray:
    """Hashes of subtrees of a host."""
    own = np.frombuffer(blake2b(site.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "<u8")[0]
    return mix(trees.astype(np.uint64) ^ own).astype(np.int64)


def templates(rows: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """host, key: subtrees that recur across many pages of their host. Pages without a host are no site and count nothing."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for site, page, html in zip(batch["host"], batch["page"], batch["html"]):
                found = Page(html).countable()
                keys = _keys(site, np.fromiter(found, np.int64, len(found)))
                out.append(pd.DataFrame({"host": site, "page": page, "key": keys, "inner": list(found.values())}))
            if out:
                yield pd.concat(out).astype({"inner": bool})

    sites = rows.where("host <> ''")
    # A url counts a subtree once, however often it was fetched; counts are combined before each shuffle, so a hot host is no hot task.
    named = sites.select("host", F.xxhash64("url").alias("page"), F.coalesce("html", F.lit("")).alias("html"))
    each = named.mapInPandas(run, "host string, page long, key long, inner boolean").distinct()
    counts = each.groupBy("host", "key", "inner").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    totals = sites.select("host", F.xxhash64("url").alias("page")).distinct().groupBy("host").agg(F.count("*").alias("pages"))
    share = min_share * F.col("pages")
    enough = F.when(F.col("inner"), F.least(F.lit(ENOUGH_PAGES), share)).otherwise(share)
    return stage(counts.join(totals, "host").where(F.col("n") >= enough).select("host", "key"), "templates")


def main_text(
    pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, use_templates: bool = True, max_keys: int = MAX_KEYS
) -> DataFrame:
    """page_id, url, host, text, n_chars: one row per page (page_id, url, html).

    The text is all blocks but those in dropped elements and in template subtrees; what a page marks as main or article is no
    template. Blocks are joined by one space in page order.
    Null and empty pages, and pages without text, give an empty text; very long and malformed ones are scanned once. Pages
    without a host have no templates. Repeated rows give repeated rows
    (and count as one page of their host); null ids stay null. An empty table gives no rows; further columns are left out.
    """
    rows, spark = _rows(pages), pages.sparkSession
    found = templates(rows, min_pages, min_share) if use_templates else None
    groups = max(1, -(-found.count() // max_keys)) if use_templates else 1
    group = F.pmod(F.xxhash64("host"), F.lit(groups))
    schema = "page_id long, known boolean, url string, host string, text string"

    def cut(part: DataFrame, keys: np.ndarray) -> DataFrame:
        held = spark.sparkContext.broadcast(np.sort(keys))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            known = held.value
            for batch in batches:
                texts = []
                for site, html in zip(batch["host"], batch["html"]):

                    def hit(trees: np.ndarray, site: str = site) -> np.ndarray:
                        own = _keys(site, trees)
                        at = np.minimum(np.searchsorted(known, own), max(len(known) - 1, 0))
                        return known[at] == own if len(known) and site else np.zeros(len(own), bool)

                    texts.append(Page(html if isinstance(html, str) else "").text(hit))
                yield batch.drop(columns="html").assign(text=texts)

        return part.mapInPandas(run, schema)

    parts = []
    for n in range(groups):
        # All templates of a host are in one group; a group has about max_keys of them.
        keys = found.where(group == n).select("key").toArrow()["key"].to_numpy() if use_templates else np.zeros(0, np.int64)
        parts.append(cut(rows.where(group == n) if groups > 1 else rows, keys))
    out = reduce(DataFrame.unionByName, parts)
    return out.select(F.when(F.col("known"), F.col("page_id")).alias("page_id"), "url", "host", "text", F.length("text").cast("long").alias("n_chars"))
