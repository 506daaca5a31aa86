"""Main text of web pages by consensus of each host's pages.

Each page's containers are scored by the text they hold outside links and boilerplate; the best few vote for their generalised
tag-class path (digits in class names become ``N``). Votes are summed per host in Spark. Every page is then extracted
again from the elements at its host's winning path; a page without text there, or without a host, uses its own best container.

Results for odd rows: NULL and empty pages have an empty text, tagless ones are one block. Very long and very deep pages are taken whole: an element keeps its own label, and paths are
made for the few elements that vote. An element that is never closed ends with its parent; scripts and the like without an end tag hold the rest of the page, as in a browser, but buttons,
drawings, titles and frames without one are empty, as self-closed ones are. Repeated rows each get a row. Between containers of equal score the deeper one wins, then the first; between paths
with equal votes the last in text order. An empty table gives no rows. Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerlake.llm.common import importable, table
from tickerlake.session import materialise

VOTES_PER_PAGE = 3
#: Between the labels of a path; taken out of classes.
PATH = ">"

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page; of these, those that may lie in each other, and those that hold the rest of the page if they are not closed.
RAW = frozenset("script style noscript template textarea title iframe svg math object canvas select button".split())
NESTED = frozenset("template svg math object".split())
ENDLESS = frozenset("script style".split())
#: Elements that never belong to the article.
DROPPED = frozenset("nav header footer aside form dialog menu head".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("article main section div td body".split())
#: Words in class, id or role that mark boilerplate.
MARKS = frozenset(
    "ad ads adslot advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright "
    "disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices notification pager pagination popup promo "
    "promotion related replies search share sharing sidebar social sponsor sponsored subscribe subscription toolbar widget widgets "
    "alert complementary contentinfo".split()
)
COMMENT_MARKS = frozenset("comment comments disqus replies".split())
#: Words in class or id that mark the article.
ARTICLE_MARKS = frozenset("article content entry story post body text main".split())
#: An element with this share of a page's text is not dropped for its class alone.
MOST = 0.6

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"'<]|\"[^\"<]*\"|'[^'<]*')*+|[^>]*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[A-Za-z]+")
_DIGITS = re.compile(r"\d+")
_BOUNDARY_TAGS = {"li": ("ul", "ol", "menu"), "dd": ("dl",), "dt": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
_SAME_AS = {"dd": ("dd", "dt"), "dt": ("dd", "dt"), "td": ("td", "th"), "th": ("td", "th")}


class Page:
    """The elements of a page as parallel lists, and its text pieces with the element each lies in."""

    def __init__(self, html: str):
        self.tag, self.parent, self.label, self.depth = ["#root"], [-1], [""], [0]
        self.marks: list[frozenset[str]] = [frozenset()]
        self.pieces: list[tuple[int, str]] = []
        self.stack, self.open = [0], Counter()
        self._parse(html)
        self._measure()

    def path(self, node: int) -> str:
        """The generalised labels from the top to an element."""
        labels = []
        while node > 0:
            labels.append(self.label[node])
            node = self.parent[node]
        return PATH.join(reversed(labels))

    def at_path(self, path: str) -> set[int]:
        """The elements with this path."""
        labels = path.split(PATH)
        # How many labels lead to an element; -1 where they differ from the path's.
        led, found = [0], set()
        for i in range(1, len(self.tag)):
            above = led[self.parent[i]]
            fits = 0 <= above < len(labels) and labels[above] == self.label[i]
            led.append(above + 1 if fits else -1)
            if fits and above + 1 == len(labels):
                found.add(i)
        return found

    def _open(self, tag: str, attributes: str, parent: int) -> int:
        marks, label = frozenset(), tag
        if attributes.strip():
            found = {}
            for m in _ATTRIBUTE.finditer(attributes):
                found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
            if any(k in found for k in ("class", "id", "role", "hidden")):
                named = " ".join(found.get(k, "") for k in ("class", "id", "role"))
                marks = frozenset(w.lower() for w in _WORD.findall(named))
                if "hidden" in found:
                    marks |= {"#hidden"}
                classes = sorted(set(_DIGITS.sub("N", found.get("class", "").lower().replace(PATH, "")).split()))
                label = ".".join([tag, *classes])
        self.tag.append(tag)
        self.parent.append(parent)
        self.label.append(label)
        self.depth.append(self.depth[parent] + 1)
        self.marks.append(marks)
        return len(self.tag) - 1

    def _push(self, node: int) -> None:
        self.stack.append(node)
        self.open[self.tag[node]] += 1

    def _close(self, depth: int) -> None:
        """Close the open elements from this depth on."""
        for node in self.stack[depth:]:
            self.open[self.tag[node]] -= 1
        del self.stack[depth:]

    def _close_implied(self, tag: str) -> None:
        """Close what a start tag ends: a paragraph by any block, a list item by the next one, and so on."""
        stack = self.stack
        if tag in BLOCKS and self.open["p"]:
            for depth in range(len(stack) - 1, 0, -1):
                own = self.tag[stack[depth]]
                if own == "p":
                    self._close(depth)
                    break
                if own in BLOCKS:
                    break
        same = _SAME_AS.get(tag, (tag,))
        if tag in _BOUNDARY_TAGS and any(self.open[t] for t in same):
            for depth in range(len(stack) - 1, 0, -1):
                own = self.tag[stack[depth]]
                if own in same:
                    self._close(depth)
                    break
                if own in _BOUNDARY_TAGS[tag]:
                    break

    @staticmethod
    def _ends(html: str, tag: str) -> dict[int, int]:
        """Where the content of each closed element of this kind begins, and where its end tag does."""
        ends, waiting = {}, []
        for m in re.finditer(rf"<(/?){tag}(?=[\s/>])[^>]*>?", html, re.I):
            if m[1]:
                if waiting:
                    ends[waiting.pop()] = m.start()
            elif not m[0].endswith("/>"):
                if tag not in NESTED:
                    # inside itself it is text (of a script), or the one before was not closed
                    if tag in ENDLESS and waiting:
                        continue
                    waiting.clear()
                waiting.append(m.end())
        return ends

    def _parse(self, html: str) -> None:
        at, ends = 0, {}
        while True:
            m = _TOKEN.search(html, at)
            text = html[at : m.start() if m else len(html)]
            if text:
                self.pieces.append((self.stack[-1], text))
            if not m:
                return
            at = m.end()
            if not m[2]:
                continue
            tag = m[2].lower()
            if m[1]:
                if self.open[tag]:
                    depth = len(self.stack) - 1
                    while self.tag[self.stack[depth]] != tag:
                        depth -= 1
                    self._close(depth)
                continue
            if tag in RAW:
                if tag not in ends:
                    ends[tag] = self._ends(html, tag)
                end = ends[tag].get(at)
                if end is not None:
                    close = html.find(">", end)
                    at = close + 1 if close >= 0 else len(html)
                elif tag in ENDLESS and not m[3].endswith("/"):
                    return
                continue
            self._close_implied(tag)
            node = self._open(tag, m[3], self.stack[-1])
            if tag not in VOID and not m[3].endswith("/"):
                self._push(node)
            elif tag == "br":
                self.pieces.append((self.stack[-1], " "))

    def _measure(self) -> None:
        n = len(self.tag)
        size = [0] * n
        for node, text in self.pieces:
            size[node] += len(text.strip())
        whole = size[:]
        for i in range(n - 1, 0, -1):
            whole[self.parent[i]] += whole[i]
        total = whole[0]
        self.dropped, self.linked = [False] * n, [False] * n
        for i in range(1, n):
            tag, marks, above = self.tag[i], self.marks[i], self.parent[i]
            drop = self.dropped[above] or tag in DROPPED or "#hidden" in marks
            if not drop and marks and tag not in ("html", "body"):
                found = marks & (COMMENT_MARKS if tag in ("article", "main") else MARKS)
                drop = bool(found) and (whole[i] <= MOST * total or bool(found & COMMENT_MARKS))
            self.dropped[i] = drop
            self.linked[i] = self.linked[above] or tag == "a"
        kept = [0] * n
        for node, text in self.pieces:
            if not self.dropped[node]:
                kept[node] += 0 if self.linked[node] else len(text.strip())
        for i in range(n - 1, 0, -1):
            kept[self.parent[i]] += kept[i]
        self.kept = kept

    def scored(self) -> list[tuple[float, int]]:
        """(score, element) of the containers, best first; the deeper one where scores are equal."""
        found = []
        for i, tag in enumerate(self.tag):
            if tag in CONTAINERS and not self.dropped[i] and self.kept[i]:
                weight = {"article": 2.0, "main": 1.6, "body": 0.6}.get(tag, 1.3 if self.marks[i] & ARTICLE_MARKS else 1.0)
                found.append((self.kept[i] * weight, i))
        return sorted(found, key=lambda x: (-x[0], -self.depth[x[1]], x[1]))

    def votes(self) -> list[tuple[str, float]]:
        """Generalised paths of the best containers with their share of the best score."""
        best = self.scored()[:VOTES_PER_PAGE]
        seen: dict[str, float] = {}
        for score, i in best:
            seen.setdefault(self.path(i), score / best[0][0])
        return list(seen.items())

    def blocks(self, roots: set[int]) -> list[str]:
        """Texts of the blocks below the given elements, in page order."""
        inside = [False] * len(self.tag)
        block = [0] * len(self.tag)
        for i in range(len(self.tag)):
            above = self.parent[i]
            inside[i] = i in roots or (above >= 0 and inside[above])
            block[i] = i if self.tag[i] in BLOCKS or above < 0 else block[above]
        out: list[str] = []
        run, current = [], None
        for node, text in self.pieces:
            if not inside[node] or self.dropped[node]:
                continue
            if block[node] != current:
                out.append(" ".join(unescape("".join(run)).split()))
                run, current = [], block[node]
            run.append(text)
        out.append(" ".join(unescape("".join(run)).split()))
        return [x for x in out if x]

    def text(self, winner: str | None) -> tuple[str, str]:
        """The main text and the path it was taken from."""
        if winner:
            found = "\n".join(self.blocks({i for i in self.at_path(winner) if not self.dropped[i]}))
            if found:
                return found, winner
        best = self.scored()[:1]
        root = best[0][1] if best else 0
        return "\n".join(self.blocks({root})), self.path(root)


def host_of(url: Column) -> Column:
    """Lower-case host of a URL; empty where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)", 1)), F.lit(""))


def _pages(pages: DataFrame) -> DataFrame:
    importable(pages.sparkSession)
    return pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    ).withColumn("host", host_of(F.col("url")))


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        hosts, paths, weights = [], [], []
        for host, html in zip(b.column("host").to_pylist(), b.column("html").to_pylist()):
            for path, weight in Page(html or "").votes():
                hosts.append(host)
                paths.append(path)
                weights.append(weight)
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(weights, pa.float64())], ["host", "path", "weight"])


def host_paths(pages: DataFrame) -> DataFrame:
    """host, path, votes: the winning path of each host. Sums and maxima combine before the shuffle, so a hot host is no hot task."""
    votes = _pages(pages).where("host <> ''").select("host", "html").mapInArrow(_votes, "host string, path string, weight double")
    summed = votes.groupBy("host", "path").agg(F.round(F.sum("weight"), 6).alias("votes"))
    best = F.max(F.struct("votes", "path"))
    return summed.groupBy("host").agg(best.alias("best")).select("host", "best.path", "best.votes")


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [Page(html or "").text(path) for html, path in zip(b.column("html").to_pylist(), b.column("winner").to_pylist())]
        text = [x for x, _ in found]
        yield pa.RecordBatch.from_arrays(
            [b.column("page_id"), b.column("url"), pa.array(text, pa.string()), pa.array([len(x) for x in text], pa.int64()), pa.array([p for _, p in found], pa.string())],
            ["page_id", "url", "text", "n_chars", "path"],
        )


def extract(pages: DataFrame, winners: DataFrame | None = None) -> DataFrame:
    """page_id, url, text, n_chars, path of every page. ``winners`` defaults to the consensus of these pages.

    The winners are written once: the join is then planned by their true size, and beyond the broadcast limit
    both sides are shuffled by host, where skewed hosts are split.
    """
    winners = materialise(host_paths(pages), "host-paths") if winners is None else winners
    chosen = winners.select(F.col("host"), F.col("path").alias("winner"))
    joined = _pages(pages).join(chosen, "host", "left").select("page_id", "url", "html", "winner")
    return joined.mapInArrow(_texts, "page_id bigint, url string, text string, n_chars bigint, path string")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
