"""Main text of web pages, by the container paths that a host's pages agree on.

A page is read as blocks of text, each below a path of containers written as tag and class,
with numbers in classes generalised (``body/div.post-#``).  Menus, headers, footers,
sidebars, notices, adverts, forms, comments, scripts and styles yield no blocks.  Tags say so
for certain; a word in a class or id only marks an element, for wrappers are named after what
they surround.  A marked element goes with all it holds unless it holds most of the page's
unlinked text, or an unmarked ``article`` or ``main`` that holds a good part of it.

Each page scores its containers: characters outside links count for the nearest container
and by halves for those above it; an ``article`` or ``main`` takes the score of all it holds.
Spark counts for each path of a host on how many pages it occurs and on how many it is best.
A path wins if it is best on at least half of its pages; it is known if it occurs on a
hundredth of the host's pages.  Every page is then read again: of the known winners that it
has, the one that scores best on it yields its text.  If the page's own best path is not
known and scores more than twice as much, the page is of a rare layout and keeps its own; so
does a page that has no winner.

White space within a block becomes one space, also for line-break tags; blocks are joined
by one newline in page order.  Null and empty pages, and pages without blocks, have an empty
text.  Pages without a host in their url use their own container only.  Equal rows give equal
results; page_id may be null or repeated.  Columns other than page_id, url, html do not matter.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.batches import bounded
from quayside.session import cut_lineage

KNOWN_SHARE = 100  # a path is known if it occurs on one of so many pages of its host, or more often
EXTRACTED = "page_id bigint, url string, text string, n_chars bigint"

# Fixed values of the HTML language.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q s samp "
    "small span strike strong sub sup time tt u var ruby rt rp".split()
)
SKIPPED = set(
    "head title script style noscript template nav footer header aside button select option "
    "textarea iframe svg canvas object video audio dialog menu".split()
)
# A paragraph ends where one of these begins.
CONTAINERS = set("body article main section div td center details blockquote".split())

BOILERPLATE = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored banner promo cookie cookies "
    "consent gdpr notice popup modal sidebar newsletter subscribe share sharing social related "
    "recommended breadcrumb breadcrumbs pagination pager menu nav navbar navigation skip toolbar login "
    "signup search".split()
)
READERS = set("comment comments disqus replies".split())
WEAK_BOILERPLATE = set("header footer widget masthead top bottom meta tags aside".split())
CONTENT = set("article content main post entry story body text".split())
ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar".split())

# A marked element stays if it holds this share of the page's unlinked text.
STAYS = {"readers": 0.95, "plain": 0.8, "mixed": 0.3}
ARTICLE_SHARE = 0.3  # or an unmarked article or main with this share, readers' words excepted

_WORD = re.compile(r"[a-z]+|\d+")
_DIGITS = re.compile(r"\d+")


def mark_of(names: str) -> str | None:
    """What the words of a class and id say of an element."""
    words = set(_WORD.findall(names.lower()))
    if words & READERS:
        return "readers"
    if words & BOILERPLATE:
        return "mixed" if words & CONTENT else "plain"
    return "plain" if words & WEAK_BOILERPLATE and not words & CONTENT else None


class _Element:
    """An element with a mark, or an unmarked article or main, and the unlinked text in it."""

    def __init__(self, mark: str | None):
        self.mark, self.chars = mark, 0
        self.articles: list[_Element] = []

    def goes(self, total: int) -> bool:
        if self.mark != "readers" and any(a.chars >= ARTICLE_SHARE * total for a in self.articles if a.chars):
            return False
        return not self.chars or self.chars < STAYS[self.mark] * total


class _Blocks(HTMLParser):
    """Collects (container path, text, characters within links)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[tuple[str, ...], str, int, list[_Element]]] = []
        self.stack: list[tuple[str, str | None]] = []  # tag, step of the path if it is a container
        self.noted: list[tuple[int, _Element]] = []  # height of the stack, and what began there
        self.total = 0  # characters outside links
        self.skipped: list[int] = []  # heights of the stack at which skipping began
        self.parts: list[str] = []
        self.links = self.link_chars = 0

    def updatepos(self, i, j):
        return j  # line numbers are not needed

    def parse_html_declaration(self, i):
        if self.rawdata.startswith("<![", i):
            return self.parse_bogus_comment(i)
        return super().parse_html_declaration(i)

    def end_block(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                path = tuple(step for _, step in self.stack if step)
                linked = min(self.link_chars, len(text))
                within = [element for _, element in self.noted]
                for element in within:
                    element.chars += len(text) - linked
                self.total += len(text) - linked
                self.found.append((path, text, linked, [e for e in within if e.mark]))
            self.parts, self.link_chars = [], 0

    def pop_to(self, height: int) -> None:
        self.end_block()
        del self.stack[height:]
        while self.skipped and self.skipped[-1] >= height:
            self.skipped.pop()
        while self.noted and self.noted[-1][0] >= height:
            self.noted.pop()
        self.links = 0

    def close_open(self, tag: str, until: set[str]) -> None:
        """End an open element of this tag if none of the others was opened within it."""
        for height in range(len(self.stack) - 1, -1, -1):
            if self.stack[height][0] == tag:
                self.pop_to(height)
                return
            if self.stack[height][0] in until:
                return

    def handle_starttag(self, tag, attrs):
        if tag in INLINE:
            self.links += tag == "a"
            return
        if tag in VOID:
            if tag == "hr":
                self.end_block()
            elif tag == "br":
                self.parts.append(" ")
            return
        if tag == "html":
            return
        if tag == "body" and any(t == "body" for t, _ in self.stack):
            return
        if tag == "body":
            self.pop_to(0)
        self.close_open("p", CONTAINERS | SKIPPED | {"li"})
        if tag in ("li", "dt", "dd", "tr", "td", "th"):
            for other in {"dt": ("dd",), "dd": ("dt",), "td": ("th",), "th": ("td",)}.get(tag, ()) + (tag,):
                self.close_open(other, {"ul", "ol", "dl", "table"})
        self.end_block()
        named = dict(attrs)
        skip = tag in SKIPPED or (named.get("role") or "").lower() in ROLES
        if tag == "header" and any(t == "article" for t, _ in self.stack):
            skip = False
        if skip:
            self.skipped.append(len(self.stack))
        elif tag != "body":
            self.note(tag, mark_of(f"{named.get('class') or ''} {named.get('id') or ''}") if attrs else None)
        step = None
        if tag in CONTAINERS:
            classes = ".".join(sorted(set((named.get("class") or "").split())))
            step = _DIGITS.sub("#", f"{tag}.{classes}" if classes else tag).replace("/", "|")
        self.stack.append((tag, step))

    def note(self, tag: str, mark: str | None) -> None:
        if tag == "form" and mark is None:
            mark = "plain"
        if mark or tag in ("article", "main"):
            element = _Element(mark)
            if mark is None:
                for _, outer in self.noted:
                    outer.articles.append(element)
            self.noted.append((len(self.stack), element))

    def blocks(self) -> list[tuple[tuple[str, ...], str, int]]:
        gone = {id(e) for *_, marks in self.found for e in marks if e.goes(self.total)}
        return [(path, text, linked) for path, text, linked, marks in self.found if not any(id(e) in gone for e in marks)]

    def handle_endtag(self, tag):
        if tag in INLINE:
            if tag == "a" and self.links:
                self.links -= 1
            return
        if tag in VOID or tag in ("html", "body"):
            return
        for height in range(len(self.stack) - 1, -1, -1):
            if self.stack[height][0] == tag:
                self.pop_to(height)
                return

    def handle_data(self, data):
        if self.skipped or (self.cdata_elem is not None):
            return
        self.parts.append(data)
        if self.links:
            self.link_chars += len(data)


def blocks_of(html: str | None) -> list[tuple[tuple[str, ...], str, int]]:
    parser = _Blocks()
    parser.feed(html or "")
    parser.close()
    parser.end_block()
    return parser.blocks()


def container_scores(blocks) -> dict[tuple[str, ...], float]:
    scores: dict[tuple[str, ...], float] = defaultdict(float)
    for path, text, linked in blocks:
        worth = float(len(text) - linked)
        named = [i for i, step in enumerate(path) if step.split(".")[0] == "article"]
        named = named or [i for i, step in enumerate(path) if step.split(".")[0] == "main"]
        if named:
            scores[path[: named[0] + 1]] += worth
            continue
        for up in range(len(path)):
            scores[path[: len(path) - up]] += worth
            worth /= 2
    return scores


def _best(scores: dict[tuple[str, ...], float]) -> tuple[str, ...] | None:
    """The container that scores best; the first in order among equals."""
    return min(scores, key=lambda path: (-scores[path], path), default=None)


def best_path(blocks) -> str | None:
    best = _best(container_scores(blocks))
    return None if best is None else "/".join(best)


def text_below(blocks, path: tuple[str, ...] | None) -> str:
    return "\n".join(text for own, text, _ in blocks if path is None or own[: len(path)] == path)


def main_text(html: str | None, wins: dict[str, bool]) -> str:
    """The text of a page; ``wins`` says of each known path of its host whether it wins."""
    blocks = blocks_of(html)
    scores = container_scores(blocks)
    own = _best(scores)
    winners = {path: score for path, score in scores.items() if wins.get("/".join(path))}
    if winners:
        best = _best(winners)
        if "/".join(own) in wins or 2 * winners[best] >= scores[own]:
            return text_below(blocks, best)
    return text_below(blocks, own)


def host_of(url: Column) -> Column:
    """The host of a url in lower case, empty where there is none."""
    host = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:\[]*)", 1)
    return F.coalesce(F.lower(host), F.lit(""))


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each path of a host: pages of the batch that have it, and on which it is best."""
    for batch in batches:
        pages, votes = Counter(), Counter()
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            scores = container_scores(blocks_of(html))
            pages.update((host, path) for path in scores)
            if scores:
                votes[host, _best(scores)] += 1
        keys = list(pages)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([host for host, _ in keys], pa.string()),
                pa.array(["/".join(path) for _, path in keys], pa.string()),
                pa.array([pages[k] for k in keys], pa.int64()),
                pa.array([votes[k] for k in keys], pa.int64()),
            ],
            ["host", "path", "pages", "votes"],
        )


def host_paths(pages: DataFrame) -> DataFrame:
    """host and its known paths, each with whether it wins.

    A page has few containers, so a host has at most KNOWN_SHARE times as many known paths,
    however many pages it has.
    """
    votes = pages.where("host != ''").select("host", "html").mapInArrow(
        _votes, "host string, path string, pages bigint, votes bigint"
    )
    counted = cut_lineage(votes.groupBy("host", "path").agg(F.sum("pages").alias("pages"), F.sum("votes").alias("votes")))
    totals = counted.groupBy("host").agg(F.sum("votes").alias("total"))
    known = counted.join(totals, "host").where(F.col("pages") * KNOWN_SHARE >= F.col("total"))
    known = known.select("host", F.struct("path", (F.col("votes") * 2 >= F.col("pages")).alias("wins")).alias("known"))
    return known.groupBy("host").agg(F.collect_list("known").alias("known"))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(batch.column("html").to_pylist(), batch.column("known").to_pylist())
        texts = [main_text(html, {k["path"]: k["wins"] for k in known or ()}) for html, known in rows]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"),
                batch.column("url"),
                pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64()),
            ],
            ["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    rows = bounded(pages).select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    hosted = rows.withColumn("host", host_of(F.col("url")))
    known = cut_lineage(host_paths(hosted))
    # A few paths per host: broadcast if measured small, else a join whose hot hosts are split.
    joined = hosted.join(known, "host", "left").select("page_id", "url", "html", "known")
    return joined.mapInArrow(_extract, EXTRACTED)
