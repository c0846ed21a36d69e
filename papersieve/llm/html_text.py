"""Main text of HTML pages by consensus host paths.

Each page is read into blocks of text, every one under its path of containers. A container's path is
generalised to tags with their classes, digits as ``N``. Blocks inside menus, headers, footers, sidebars,
notices, adverts, forms and reader comments, told by tag, role, class or id, are furniture. A word in a class or id
(or a form) is no sign of furniture on a page where it holds most of the text: see ``Page._freed``. A page scores
its containers by the text that stands directly in them (half of it for the container around, a quarter for the next),
less links. Spark adds the shares of all paths up per host; the path with most of them wins the host.

The article is more than the winning container. All of the outermost ``article`` around it belongs to it, and what stands
beside or above it up to the outermost ``article`` or ``main``, or up to the whole page where there is neither. Such text beside is
taken in units (a child container, or the text directly in a container around); left out are units of links, and units where
one same text stands on more than half of the host's pages that have it, and on ``REPEATS`` at least. Pages without the winning path
start from their own best container.

Scores are whole numbers, so votes do not depend on the order of addition. Votes are added up per batch
before they are shuffled: a host with a third of all pages sends a few rows from each task. Of repeated units a row per different page
goes, spread over all tasks by its content. The
winners (a host, a path and its repeated units) are sent to the pages where they take at most ``BROADCAST_BYTES``, and joined by shuffle otherwise.

Defined cases: null or empty html gives an empty text; pages without url vote under the empty host; a page without any text
outside furniture gives an empty text; unclosed and stray tags are closed or skipped as browsers do;
a header, wherever it stands (within the article too), is left out with what it holds; nesting and unclosed elements of any number take time
and memory in proportion; repeated rows are read one by one and do not change each other's text; other columns are not read.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .base import slices, tidy
from .url_filter import host_of

BROADCAST_BYTES = 64 << 20
# Pages of a host with different other text that must repeat a text beside the article before it counts as furniture.
REPEATS = 3
# Characters of a path that are kept as they are.
LONG_PATH = 512
# Text that a plain furniture name must hold, besides nearly all of its page, to be no furniture; one part in REST is the most outside.
LEAST_TEXT, REST = 200, 20

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*|[^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NUMBER = re.compile(r"\d+")
_WORD = re.compile(r"[a-z]+|\d+")
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")

CONTAINERS = frozenset("html body main article section div td center blockquote details figure".split())
BLOCKS = CONTAINERS | frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr th pre address hr figcaption summary "
    "header footer nav aside form fieldset legend hgroup menu dialog search head title option select".split()
)
UNREAD = frozenset("script style noscript template iframe object svg math textarea title head select button canvas audio video".split())
OPAQUE = frozenset("script style textarea title iframe noscript".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FURNITURE = frozenset("nav header footer aside menu dialog search".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
FURNITURE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsbygoogle banner breadcrumb breadcrumbs comment comments commentlist "
    "consent cookie cookies copyright disclaimer disqus footer footnav gdpr header masthead menu modal nav navbar navigation navigator "
    "newsletter notice notices notification overlay pager pagination popup promo promotion recommended related reply replies share "
    "sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar topbar widget widgets".split()
)
_CLOSES = {"p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr"}, "option": {"option"}}


# Before a furniture word: the name tells what else the container holds.
LINKING_WORDS = frozenset("has have with without no and plus".split())
# Names that begin with these mean the thing itself, whatever follows.
OWN_WORDS = frozenset(
    "ad ads advert comment comments commentlist consent cookie cookies disqus gdpr newsletter promo recommended related reply replies share sharing social".split()
)
NO_MARKS: frozenset[tuple[str, bool]] = frozenset()


def _is_furniture(tag: str, attributes: dict[str, str]) -> bool:
    """Told by tag, role or state, whatever it holds."""
    if tag in FURNITURE or attributes.get("role", "").lower() in FURNITURE_ROLES:
        return True
    return tag not in ("html", "body") and ("hidden" in attributes or attributes.get("aria-hidden") == "true")


@functools.lru_cache(maxsize=4096)
def _marks(tag: str, names: str) -> frozenset[tuple[str, bool]]:
    """The names up to each furniture word in them, and whether they mean just that."""
    out = {("form", False)} if tag == "form" else set()
    for name in names.split() if tag not in ("html", "body") else ():
        words = _WORD.findall(_HUMP.sub(" ", name).lower())
        for i, word in enumerate(words):
            if word in FURNITURE_WORDS:
                last = all(w.isdigit() for w in words[i + 1 :])
                linked = i > 0 and words[i - 1] in LINKING_WORDS
                plain = not linked and not word.startswith("widget") and (last or (i == 0 and word in OWN_WORDS))
                out.add(("-".join(words[: i + 1]) + ("" if last else "-"), plain))
    return frozenset(out)


def _short(path: str) -> str:
    """The path, or a digest in place of a long one: equal paths stay equal, and deep nesting takes no more room per container."""
    return path if len(path) <= LONG_PATH else "#" + blake2b(path.encode("utf-8", "replace"), digest_size=16).hexdigest()


def _digest(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


class Page:
    """The blocks of a page: (containers around it, text, characters in links)."""

    def __init__(self, html: str | None):
        self._ignored = NO_MARKS
        self._begin()
        self._read(html or "")
        self._ignored = self._freed() if self._marked else NO_MARKS
        if self._ignored:
            self._begin()
            self._read(html or "")

    def _begin(self) -> None:
        self.paths: list[str] = []  # of each container, in page order
        self._opened: Counter = Counter()  # how often each tag stands on the stack
        self._endless: set[str] = set()  # ends that do not come any more
        self.tags: list[str] = []
        self.parents: list[int] = []
        self.blocks: list[tuple[int, str, int]] = []
        # tag, furniture whatever it holds, furniture, marks, in an article or main without marks, innermost container
        self._stack: list[tuple[str, bool, bool, frozenset, bool, int]] = [("", False, False, NO_MARKS, False, -1)]
        self._text: list[str] = []
        self._links = 0
        self._in_link = 0
        # Characters outside links: of the page, in unmarked article or main, and by mark (all, in unmarked article or main).
        self._total = self._clean = 0
        self._marked: Counter = Counter()
        self._marked_clean: Counter = Counter()
        self._around: dict[str, list[tuple[frozenset, frozenset]]] = {"article": [], "main": []}

    def _freed(self) -> frozenset[tuple[str, bool]]:
        """The marks that are no sign of furniture on this page.

        A mark that holds more than half of the page's text; one that means just that (``comments``, ``side-ad``) only if
        it holds all but a little. Where an unmarked article or main has text, only text in it counts. Else the page's only
        main or article frees the marks around it.
        """
        has_article = self._clean and REST * self._clean >= self._total
        held = self._marked_clean if has_article else self._marked
        freed = set()
        for mark in self._marked:
            n = held[mark]
            if mark[1]:
                enough = n >= LEAST_TEXT and REST * (self._total - n) <= n
            else:
                enough = 2 * n > self._total
            if enough:
                freed.add(mark)
        if not has_article:
            for tag, found in self._around.items():
                if len(found) == 1:
                    above, own = found[0]
                    freed |= {mark for mark in above if not mark[1]} | (own if tag == "main" else NO_MARKS)
        return frozenset(freed)

    def _flush(self) -> None:
        if self._text:
            text = " ".join(unescape("".join(self._text)).split())
            if text:
                self.blocks.append((self._stack[-1][5], text, min(self._links, len(text))))
        self._text, self._links = [], 0

    def _open(self, tag: str, raw: str) -> None:
        while self._stack[-1][0] in _CLOSES and tag in _CLOSES[self._stack[-1][0]]:
            self._opened[self._stack.pop()[0]] -= 1
        attributes = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(raw)} if "=" in raw or "hidden" in raw else {}
        _, closed, furniture, marks, clean, container = self._stack[-1]
        closed = closed or _is_furniture(tag, attributes)
        own = _marks(tag, f"{attributes.get('class', '')} {attributes.get('id', '')}") if attributes or tag == "form" else NO_MARKS
        furniture = furniture or closed or not own <= self._ignored
        if tag in self._around and not closed:
            self._around[tag].append((marks, own))
        marks = marks | own if own else marks
        clean = clean or (tag in self._around and not marks)
        if tag in CONTAINERS:
            names = ".".join(sorted(_NUMBER.sub("N", attributes.get("class", "")).split()))
            above = _short(self.paths[container]) + ">" if container >= 0 else ""
            self.paths.append(above + tag + ("." + _short(names) if names else ""))
            self.tags.append(tag)
            self.parents.append(container)
            container = len(self.paths) - 1
        self._stack.append((tag, closed, furniture, marks, clean, container))
        self._opened[tag] += 1

    def _close(self, tag: str) -> None:
        last = "" if self._opened[tag] else tag
        while last != tag:
            last = self._stack.pop()[0]
            self._opened[last] -= 1

    def _say(self, text: str) -> None:
        _, closed, furniture, marks, clean, _ = self._stack[-1]
        if not closed and not self._in_link:
            n = len(text.strip())
            self._total += n
            if clean and not marks:
                self._clean += n
            for mark in marks:
                self._marked[mark] += n
                if clean:
                    self._marked_clean[mark] += n
        if not furniture:
            self._text.append(text)
            if self._in_link:
                self._links += len(text)

    def _read(self, html: str) -> None:
        at = 0
        while found := _TOKEN.search(html, at):
            if found.start() > at:
                self._say(html[at : found.start()])
            at = found.end()
            if found[2] is None:
                continue
            tag, closing = found[2].lower(), bool(found[1])
            if not closing and tag in UNREAD:
                if tag in OPAQUE or not found[0].endswith("/>"):
                    at = self._skip(html, tag, at)
                continue
            if tag in BLOCKS:
                self._flush()
            elif tag in ("br", "wbr", "img"):
                self._say(" " if tag == "br" else "")
            if tag == "a":
                self._in_link = max(0, self._in_link + (-1 if closing else 1))
            if closing:
                self._close(tag)
            elif tag not in VOID and (tag in BLOCKS or "=" in found[3] or "hidden" in found[3]) and tag != "a":
                self._open(tag, found[3])
        if at < len(html):
            self._say(html[at:])
        self._flush()

    def _skip(self, html: str, tag: str, at: int) -> int:
        """Behind the end of an element that is not read; an unclosed head ends where the body begins."""
        end = self._find(html, f"</{tag}", rf"</{tag}\s*>", at)
        if end is None and tag == "head":
            end = self._find(html, "<body", r"(?=<body)", at)
        return end if end is not None else (at if tag not in OPAQUE else len(html))

    def _find(self, html: str, name: str, pattern: str, at: int) -> int | None:
        """Where the pattern's next match ends; once there is none, nothing is searched any more."""
        found = None if name in self._endless else re.compile(pattern, re.I).search(html, at)
        if found is None:
            self._endless.add(name)
            return None
        return found.end()

    def scores(self) -> Counter:
        """Whole-number scores of container paths."""
        out: Counter = Counter()
        for container, text, links in self.blocks:
            value = 4 * max(0, len(text) - 2 * links)
            while container >= 0 and value:
                out[self.paths[container]] += value
                container, value = self.parents[container], value // 2
        return out

    def votes(self) -> list[tuple[str, int]]:
        """The container paths, best first, with their shares in thousandths."""
        best = sorted(self.scores().items(), key=lambda x: (-x[1], x[0]))
        total = sum(v for _, v in best)
        return [(path, 1000 * value // total) for path, value in best if value]

    def _start(self, path: str | None) -> str | None:
        if path in self.paths:
            return path
        own = self.votes()
        return own[0][0] if own else None

    def _below(self, path: str) -> list[bool]:
        inside = [False] * len(self.paths)
        for i, own in enumerate(self.paths):
            inside[i] = own == path or (self.parents[i] >= 0 and inside[self.parents[i]])
        return inside

    def parts(self, path: str) -> tuple[list[int], dict[str, list[int]]]:
        """Blocks (by number) of the article around the containers with this path, and of each unit of text beside it."""
        at, chain = self.paths.index(path), []
        while at >= 0:
            chain.append(at)
            at = self.parents[at]
        articles = [i for i in chain if self.tags[i] == "article"]
        ends = [i for i in chain if self.tags[i] in self._around]
        whole, top = (articles or chain[:1])[-1], ends[-1] if ends else -1
        inside = self._below(self.paths[whole])
        within = self._below(self.paths[top]) if ends else [True] * len(self.paths)
        around = {self.paths[i] for i in chain if top <= i < whole}
        units = [""] * len(self.paths)
        for i, own in enumerate(self.paths):
            above = self.parents[i]
            if own in around:
                units[i] = own + " direct"
            elif above < 0 or self.paths[above] in around:
                units[i] = own
            else:
                units[i] = units[above]
        core: list[int] = []
        beside: dict[str, list[int]] = {}
        for number, (container, _, _) in enumerate(self.blocks):
            if container >= 0 and inside[container]:
                core.append(number)
            elif within[container] if container >= 0 else not ends:
                beside.setdefault(units[container] if container >= 0 else " direct", []).append(number)
        kept = {}
        for unit, numbers in beside.items():
            if sum(len(self.blocks[n][1]) - 2 * self.blocks[n][2] for n in numbers) > 0:
                kept[unit] = numbers
        return core, kept

    def beside(self, path: str | None) -> list[tuple[str, int, int]]:
        """Each unit of text beside the article, with digests of its text and of all other text: the article and the other units."""
        start = self._start(path)
        if start is None:
            return []
        core, units = self.parts(start)
        texts = {unit: "\n".join(self.blocks[n][1] for n in numbers) for unit, numbers in [("", core), *units.items()]}
        named = {unit: _digest(f"{unit}\n{text}") for unit, text in texts.items()}
        whole = sum(named.values())
        return [(unit, _digest(texts[unit]), (whole - named[unit]) % (1 << 63)) for unit in units]

    def text_below(self, path: str | None, repeated: Iterable[str] = ()) -> str:
        """The article around the containers with this path, or around the page's own best one; all blocks if it has none."""
        start = self._start(path)
        if start is None:
            return "\n".join(text for _, text, _ in self.blocks)
        core, units = self.parts(start)
        gone = set(repeated or ())
        numbers = core + [n for unit, found in units.items() if unit not in gone for n in found]
        return "\n".join(self.blocks[n][1] for n in sorted(numbers))


def winning_paths(pages: DataFrame) -> DataFrame:
    """(host, path): the generalised container path that a host's pages agree on most."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            tally: Counter = Counter()
            for host, html in zip(part["host"].to_pylist(), part["html"].to_pylist()):
                for path, share in Page(html).votes():
                    tally[host, path] += share
            rows = [(host, path, share) for (host, path), share in tally.items()]
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row)) for row in rows], schema)

    schema = pa.schema([("host", pa.string()), ("path", pa.string()), ("votes", pa.int64())])
    rows = pages.select(host_of(F.col("url")).alias("host"), F.col("html").cast("string").alias("html"))
    votes = rows.mapInArrow(tidy(vote), "host string, path string, votes long").groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    first = F.max_by("path", F.struct("votes", F.col("path"))).alias("path")
    return votes.groupBy("host").agg(first)


def _size(winners: DataFrame, *more) -> int:
    return winners.select(F.sum(sum(more, F.octet_length("host") + F.octet_length("path") + 64)).alias("b")).first()["b"] or 0


def repeated_units(pages: DataFrame, winners: DataFrame) -> DataFrame:
    """(host, repeated): units beside the article where most of a host's different pages, copies aside, have the same."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            rows: set[tuple] = set()
            for host, html, path in zip(*(part[c].to_pylist() for c in ("host", "html", "path"))):
                rows.update((host, *found) for found in Page(html).beside(path))
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row)) for row in rows], schema)

    schema = pa.schema([("host", pa.string()), ("unit", pa.string()), ("digest", pa.int64()), ("others", pa.int64())])
    rows = pages.select(host_of(F.col("url")).alias("host"), F.col("html").cast("string").alias("html"))
    joined = rows.join(F.broadcast(winners) if _size(winners) <= BROADCAST_BYTES else winners, "host", "left")
    said = joined.mapInArrow(tidy(read), "host string, unit string, digest long, others long").distinct()
    texts = said.groupBy("host", "unit", "digest").agg(F.count("*").alias("n"))
    units = texts.groupBy("host", "unit").agg(F.max("n").alias("most"), F.sum("n").alias("pages"))
    same = units.filter((F.col("most") >= REPEATS) & (2 * F.col("most") > F.col("pages")))
    return same.groupBy("host").agg(F.sort_array(F.collect_list("unit")).alias("repeated"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for each row of pages."""
    winners = cut_lineage(winning_paths(pages))
    winners = cut_lineage(winners.join(repeated_units(pages, winners), "host", "left"))
    size = _size(winners, F.coalesce(F.octet_length(F.array_join("repeated", " ")), F.lit(0)))
    kind = dict(pages.dtypes)["page_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            texts = [Page(h).text_below(*p) for h, *p in zip(*(part[c].to_pylist() for c in ("html", "path", "repeated")))]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part["page_id"], part["url"], pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"]
            )

    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    rows = rows.withColumn("host", host_of(F.col("url")))
    joined = rows.join(F.broadcast(winners) if size <= BROADCAST_BYTES else winners, "host", "left")
    return joined.select("page_id", "url", "html", "path", "repeated").mapInArrow(tidy(run), f"page_id {kind}, url string, text string, n_chars long")
