"""The main text of web pages, as the contiguous region of a page with the greatest score.

A page is a sequence of words and tags. Words score by how much likelier they are inside an article than outside: by the block they are in, links,
the length of the block, what the elements around them call themselves. Tags score negative, more so the rarer their kind is within articles. The weights are
log odds counted on labelled pages: those of the table that mark their article themselves, and a few examples kept here, so that
kinds of pages the table doesn't have are known too. One linear scan finds the region; within it, blocks that belong to menus, notices,
adverts, forms, comments and the like are left out.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressroom.llm.examples import LABELLED_PAGES
from pressroom.llm.words import pieces

#: About so many labelled pages, chosen by hash, are counted for the weights.
TRAINING_PAGES = 20_000
#: The log odds of one feature lie within these bounds, so that none decides alone.
BOUND = 2.0
#: A tag costs at least so much.
LEAST_COST = 0.02
#: The examples count as much as so many words of the table's pages.
EXAMPLE_WORDS = 20_000
#: A form with more words than this is a page that was put into a form.
FORM_WORDS = 200

# Names of elements, and words of class names, ids and roles.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe noembed noframes xmp textarea title svg math object canvas audio video".split())
INLINE = frozenset("a abbr b bdi bdo button cite code em font i img input label mark q s small span strong sub sup time u br".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
KIND_OF_ELEMENT = {
    "nav": "menu", "menu": "menu", "header": "header", "footer": "footer", "aside": "sidebar", "dialog": "notice",
    "form": "form", "search": "form", "select": "form", "button": "form", "fieldset": "form", "head": "head",
}
KIND_OF_ROLE = {
    "navigation": "menu", "menu": "menu", "menubar": "menu", "tablist": "menu", "banner": "header", "contentinfo": "footer",
    "complementary": "sidebar", "alert": "notice", "alertdialog": "notice", "dialog": "notice", "status": "notice", "search": "form", "form": "form",
}
KIND_OF_WORD = {
    word: kind
    for kind, words in {
        "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager skiplink",
        "header": "header masthead topbar",
        "footer": "footer colophon copyright",
        "sidebar": "sidebar aside rail related recommended recommendations widget trending popular",
        "notice": "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription paywall disclaimer toast",
        "advert": "ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored sponsors promo promotion banner",
        "form": "form search login signin signup captcha",
        "comments": "comment comments commentlist disqus respond replies discussion",
        "share": "share sharing social",
    }.items()
    for word in words.split()
}
CONTENT_WORDS = frozenset("content article post entry story text body main".split())
CONTAINERS = frozenset(["article", "main"])

_OPENING = re.compile(r"<(?=[a-zA-Z/!?])")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_TAG = re.compile(r"""<([a-zA-Z][^\s/>]*)((?:[\s/]+|[^\s/>=][^\s/>=]*+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>"'][^\s>]*+))?)*+)>""")
_ATTRIBUTE = re.compile(r"""([^\s/>=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*)))?""")
_READ = frozenset("class id role itemprop hidden aria-hidden data-main".split())
#: Elements nested deeper than this are read as if they had ended at once, as browsers do.
_DEPTH = 512
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|$)", re.IGNORECASE) for name in RAW}
_LENGTHS = (1, 2, 4, 8, 16, 32)

_RESULT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])
_COUNTS = pa.schema([("feature", pa.string()), ("value", pa.string()), ("inside", pa.int64()), ("outside", pa.int64())])


class _Kind:
    """What a boilerplate element is, and how many words it has."""

    __slots__ = ("name", "words")

    def __init__(self, name: str):
        self.name, self.words = name, 0


class Block:
    """The text of one block, and what is known of where it stands."""

    __slots__ = ("tag", "text", "words", "linked", "kind", "container", "named", "main")

    def __init__(self, tag, text, words, linked, kind, container, named, main):
        self.tag, self.text, self.words, self.linked, self.kind = tag, text, words, linked, kind
        self.container, self.named, self.main = container, named, main

    def boilerplate(self) -> str | None:
        kind = self.kind
        return None if kind is None or (kind.name == "form" and kind.words > FORM_WORDS) else kind.name


def _attributes(source: str) -> dict[str, str]:
    if not source or source.isspace():
        return {}
    found = ((m[1].lower(), m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(source))
    return {name: html.unescape(value) for name, value in found if name in _READ}


def _kind_of(tag: str, attributes: dict[str, str], in_container: bool) -> str | None:
    """What kind of boilerplate an element is, if any. Within an article a header is the article's own."""
    kind = KIND_OF_ELEMENT.get(tag)
    if kind is None and attributes and tag not in ("body", "html"):
        if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
            return "notice"
        kind = KIND_OF_ROLE.get(attributes.get("role", "").lower())
        if kind is None:
            for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
                parts = [p.lower() for p in _PART.findall(name)]
                if parts and parts[0] not in ("with", "has", "no", "without"):
                    kind = next((KIND_OF_WORD[p] for p in parts if p in KIND_OF_WORD), None)
                if kind:
                    break
    if kind == "header" and (in_container or tag in HEADINGS):
        return None
    if tag in CONTAINERS and kind != "comments":
        return None
    return kind


class _Parser:
    """A page as a list of tag names and ``Block``s, in one pass."""

    def __init__(self, page: str):
        self.items: list[str | Block] = []
        self.open: list[tuple] = []  # (tag, kind, container, named as content, link, marked as main)
        self.parts: list[tuple[str, bool]] = []
        self.junk: list[tuple[str, bool, _Kind]] = []
        self.containers = 0
        self.state: tuple = (None, None, 0, False, False, False)
        self._run(page)

    def _run(self, page: str) -> None:
        at, n = 0, len(page)
        while at < n:
            found = _OPENING.search(page, at)
            if not found:
                self._text(page[at:])
                break
            start = found.start()
            if start > at:
                self._text(page[at:start])
            second = page[start + 1]
            if second == "!" or second == "?":
                at = self._declaration(page, start)
            elif second == "/":
                name = _NAME.match(page, start + 2)
                end = page.find(">", start)
                if name and end >= 0:
                    self._end(name[0].lower())
                at = end + 1 if end >= 0 else n
            else:
                tag = _TAG.match(page, start)
                if tag:
                    name, attributes, at = tag[1].lower(), tag[2], tag.end()
                else:  # a quote that isn't closed: the tag ends at the next bracket
                    name, attributes, end = _NAME.match(page, start + 1)[0].lower(), "", page.find(">", start)
                    at = end + 1 if end >= 0 else n
                if name in RAW:
                    close = _RAW_END[name].search(page, at)
                    end = page.find(">", close.end()) if close else -1
                    at = end + 1 if end >= 0 else n
                    self.items.append(name)
                elif at <= n:
                    self._start(name, attributes)
        self._flush()

    @staticmethod
    def _declaration(page: str, start: int) -> int:
        if page.startswith("<!--", start):
            if page.startswith(("<!-->", "<!--->"), start):
                return page.index(">", start) + 1
            ends = [(page.find(e, start + 4), len(e)) for e in ("-->", "--!>")]
            ends = [a + k for a, k in ends if a >= 0]
            return min(ends) if ends else len(page)
        end = page.find(">", start)
        return end + 1 if end >= 0 else len(page)

    def _text(self, source: str) -> None:
        text = html.unescape(source) if "&" in source else source
        _, kind, _, _, link, _ = self.state
        if kind is None:
            self.parts.append((text, link))
        else:
            self.junk.append((text, link, kind))

    def _flush(self) -> None:
        """End the block that is open."""
        tag, _, container, named, _, main = self.state
        if self.parts:
            self._emit(tag, self.parts, None, container, named, main)
            self.parts = []
        if self.junk:
            self._emit(tag, [(t, a) for t, a, _ in self.junk], self.junk[0][2], container, named, main)
            self.junk = []

    def _emit(self, tag, parts, kind, container, named, main) -> None:
        words = "".join(t for t, _ in parts).split()
        if not words:
            return
        linked = sum(len(t.split()) for t, a in parts if a)
        if kind is not None:
            kind.words += len(words)
        self.items.append(Block(tag, " ".join(words), len(words), min(linked, len(words)), kind, container, named, main))

    def _start(self, tag: str, source: str) -> None:
        if tag == "br":
            self.parts.append((" ", False))
            self.items.append(tag)
            return
        block = tag in BLOCKS
        if block:
            self._flush()
            if tag not in ("html", "body"):
                self._close_implied(tag)
        self.items.append(tag if block or tag in INLINE else "other")
        if tag in VOID or len(self.open) >= _DEPTH:
            return
        attributes = _attributes(source)
        outer, kind, container, named, link, main = self.state
        if tag in CONTAINERS or attributes.get("itemprop", "").lower() == "articlebody":
            if not container:
                self.containers += 1
                container = self.containers
            if kind is not None and kind.name not in ("comments", "sidebar"):
                kind = None  # an article in what isn't closed, or in a wrapper with a misleading name
        if kind is None and (own := _kind_of(tag, attributes, container > 0)):
            kind = _Kind(own)
        if not named and attributes and CONTENT_WORDS.intersection(re.split(r"[^a-z]+", f"{attributes.get('class', '')} {attributes.get('id', '')}".lower())):
            named = True
        self.open.append((tag, *self.state))
        self.state = (tag if block else outer, kind, container, named, link or tag == "a", main or "data-main" in attributes)

    def _close_implied(self, tag: str) -> None:
        """Elements that end where another begins: paragraphs, list items, table cells and rows, options."""
        ends = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}.get(tag, ())
        stop = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "option": ("select",)}.get(tag, ("table", "div", "article", "section", "main", "body", "td", "li"))
        if any(x[0] == "p" for x in self.open[-8:]):
            self._pop("p", ("div", "article", "section", "main", "td", "li", "table", "blockquote"))
        for name in ends:
            self._pop(name, stop)

    def _pop(self, tag: str, stop: tuple[str, ...]) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                self.state = self.open[i][1:]
                del self.open[i:]
                return
            if self.open[i][0] in stop:
                return

    def _end(self, tag: str) -> None:
        block = tag in BLOCKS
        self.items.append("/" + (tag if block or tag in INLINE else "other"))
        if block:
            self._flush()
        if tag in ("html", "body"):
            return
        self._pop(tag, ("table",) if tag not in ("table", "article", "main", "body") else ())


def parse(page: str | None) -> list[str | Block]:
    """Tag names, and the blocks of text between them, in page order."""
    return _Parser(page or "").items


def _features(block: Block, containers: bool) -> list[tuple[str, str]]:
    length = sum(block.words > k for k in _LENGTHS)
    place = "absent" if not containers else "inside" if block.container else "outside"
    return [
        ("block", block.tag if block.tag in BLOCKS else "none"),
        ("links", "most" if 2 * block.linked > block.words else "some" if block.linked else "none"),
        ("length", str(length)),
        ("kind", block.boilerplate() or "none"),
        ("place", place),
        ("named", str(block.named)),
        ("sentence", str(block.text[-1] in ".!?:;…\"”»")),
    ]


def count_page(items: list[str | Block], inside: list[bool], into: dict) -> None:
    """Add a page's words and tags to the counts, by whether they are inside its article."""
    containers = any(isinstance(x, Block) and x.container for x in items)
    for x, within in zip(items, inside, strict=True):
        if isinstance(x, Block):
            for f in _features(x, containers):
                into[f][not within] += x.words
        else:
            into["tag", x.lstrip("/")][not within] += 1


def _spread(labels: list[bool | None]) -> list[bool]:
    """Whether each item lies between the first and the last block of the article; blocks have labels, tags none."""
    marked = [i for i, within in enumerate(labels) if within]
    low, high = (marked[0], marked[-1]) if marked else (1, 0)
    return [(low <= i <= high) if within is None else within for i, within in enumerate(labels)]


def _self_labelled(items: list[str | Block]) -> list[bool] | None:
    """The article a page marks itself, if it marks just one."""
    marked = {x.container for x in items if isinstance(x, Block)} - {0}
    if len(marked) != 1:
        return None
    return _spread([None if isinstance(x, str) else bool(x.container) and x.boilerplate() is None for x in items])


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict = defaultdict(lambda: [0, 0])
    for piece in pieces(batches, "html"):
        for page in piece.column("html").to_pylist():
            items = parse(page)
            inside = _self_labelled(items)
            if inside is not None:
                count_page(items, inside, counts)
    rows = [(f, v, a, b) for (f, v), (a, b) in counts.items()]
    columns = list(zip(*rows, strict=True)) or [[], [], [], []]
    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, _COUNTS, strict=True)], schema=_COUNTS)


def example_counts() -> dict[tuple[str, str], tuple[float, float]]:
    """The counts of the labelled examples; their article is what ``data-main`` marks, without boilerplate in it."""
    counts: dict = defaultdict(lambda: [0, 0])
    for page in LABELLED_PAGES:
        items = parse(page)
        count_page(items, _spread([None if isinstance(x, str) else x.main and x.boilerplate() is None for x in items]), counts)
    return {k: tuple(v) for k, v in counts.items()}


def _scaled(counts: dict, words: float) -> dict[tuple[str, str], tuple[float, float]]:
    """Counts as if there were so many words inside and as many outside, and tags in proportion."""
    totals = [sum(v[i] for (f, _), v in counts.items() if f == "place") for i in (0, 1)]
    return {k: tuple(x * words / t if t else 0.0 for x, t in zip(v, totals, strict=True)) for k, v in counts.items()}


def weights(counts: dict[tuple[str, str], tuple[float, float]]) -> dict[tuple[str, str], float]:
    """Bounded log odds of every feature value, from the table's counts and the examples."""
    parts = [_scaled(example_counts(), EXAMPLE_WORDS)]
    words = min(sum(v[i] for (f, _), v in counts.items() if f == "place") for i in (0, 1)) if counts else 0
    if words:
        parts.append(_scaled(counts, min(words, EXAMPLE_WORDS)))
    both: dict = defaultdict(lambda: [0.0, 0.0])
    for part in parts:
        for k, (a, b) in part.items():
            both[k][0] += a
            both[k][1] += b
    totals: dict = defaultdict(lambda: [0.0, 0.0])
    for (f, _), (a, b) in both.items():
        totals[f][0] += a
        totals[f][1] += b
    out = {}
    for (f, v), (a, b) in both.items():
        odds = math.log((a + 10) / (totals[f][0] + 20)) - math.log((b + 10) / (totals[f][1] + 20))
        out[f, v] = max(-BOUND, min(BOUND, odds))
    return out


def _probability(odds: float) -> float:
    return 1 / (1 + math.exp(-odds))


def scores(items: list[str | Block], weight: dict[tuple[str, str], float]) -> list[float]:
    """The score of each item: words times the chance above even that they are of an article; a cost for tags."""
    containers = any(isinstance(x, Block) and x.container for x in items)
    out = []
    for x in items:
        if isinstance(x, Block):
            out.append(x.words * (_probability(sum(weight.get(f, 0.0) for f in _features(x, containers))) - 0.5))
        else:
            out.append(min(_probability(weight.get(("tag", x.lstrip("/")), 0.0)) - 0.5, 0.0) - LEAST_COST)
    return out


def best_region(values: list[float]) -> tuple[int, int]:
    """First and last place (exclusive) of the contiguous run with the greatest positive sum; the first of equal ones. ``(0, 0)`` if none is positive."""
    best, found, total, begin = 0.0, (0, 0), 0.0, 0
    for i, v in enumerate(values):
        if total <= 0:
            total, begin = 0.0, i
        total += v
        if total > best:
            best, found = total, (begin, i + 1)
    return found


def main_text(page: str | None, weight: dict[tuple[str, str], float]) -> str:
    """The blocks of the best region without boilerplate, joined by an empty line. A region within an element that the page marks as its
    article is carried on to that element's ends."""
    items = parse(page)
    low, high = best_region(scores(items, weight))
    within = {x.container for x in items[low:high] if isinstance(x, Block) and x.boilerplate() is None} - {0}
    kept = [
        x.text
        for i, x in enumerate(items)
        if isinstance(x, Block) and x.boilerplate() is None and (low <= i < high or x.container in within)
    ]
    return "\n\n".join(kept)


def learned_weights(pages: DataFrame) -> dict[tuple[str, str], float]:
    """Weights from pages that mark their article, about ``TRAINING_PAGES`` of them; without any, from the examples alone. What is collected is
    one row for each kind of tag and feature, a few hundred at most."""
    marked = pages.select("page_id", "html").filter(F.col("html").rlike("(?i)<(article|main)[\\s>]|articleBody"))
    number = marked.count()
    if not number:
        return weights({})
    share = min(1.0, TRAINING_PAGES / number)
    chosen = marked.filter(F.pmod(F.xxhash64("page_id", "html"), F.lit(1_000_000)) < int(share * 1_000_000))
    schema = "feature string, value string, inside long, outside long"
    counts = chosen.select("html").mapInArrow(_count_batches, schema).groupBy("feature", "value").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
    return weights({(r["feature"], r["value"]): (r["inside"], r["outside"]) for r in counts.collect()})


def extract_main_text(pages: DataFrame) -> DataFrame:
    """Per row of ``pages(page_id, url, html)``: ``page_id``, ``url``, ``text`` and ``n_chars``.

    A null or empty page, or one without an article, has an empty text. Damaged pages are read as far as they make sense: comments, scripts and tags that never
    end go on to the end of the page. Repeated rows each get a row, an empty table gives none, and other columns are not read.
    """
    weight = learned_weights(pages)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "html"):
            texts = [main_text(page, weight) for page in piece.column("html").to_pylist()]
            columns = [piece.column("page_id"), piece.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema=_RESULT)

    chosen = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return chosen.mapInArrow(extract, "page_id long, url string, text string, n_chars long")
