"""Main text of web pages by smoothed text-to-tag ratios.

The standard parser's events are read as a stream. Block elements begin new lines; a line counts its
letters outside links and its tags. What stands in elements that hold menus, adverts and the like, or
are hidden, is not read; inside a line it goes without ending the line. Forms, and elements that a
class, id or role names so, are left out too, unless the structure of the page shows a wrapper:

* If the page has an article or main element, and each stands in named elements, those around the one
  with the most text are wrappers. Words for comments never name a wrapper.
* If hardly any unnamed line reaches the threshold, so that names don't tell the text from the rest, the elements with the most text are wrappers, if their names are more than the bare word
  and they hold a few lines. Elements that share such a name are wrappers like them, unless they have
  a word beside it. The same rule holds inside articles.

A name on an article counts only inside another article, but for comments. A page with an article or
main element has its text there. The letters a tag of the lines are smoothed by a Gaussian over
neighbouring lines, and lines are clustered by a threshold on the smoothed ratio, a share of its usual
value, which a very long line hardly moves. An article with a line above it is taken whole, with all
containers in it. Elsewhere a container with a line above it gives its lines from the first to the
last one above. All takes time in proportion to the page.

Null and empty pages give the empty text, and so do pages without content. Broken markup is read as
far as it goes. Repeated rows get the same text, a row each. An empty table gives an empty one.
"""

from __future__ import annotations

import re
from collections import defaultdict
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_text, strings

#: Spread of the smoothing in lines, and the share of the usual ratio that a content line reaches.
SPREAD = 1.5
SHARE = 0.3
#: Text outside articles has so many letters, or so many lines in one place.
LETTERS = 200
LINES = 3
#: Unnamed lines with less than that are text if they hold this share of the letters above the threshold.
TOLD = 0.05
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary"
    " table tbody tfoot thead title tr ul".split()
)
CONTAINERS = frozenset("article body div main section aside form footer header nav".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that hold no main text.
OUT = frozenset(
    "aside button canvas datalist dialog footer head iframe input label menu nav noscript object option script"
    " select style svg template textarea title video audio".split()
)
#: Words in class, id or role that say the same, unless the name is ignored.
OUT_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising alert banner breadcrumb breadcrumbs byline comment comments"
    " complementary consent contentinfo cookie cookies dialog disqus disclaimer footer form gdpr login masthead menu"
    " menubar modal nav navbar navigation newsletter notice notices notification outbrain pager pagination popup promo"
    " promoted promotion recommended related replies reply reviews search share sharing sidebar sidenav signup skip"
    " social sponsor sponsored subscribe subscription taboola tags toolbar topbar widget".split()
)
#: Words that never name a wrapper.
COMMENTS = frozenset("comment comments disqus replies reply".split())
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
WORD = re.compile(r"[a-z0-9]+")
#: Stands for the form element among the names.
FORM = "<form>"
#: Names of one element that are one of the words or hold one.
Names = frozenset[str]
NONE: frozenset[Names] = frozenset()


def words(names: Names) -> set[str]:
    return {w for name in names for w in ([FORM] if name == FORM else WORD.findall(name)) if w in OUT_WORDS or w == FORM}


class Place(NamedTuple):
    """What holds inside an element: names inside and around the article, which is numbered; outside all names are inside ones."""

    out: bool = False
    container: int = 0
    article: int = 0
    link: bool = False
    inside: frozenset[Names] = NONE
    around: frozenset[Names] = NONE


class Line(NamedTuple):
    """Parts of (text, letters outside links, place), and the tags before and inside."""

    parts: list[tuple[str, int, Place]]
    tags: int


class Lines(HTMLParser):
    """Collects the lines of a page. Places of open tags are kept by name, so that closing one takes no search."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, Place]] = []
        self.open: dict[str, list[int]] = defaultdict(list)
        self.containers: list[int] = []
        self.blocks: list[int] = []
        self.lines: list[Line] = []
        self.regions = self.articles = 0
        self.parts: list[tuple[str, int, Place]] = []
        self.tags = 0

    def state(self) -> Place:
        return self.stack[-1][1] if self.stack else Place()

    def flush(self):
        if any(not text.isspace() for text, _, _ in self.parts):
            self.lines.append(Line(self.parts, self.tags))
            self.tags = 0
        self.parts = []

    def handle_starttag(self, tag, attrs):
        above = self.state()
        if not above.out:
            if tag in BLOCKS:
                self.flush()
            elif tag in ("br", "td", "th"):
                self.parts.append((" ", 0, above))
            self.tags += 1
        if tag in BLOCKS and tag != "option":
            self._close_paragraph(tag)
            above = self.state()
        if tag in VOID:
            return
        out, container, article, link, inside, around = above
        if not out:
            out = tag in OUT or self._hidden(tag, attrs, article)
            if names := self._names(tag, attrs, article):
                inside |= {names}
        if tag in CONTAINERS:
            self.regions += 1
            container = self.regions
        if tag in ("article", "main") and not out and not article:
            self.articles += 1
            article, inside, around = self.articles, NONE, inside
        at = len(self.stack)
        self.open[tag].append(at)
        if tag in CONTAINERS:
            self.containers.append(at)
        if tag in BLOCKS or tag in ("td", "th", "button"):
            self.blocks.append(at)
        self.stack.append((tag, Place(out, container, article, link or tag == "a", inside, around)))

    def _cut(self, at: int):
        """Close what is open from this place of the stack on."""
        while len(self.stack) > at:
            tag, _ = self.stack.pop()
            self.open[tag].pop()
            for places in (self.containers, self.blocks):
                if places and places[-1] == len(self.stack):
                    places.pop()

    def _close_paragraph(self, tag):
        """A block ends an open paragraph, a list item the open item, with what is open inside."""
        if self.blocks:
            ends = ("p", tag) if tag in ("li", "dt", "dd", "tr") else ("p",)
            if self.stack[self.blocks[-1]][0] in ends:
                self._cut(self.blocks[-1])

    def _hidden(self, tag, attrs, article):
        if tag == "header" and not article:
            return True
        for name, value in attrs:
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                return True
            if name == "style" and value and HIDDEN.search(value):
                return True
        return False

    def _names(self, tag, attrs, article) -> Names:
        """Names of the element that are one of the words or hold one."""
        if tag in ("html", "body", "main"):
            return frozenset()
        within = article and bool(self.open["article"])
        found = {FORM} if tag == "form" else set()
        for name, value in attrs:
            if name in ("class", "id", "role") and value:
                for own in value.lower().split():
                    held = OUT_WORDS.intersection(WORD.findall(own))
                    if tag == "article":
                        # The text's own element may be named for what it is about.
                        held = held & COMMENTS if within else COMMENTS & {own}
                        if within and own in OUT_WORDS:
                            held |= {own}
                    if held:
                        found.add(own)
        return frozenset(found)

    def handle_endtag(self, tag):
        if not self.state().out:
            if tag in BLOCKS:
                self.flush()
            self.tags += 1
        if not self.open[tag]:
            return
        at = self.open[tag][-1]
        # An inline tag closes nothing outside its container.
        if tag in BLOCKS or not self.containers or self.containers[-1] <= at:
            self._cut(at)

    def handle_data(self, data):
        place = self.state()
        if not place.out:
            self.parts.append((data, 0 if place.link else len(data), place))


def smoothed(values: np.ndarray) -> np.ndarray:
    """Gaussian mean of neighbouring values; the edges weigh only what is there."""
    reach = int(3 * SPREAD)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / SPREAD) ** 2)

    def spread(x):
        return np.convolve(x, kernel)[reach:-reach]

    return spread(values) / spread(np.ones(len(values)))


def usual(ratios: np.ndarray) -> float:
    """Median or geometric mean, whichever is less: a few very long lines hardly move it."""
    return min(float(np.median(ratios)), float(np.exp(np.log(ratios).mean())))


class Wrappers:
    """Names that stand for wrappers and not for what is left out."""

    def __init__(self):
        self.names: set[str] = set()

    def excused(self, names: Names) -> bool:
        """An element with a wrapper's name, and with no word beside the wrapper's."""
        known = names & self.names
        return bool(known) and words(names) <= words(known)

    def free(self, places: frozenset[Names]) -> bool:
        return all(self.excused(names) for names in places)


def commented(places: frozenset[Names]) -> bool:
    return any(not COMMENTS.isdisjoint(words(names)) for names in places)


def above(letters: np.ndarray, tags: np.ndarray) -> np.ndarray:
    """Lines whose smoothed ratio of letters to tags reaches the threshold; lines without letters never do."""
    ratio = smoothed(letters / (1 + tags))
    some = (letters > 0) & (ratio > 0)
    return some & (ratio >= SHARE * usual(ratio[some])) if some.any() else some


def main_place(line: Line) -> Place:
    """Where most of the line stands: marked spans inside a paragraph are a part of it."""
    return max(line.parts, key=lambda part: (len(part[0].strip()), -len(part[2].inside)))[2]


def article_wrappers(lines: list[Line], wrappers: Wrappers) -> set[int]:
    """Articles to read; the names around them are those of wrappers."""
    around: dict[int, frozenset[Names]] = {}
    held: dict[int, int] = defaultdict(int)
    for line in lines:
        place = main_place(line)
        if place.article and not commented(place.around):
            around[place.article] = place.around
            held[place.article] += sum(n for _, n, p in line.parts if not p.inside)
    if around and all(around.values()):
        wrappers.names |= {name for names in around[max(around, key=lambda a: (held[a], -a))] for name in names}
    return {a for a, names in around.items() if wrappers.free(names)}


def text_wrappers(lines: list[Line], places: list[Place], wrappers: Wrappers) -> None:
    """If hardly any unnamed line reaches the threshold, the elements with the most text are wrappers."""
    letters = np.array([sum(n for _, n, _ in line.parts) for line in lines], float)
    usable = np.array([not commented(p.inside) for p in places], bool)
    reached = above(letters * usable, np.array([line.tags for line in lines]))
    free = np.array([wrappers.free(p.inside) for p in places], bool)
    unnamed = letters[reached & free].sum()
    if unnamed >= LETTERS or unnamed > TOLD * letters[reached].sum() or not reached.any():
        return
    held: dict[frozenset[Names], list[int]] = {}
    for place, n, ok in zip(places, letters, reached & ~free):
        if ok and not any(name in OUT_WORDS for names in place.inside for name in names):
            own = held.setdefault(place.inside, [0, 0])
            own[0] += int(n)
            own[1] += 1
    held = {k: v for k, v in held.items() if v[1] >= LINES or v[0] >= LETTERS}
    if held:
        most = max(held, key=held.get)
        # What is named once more inside a wrapper that has text of its own is left out.
        most = min((k for k in held if k <= most), key=len)
        wrappers.names |= {name for names in most for name in names}


def main_text(html: str) -> str:
    """Blocks of the main text in page order, one a line."""
    if not html:
        return ""
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser.flush()
    wrappers = Wrappers()
    lines = parser.lines
    articles = article_wrappers(lines, wrappers)
    places = [main_place(line) for line in lines]
    chosen = [i for i, p in enumerate(places) if p.article in articles] if articles else list(range(len(lines)))
    # What stands around the only articles there are, all of them comments, is no text either.
    if not chosen:
        return ""
    text_wrappers([lines[i] for i in chosen], [places[i] for i in chosen], wrappers)
    wanted = set(chosen)
    texts, letters = [], np.zeros(len(lines))
    for i, line in enumerate(lines):
        parts = [p for p in line.parts if i in wanted and wrappers.free(p[2].inside) and (articles or wrappers.free(p[2].around))]
        texts.append(" ".join("".join(p[0] for p in parts).split()))
        letters[i] = min(len(texts[i]), sum(p[1] for p in parts))
    open_ = np.array([bool(t) for t in texts], bool)
    if not open_.any():
        return ""
    reached = above(letters, np.array([line.tags for line in lines]))
    if not reached.any():
        reached = open_
    region, article = np.array([p.container for p in places]), np.array([p.article for p in places])
    taken = open_ & (article > 0) & np.isin(article, article[reached])
    at = np.flatnonzero(reached & open_ & (article == 0))
    first = np.full(int(region.max()) + 1, len(lines))
    last = np.full(int(region.max()) + 1, -1)
    np.minimum.at(first, region[at], at)
    np.maximum.at(last, region[at], at)
    here = np.arange(len(lines))
    taken |= open_ & (article == 0) & (here >= first[region]) & (here <= last[region])
    return "\n".join(text for text, keep in zip(texts, taken) if keep)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """key, url, text and n_chars of each page."""
    kinds = [pages.schema[c].dataType.simpleString() for c in (key, url)]

    def work():
        def step(batch):
            texts = [main_text(x) for x in strings(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["key", "url", "text"])

        return step

    found = map_text(pages, work, f"key {kinds[0]}, url {kinds[1]}, text string", [key, url, html])
    return found.select(F.col("key").alias(key), F.col("url").alias(url), "text", F.length("text").cast("long").alias("n_chars"))
