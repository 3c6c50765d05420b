"""Main text of web pages: parser events, text-to-tag ratios, Gaussian smoothing and threshold clustering."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from retort.llm.common import carried, read, released

# Fixed values of HTML.
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements whose text isn't the article's, whatever it says.
DROPPED = frozenset(
    "annotation annotation-xml audio button canvas datalist dialog embed footer frameset head iframe input label legend map menu nav noembed noframes"
    " noscript object optgroup option progress script search select style svg template textarea title video".split()
)
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar tooltip".split())
#: Elements, and parts of a class or id, that hint at what a container holds. They count unless it holds the article.
HINTED = frozenset("aside form header".split())
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising banner breadcrumb breadcrumbs byline-share consent cookie cookies disclaimer"
    " dropdown feedback foot footer footnav gdpr header login masthead menu menubar modal nav navbar navigation newsletter notice notices notification"
    " outbrain overlay pager pagination paywall popup promo promos promotion recommendations recommended register share sharing sidebar"
    " sidenav signup skip social sponsor sponsored sponsors subscribe subscription taboola teaser teasers toolbar topbar widget widgets".split()
)
#: The same for reader comments.
COMMENTS = frozenset("comment comments commentlist disqus reader-comments remarks replies reply respond responses".split())
#: Words that name a part of an article as well, at least together with others.
DOUBTFUL = frozenset("disclaimer feedback foot header login notice notices overlay register remarks replies reply respond responses share skip social widget widgets".split())
#: A title stands in these, inside of an article.
TITLES = frozenset("header masthead".split())
#: Ids of these are slugs of their words.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Words that tell of other pages only together with one of the second kind, or alone.
OTHERS, WITH_OTHERS = frozenset(["related", "discussion"]), frozenset("articles box content forum items links list news pages posts reading stories thread topics".split())
#: With these, a class says what a container has or lacks beside its text.
QUALIFIERS = frozenset("has with no without free".split())
#: A start tag of these ends an open p (or li, dd, dt, tr, td, th, option, as listed).
CLOSES = {
    "li": {"li"},
    "dd": {"dd", "dt"},
    "dt": {"dd", "dt"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
SCOPE = frozenset("ul ol table dl article section div main aside nav header footer form body select".split())
ROOTS = frozenset(["article", "main"])
#: Containers that may be the region of the content; other blocks are parts of a text.
REGIONS = frozenset("article body center div html main section table".split())
SPACE = re.compile(r"\s+")
RAW = frozenset(["script", "style"])
_PART = re.compile(r"[^a-z0-9]+")


def hidden(attrs: dict[str, str | None]) -> bool:
    """Whether an element isn't shown, or has a role that no article has."""
    if "hidden" in attrs or (attrs.get("aria-hidden") or "").strip().lower() == "true" or "display:none" in SPACE.sub("", attrs.get("style") or "").lower():
        return True
    return (attrs.get("role") or "").strip().lower() in ROLES


def hint(tag: str, attrs: dict[str, str | None], inside: bool = False) -> tuple[int, bool]:
    """(what an element's class and id hint at: 2 reader comments, 1 something else beside an article, 0 nothing; whether
    the hint is weak). inside: whether the element lies in an article or main element.

    A class that is or begins with a plain word for such a part is a strong hint; an id of a section, a word that has
    other meanings or one at the end of a compound is a weak one. Headings have no hints, and paragraphs and inline
    elements only by a class of one word.
    """
    found, weak = 0, True
    if tag in HEADINGS:
        return 0, False
    block = tag in BLOCKS and tag != "p"
    for name in ("class", "id") if block else ("class",):
        for token in (attrs.get(name) or "").lower().split():
            parts = [p for p in _PART.split(re.sub(r"(?<=[a-z])\d+$", "", token)) if p]
            if QUALIFIERS.intersection(parts) and token not in MARKS or not parts:
                continue
            if inside and TITLES.intersection(parts) or not block and len(parts) > 1:
                continue
            others = name == "class" and parts[0] in OTHERS and WITH_OTHERS.issuperset(parts[1:])
            kind = 2 if COMMENTS.intersection((token, *parts)) else 1 if others or MARKS.intersection((token, *parts)) else 0
            if not kind:
                continue
            plain = others or token in MARKS | COMMENTS or parts[0] in MARKS | COMMENTS
            doubtful = len(parts) > 1 and parts[0] in DOUBTFUL or name == "id" and (tag == "section" or parts[0] in DOUBTFUL)
            found, weak = max(found, kind), weak and not (plain and not doubtful)
    return found, weak and found > 0


class Lines(HTMLParser):
    """The blocks of a page as (text, tags, container, link characters, hint), from the events of one streaming pass.

    Containers and hints are numbered as they open, each with the one it lies in, so that sums over them need one pass
    from the last to the first. Work for an event doesn't depend on the depth: a block keeps count of the inline elements
    open in it, and scans stop at it.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool, int, int]] = []  # tag, dropped from here on, number of the container, of the hint
        self.blocks: list[int] = []  # places of the blocks in the stack
        self.inline: list[Counter] = [Counter()]  # open inline elements of each of these, and outside of all
        self.open: Counter = Counter()
        self.parents: list[int] = [-1]
        self.kinds: list[str] = [""]
        self.hints: list[tuple[int, int, int, bool]] = [(-1, 0, 0, False)]  # the hint around it, its kind, the container it begins at, weak inside an article
        self.lines: list[tuple[str, int, int, int, int]] = []
        self.text: list[str] = []
        self.tags = self.linked = self.links = 0
        self.place = self.hint = 0
        self.dropped = False

    def flush(self) -> None:
        text = SPACE.sub(" ", "".join(self.text)).strip()
        if text:
            self.lines.append((text, self.tags, self.place, self.linked, self.hint))
            self.tags = 0
        self.text, self.linked = [], 0

    def settle(self) -> None:
        self.dropped, self.place, self.hint = self.stack[-1][1:] if self.stack else (False, 0, 0)

    def close_to(self, depth: int) -> None:
        for at in range(len(self.stack) - 1, depth - 1, -1):
            tag = self.stack[at][0]
            self.links -= tag == "a"
            self.open[tag] -= 1
            if self.blocks and self.blocks[-1] == at:
                self.blocks.pop()
                self.inline.pop()
            else:
                self.inline[-1][tag] -= 1
        del self.stack[depth:]
        self.settle()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        block = tag in BLOCKS
        if block:
            if not self.dropped:
                self.flush()
            if not self.dropped and self.blocks and self.stack[self.blocks[-1]][0] == "p":
                self.close_to(self.blocks[-1])
            if ends := CLOSES.get(tag):
                for depth in reversed(self.blocks):
                    if self.stack[depth][0] in ends:
                        self.close_to(depth)
                        break
                    if self.stack[depth][0] in SCOPE:
                        break
        if tag == "br":
            self.text.append(" ")
        if tag in VOID:
            return
        known = dict(attrs)
        inside = self.open["article"] + self.open["main"] > 0
        kind, weak = (0, False) if tag in ("html", "body") else hint(tag, known, inside)
        if not kind and tag in HINTED:
            kind = 1
        root = tag in ROOTS and not self.dropped
        out = self.dropped or tag in DROPPED or tag not in ("html", "body") and not root and hidden(known)
        if tag == "header" and kind == 1 and inside:
            kind = 0  # the article's own: its title
        if root and kind == 1:
            kind = 0
        if kind and not block:
            out = True
        place, mark = self.place, self.hint
        if tag in REGIONS:
            self.parents.append(self.place)
            self.kinds.append("main" if (known.get("role") or "").lower() == "main" else tag)
            place = len(self.parents) - 1
        if kind and block and not out:
            self.hints.append((self.hint, kind, place, weak and inside))
            mark = len(self.hints) - 1
        self.stack.append((tag, out, place, mark))
        self.open[tag] += 1
        if block:
            self.blocks.append(len(self.stack) - 1)
            self.inline.append(Counter())
        else:
            self.inline[-1][tag] += 1
        self.links += tag == "a"
        self.settle()

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID or tag in ("path", "circle", "rect", "use", "g"):
            if tag in VOID:
                self.handle_starttag(tag, attrs)
        else:  # as browsers do: the slash means nothing
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCKS:
            if self.open[tag] > 0:
                at = next(depth for depth in reversed(self.blocks) if self.stack[depth][0] == tag)
                if not self.dropped:
                    self.flush()
                self.close_to(at)
            elif tag == "p" and not self.dropped:
                self.flush()
        elif self.inline[-1][tag] > 0:
            self.close_to(next(depth for depth in range(len(self.stack) - 1, -1, -1) if self.stack[depth][0] == tag))

    def handle_data(self, data: str) -> None:
        if self.dropped:
            return
        self.text.append(data)
        if self.links:
            self.linked += len(data)

    def close(self) -> None:
        super().close()
        self.flush()


def sums_inside(parents: list[int], values: list[float]) -> list[float]:
    """Each container's value with those of all containers inside it; one opens after the one that it lies in."""
    out = list(values)
    for at in range(len(out) - 1, 0, -1):
        out[parents[at]] += out[at]
    return out


def in_force(parser: Lines, sigma: float = 1.0) -> list[bool]:
    """Of each hint, whether what it marks is left out: not where it, or one around it that isn't in force either,
    wraps the article, that is an article or main element, or without any such on the page half of its text; and not
    where it is a weak one inside of an article with a line whose smoothed text-to-tag ratio, or length, is at least half of what content has."""
    around = [h[0] for h in parser.hints]
    mass, roots, content = [0.0] * len(around), [0.0] * len(around), [0.0] * len(around)
    if parser.lines and any(h[3] for h in parser.hints):
        chars, plain = np.array([len(x[0]) for x in parser.lines]), np.array([max(0.0, len(x[0]) - x[3]) for x in parser.lines])
        ratios = smoothed(plain / np.array([max(1, x[1]) for x in parser.lines]), sigma)
        # Where all is content the clusters part like from like, so half of a threshold is enough.
        wanted = ((2 * ratios >= content_threshold(ratios)) | (2 * plain >= content_threshold(plain))) & (plain > 0.3 * chars)
        for x, core in zip(parser.lines, wanted, strict=True):
            content[x[4]] += core
        content = sums_inside(around, content)
    has_root = [0.0] * len(parser.parents)
    for x in parser.lines:
        mass[x[4]] += max(0, len(x[0]) - x[3])
    for at, kind in enumerate(parser.kinds):
        has_root[at] = float(kind in ROOTS)
    has_root = sums_inside(parser.parents, has_root)
    mass = sums_inside(around, mass)
    for at, (_, kind, place, _) in enumerate(parser.hints):
        roots[at] = has_root[place] if kind else 0.0
    out = [False] * len(around)
    anywhere = any(k in ROOTS for k in parser.kinds)
    for at in range(1, len(around)):
        _, kind, place, weak = parser.hints[at]
        wraps = roots[at] > 0 and parser.kinds[place] not in ROOTS and kind == 1 if anywhere else kind == 1 and mass[at] >= 0.5 * max(1.0, mass[0])
        out[at] = out[around[at]] or not (wraps or weak and content[at] > 0)
    return out


def smoothed(ratios: np.ndarray, sigma: float = 1.0) -> np.ndarray:
    """Gaussian smoothing, the ends weighted by what is there."""
    reach = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    whole = np.convolve(np.ones(len(ratios)), kernel)[reach:-reach]
    return np.convolve(ratios, kernel)[reach:-reach] / whole


def content_threshold(values: np.ndarray) -> float:
    """Between two clusters of values, found by two-means from the extremes; content lies above it."""
    low, high = float(values.min()), float(values.max())
    for _ in range(50):
        middle = (low + high) / 2
        below, above = values[values <= middle], values[values > middle]
        if not len(above) or not len(below):
            break
        a, b = float(below.mean()), float(above.mean())
        if (a, b) == (low, high):
            break
        low, high = a, b
    return min((low + high) / 2, float(values.mean()))


def main_text(page: str | None, sigma: float = 1.0) -> str:
    """The article of a page: its blocks joined by blank lines.

    Text of dropped elements (menus, footers, scripts and the like) goes, and so do blocks of containers whose class,
    id or element hints at a sidebar, a notice, an advert, a form or comments, unless that container wraps the article.
    The others' text-to-tag ratios are smoothed and split into two clusters; the region that holds most of the upper
    cluster's text, an article or main element or else the smallest container of all of it but blocks of links, is
    given but for blocks of links below the threshold, so that a short paragraph of the article stays. A null or empty
    page, or one without text, gives "". Time grows with the page's length, not with its depth.
    """
    if not page:
        return ""
    parser = Lines()
    parser.feed(page)
    parser.close()
    left_out = in_force(parser, sigma)
    lines = [x for x in parser.lines if not left_out[x[4]]]
    if not lines:
        return ""
    chars = np.array([len(x[0]) for x in lines], dtype=np.float64)
    linked = np.minimum(chars, [x[3] for x in lines])
    plain = chars - linked
    place = np.array([x[2] for x in lines])
    ratios = smoothed(plain / np.maximum(1, np.array([x[1] for x in lines])), sigma)
    core = ratios >= content_threshold(ratios)
    parents, count = parser.parents, len(parser.parents)
    inside = lambda values: np.array(sums_inside(parents, np.bincount(place, weights=values, minlength=count).tolist()))
    mass = inside(np.where(core, plain, 0.0))
    total = mass[0]
    roots = [p for p in range(count) if parser.kinds[p] in ROOTS and mass[p] > 0 and mass[p] >= 0.4 * total]
    chosen = np.zeros(count, dtype=bool)
    if roots:
        top = max(mass[p] for p in roots)
        best = max(roots, key=lambda p: (mass[p] >= 0.9 * top, parser.kinds[p] == "article", p))
        for p in range(count):
            chosen[p] = p == best or parser.kinds[p] == parser.kinds[best] and parents[p] == parents[best] and mass[p] >= 0.5 * mass[best]
    else:
        # Blocks of links are dropped below. Long blocks whose ratio the tags of their containers lower are the article's
        # as those of the core are. The region is the innermost container of all of these.
        wanted = (core | (plain >= content_threshold(plain))) & (plain > 0.3 * chars)
        need = inside(wanted.astype(np.float64))
        chosen[int(np.flatnonzero(need == need[0])[-1]) if need[0] else 0] = True
    for p in range(1, count):
        chosen[p] |= chosen[parents[p]]
    # The line ratios decide once more inside: what lies below the threshold goes if it, or its container, is mostly links.
    of_links = inside(linked) >= 0.7 * np.maximum(1.0, inside(chars))
    links = (linked >= 0.7 * chars) & (of_links[place] | ~(chosen[place] & bool(roots)))
    return "\n\n".join(lines[i][0] for i in np.flatnonzero(chosen[place] & (core | ~links)).tolist())


def extract(pages: DataFrame, html_column: str = "html", *keep: str) -> DataFrame:
    """The kept columns and `text` of every page, as `main_text` gives it: "" for null and empty pages, very long ones
    whole. Repeated rows give repeated results, an empty table an empty one; other columns are ignored."""
    rows, name, kept, schema = carried(pages, keep, html_column, "text string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                texts = pa.array([main_text(p) for p in part.column(name).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in kept), texts], names=[*kept, "text"])

    return rows.mapInArrow(run, schema)


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(read(spark, sf_dir, "pages", "page_id", "url", "html"), "html", "page_id", "url")
    return found.selectExpr("page_id", "url", "text", "cast(char_length(text) as long) as n_chars")
