"""Main text of web pages by text density.

A streaming parser turns a page into lines, one per block element.  Each line
has its text, the length of the text outside links and the tags that belong to
it; the ratio of the two, smoothed with a Gaussian over neighbouring lines, is
high where the article is.  A threshold that splits the smoothed ratios into two
clusters selects the lines.

Text inside elements that never hold an article (scripts, forms, menus, headers
and footers of the page, by element or role) makes no line.  Elements that a word
of class or id names as something else (notices, adverts, comments) are left out
where they hold at most half of the page's text outside links: a wrapper of the
article may have such a word in its class too.  One that is named as nothing else
(``comments``, ``cookie-notice``) is left out whatever it holds, if the page marks
an article outside it.  One that is left open ends where an article begins.

Where a page marks its article (``article``, ``main``, role ``main``) and the
marked lines hold at least half of the text outside links that is left, they are
the clusters' content side, however short they are.  Elsewhere the ratio decides,
and that of a marked line counts twice.

Null and empty pages, and pages without text, give an empty text.  Broken markup
is read as the parser finds it.  Rows are independent.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Elements of HTML by their part in a page.
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main nav ol option p pre section summary table tbody "
    "td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset(
    "aside button canvas dialog footer form head iframe label menu nav noscript object script select style svg "
    "template textarea title video audio".split()
)
SKIPPED_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split()
)
# Words of class and id that name what is not the article.
SKIPPED_NAMES = frozenset(
    "ad ads adv advert advertisement adverts banner breadcrumb breadcrumbs byline comment comments consent cookie "
    "cookies disqus footer gdpr header login menu modal nav navbar navigation newsletter notice notices pagination "
    "pager popup promo promoted recommended related reply replies search share sharing sidebar signup social sponsor "
    "sponsored subscribe toolbar widget".split()
)
# Elements that a skipping name does not skip: they hold the whole page.
_WHOLE = frozenset(["html", "body", "article", "main"])
#: Clusters of lines are two where one is this many times denser than the other.
APART = 3.0
_NAME_PARTS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
_BLANK = re.compile(r"\s+")


@dataclass(eq=False)
class Named:
    """An element whose class or id has a skipping name."""

    tag: str
    wholly: bool  # all words of class and id are such names
    tags_before: int = 0
    place: int = 0  # among the open named elements
    around: Named | None = None  # the next one outside
    level: int = 0  # open elements of its tag when it began, and itself
    closed: bool = False
    # Of the lines directly inside, then of all: text outside links, marked lines.
    size: int = 0
    marked: int = 0
    late_size: int = 0
    late_marked: int = 0
    out: int = -1  # place of the innermost element to leave out, this or one around it
    closed_out: bool = False  # this or one around it is closed and to leave out


@dataclass
class Line:
    """A block of text with its share of the markup.

    The named elements around it are ``inner`` and those around that; in the first ``late`` of
    them, of which ``outer`` is the innermost, an article began before.
    """

    text: list[str] = field(default_factory=list)
    tags: int = 0
    linked: int = 0
    marked: bool = False
    inner: Named | None = None
    outer: Named | None = None
    late: int = 0


class _Events(HTMLParser):
    """Collects the lines of one page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = [Line()]
        self.skipping: str | None = None
        self.depth = 0  # of same-named elements inside the skipped one
        self.marks: list[str] = []
        self.links = 0
        self.named: list[Named] = []  # those that are open
        self.seen: list[Named] = []  # all, in the order of their start
        self.late = 0  # open named elements, outermost first, in which an article began
        self.levels: dict[str, int] = defaultdict(int)  # open elements of a tag
        self.open: dict[str, list[Named]] = defaultdict(list)  # open named elements of a tag

    def _new_line(self) -> None:
        if self.lines[-1].text:
            self._add_line()
        self.lines[-1].marked = bool(self.marks)

    def _add_line(self, tags: int = 0) -> None:
        inner = self.named[-1] if self.named else None
        outer = self.named[self.late - 1] if self.late else None
        self.lines.append(Line([], tags, 0, bool(self.marks), inner, outer, self.late))

    def _enter(self, element: Named) -> None:
        element.tags_before = self.lines[-1].tags
        element.place = len(self.named)
        element.around = self.named[-1] if self.named else None
        element.level = self.levels[element.tag]
        self.named.append(element)
        self.seen.append(element)
        self.open[element.tag].append(element)

    def _leave(self, place: int) -> None:
        """The open named elements from ``place`` on end here."""
        tags = self.named[place].tags_before
        while len(self.named) > place:
            self.open[self.named.pop().tag].pop()
        self.late = min(self.late, place)
        self._add_line(tags)

    def _skips(self, tag: str, attrs: dict[str, str]) -> bool:
        if tag in SKIPPED:
            return True
        if tag == "header":
            # The header of an article has its title.
            return not self.marks
        if attrs:
            if "hidden" in attrs or attrs.get("aria-hidden") == "true" or attrs.get("role") in SKIPPED_ROLES:
                return tag not in _WHOLE
            if "style" in attrs and _HIDDEN.search(attrs["style"]):
                return tag not in _WHOLE
        return False

    def _named(self, tag: str, attrs: dict[str, str]) -> Named | None:
        names = f"{attrs.get('class', '')} {attrs.get('id', '')}"
        if len(names) > 1 and tag not in _WHOLE:
            parts = _NAME_PARTS.findall(_CAMEL.sub(" ", names).lower())
            if not SKIPPED_NAMES.isdisjoint(parts):
                return Named(tag, SKIPPED_NAMES.issuperset(parts))
        return None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.skipping:
            # An article never is part of an element that was left open.
            if tag in ("article", "main") and self.skipping not in ("script", "style", "template"):
                self.skipping = None
            else:
                self.depth += tag == self.skipping
                return
        found = {name: value or "" for name, value in attrs}
        if tag not in VOID and self._skips(tag, found):
            self.skipping, self.depth = tag, 1
            self._new_line()
            return
        if tag not in VOID:
            self.levels[tag] += 1
            if found and (element := self._named(tag, found)):
                self._new_line()
                self._enter(element)
                self._add_line()
        if tag in BLOCKS:
            self._new_line()
            if self.named and tag in ("article", "main"):
                self.late = len(self.named)
                self._add_line()
            if tag in ("article", "main") or found.get("role") == "main":
                self.marks.append(tag)
                self.lines[-1].marked = True
        elif tag == "a":
            self.links += 1
        self.lines[-1].tags += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if self.skipping:
            if tag == self.skipping:
                self.depth -= 1
                if not self.depth:
                    self.skipping = None
            elif tag in ("body", "html"):
                self.skipping = None
            return
        if tag in BLOCKS:
            if self.marks and self.marks[-1] == tag:
                self._new_line()
                self.marks.pop()
            self._new_line()
        elif tag == "a" and self.links:
            self.links -= 1
        self.lines[-1].tags += 1
        self.levels[tag] -= 1
        # Of the open named elements of a tag, only the last can end.
        if self.open[tag] and self.levels[tag] < self.open[tag][-1].level:
            element = self.open[tag][-1]
            element.closed = True
            self._leave(element.place)
        elif self.named and tag in ("body", "html"):
            self._leave(0)

    def handle_data(self, data: str) -> None:
        if self.skipping:
            return
        line = self.lines[-1]
        line.text.append(data)
        if self.links:
            line.linked += len(data)


def _left_out(element: Named, total: int, marked: int) -> bool:
    """Whether a named element is not of the article, by its part of the page's text and marked lines."""
    return 2 * element.size <= total or (element.wholly and element.marked < marked)


def _judge(seen: list[Named], total: int, marked: int) -> None:
    """Sums the lines inside each named element, then says which of them to leave out.

    A line that came after an article began in an element is inside it only if the element was
    closed: one that was left open ends at the article.
    """
    for element in reversed(seen):
        if element.around:
            element.around.size += element.size
            element.around.marked += element.marked
            element.around.late_size += element.late_size
            element.around.late_marked += element.late_marked
        if element.closed:
            element.size += element.late_size
            element.marked += element.late_marked
    for element in seen:
        left_out = _left_out(element, total, marked)
        around = element.around
        element.out = element.place if left_out else around.out if around else -1
        element.closed_out = (left_out and element.closed) or (around is not None and around.closed_out)


def _inside_left_out(line: Line) -> bool:
    return (line.inner is not None and line.inner.out >= line.late) or (
        line.outer is not None and line.outer.closed_out
    )


def lines_of(html: str) -> list[tuple[str, int, int, bool]]:
    """Text, linked characters, tags and mark of each line with text."""
    events = _Events()
    events.feed(html)
    events.close()
    found, total, marked = [], 0, 0
    for line in events.lines:
        text = _BLANK.sub(" ", "".join(line.text)).strip()
        if text:
            own = max(len(text) - line.linked, 0)
            total += own
            marked += line.marked
            if line.inner:
                line.inner.size += own
                line.inner.marked += line.marked
            if line.outer:
                # Inside the outer elements only if these were closed.
                line.outer.size -= own
                line.outer.marked -= line.marked
                line.outer.late_size += own
                line.outer.late_marked += line.marked
            found.append((text, line))
    _judge(events.seen, total, marked)
    return [(text, line.linked, line.tags, line.marked) for text, line in found if not _inside_left_out(line)]


def density_clusters(values: np.ndarray) -> tuple[float, float]:
    """The centers of the two clusters of values (two means in one dimension)."""
    low, high = float(values.min()), float(values.max())
    for _ in range(20):
        border = (low + high) / 2
        upper = values > border
        if not upper.any() or upper.all():
            break
        low, high = float(values[~upper].mean()), float(values[upper].mean())
    return low, high


def main_text(html: str, sigma: float = 1.0) -> str:
    """The blocks of the article, joined by one space."""
    lines = lines_of(html)
    if not lines:
        return ""
    sizes = np.array([max(len(text) - linked, 0) for text, linked, _, _ in lines])
    marks = np.array([marked for *_, marked in lines])
    if marks.any() and 2 * sizes[marks].sum() >= sizes.sum():
        return " ".join(text for text, _, _, marked in lines if marked)
    ratios = sizes * np.where(marks, 2, 1) / np.array([max(tags, 1) for _, _, tags, _ in lines])
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    padded = np.pad(ratios, reach, mode="edge")
    smooth = np.convolve(padded, kernel / kernel.sum(), mode="valid")
    low, high = density_clusters(smooth)
    if high <= APART * low + 1e-9:
        # One cluster: the lines are alike.
        keep = np.ones(len(lines), bool)
    else:
        keep = smooth >= min((low + high) / 2, ratios.mean())
        # A short line between two of the article belongs to it.
        keep[1:-1] |= keep[:-2] & keep[2:]
    keep &= np.array([2 * linked <= len(text) for text, linked, _, _ in lines])
    return " ".join(text for (text, *_), wanted in zip(lines, keep) if wanted)


def extract_main_text(
    pages: DataFrame, keep_cols: tuple[str, ...] = ("page_id", "url"), html_col: str = "html", sigma: float = 1.0
) -> DataFrame:
    """``keep_cols``, ``text`` and its ``n_chars`` for every page."""
    n = len(keep_cols)
    schema = T.StructType(
        [*(pages.schema[name] for name in keep_cols), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html or "", sigma) for html in batch.column(n).to_pylist()]
            lengths = pa.array([len(text) for text in texts], pa.int64())
            kept = [batch.column(i) for i in range(n)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string()), lengths], schema.names)

    return pages.select(*keep_cols, html_col).mapInArrow(run, schema)
