"""HTML extraction (1): flat text blocks, kept or not by a decision tree over shallow features.

A page is cut at block tags into flat blocks of text. Each is described by its word count, link density and text
density, by words and links of two neighbours on each side, by its place in the page and its length next to the
longest block, by whether it is a heading, and by one weak hint: what the nearest named element around it
is named for. A small decision tree, trained on the labelled pages of :mod:`nestweave.llm.html_labelled`, says
which blocks are text. No tree of elements is built: open containers are a stack, and broken or cut-off
markup only shortens it. Reading takes time in proportion to the page, however broken it is.

Defined results: a null html gives an empty text; markup without text gives an empty text; text
after a cut-off tag or an unfinished comment is not text; a quote that is never closed ends at the next ``>``; pages
of any length and depth are read whole; rows that repeat a ``page_id`` are extracted one by one; a leaf with as many
kept as dropped blocks keeps; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestweave.llm.html_labelled import Page, labelled_pages

#: Elements whose content is never text.
_RAW = set("script style noscript template svg math iframe object canvas textarea select button title audio video".split())
_ENDS = {name: re.compile(rf"</{name}\s*>", re.IGNORECASE) for name in _RAW}
_NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
_UNQUOTED = re.compile(r"[^>\"']*")
_NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_PART = re.compile(r"[a-z]+")

_INLINE = set("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rt s samp small span strike strong sub sup time tt u var wbr".split())
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: Elements that end where the next of them begins.
_ITEMS = set("p li dt dd tr td th option".split())
_OUTSIDE = set("nav footer aside form menu dialog".split())
_INSIDE = set("article main".split())
#: Beginnings and whole parts of class, id and role names of what surrounds an article, and parts of those of articles.
_OUTSIDE_STARTS = tuple(
    "advert sponsor promo banner nav menu breadcrumb sidebar footer comment repl disqus cookie consent popup modal overlay "
    "newsletter subscri signup login shar social relat recommend widget paginat pager copyright disclaimer toolbar contentinfo complementary".split()
)
_OUTSIDE_ENDS = ("footer", "sidebar", "comments", "navbar", "nav", "menu", "banner")
_OUTSIDE_PARTS = set("ad ads notice alert tags search".split())
_INSIDE_PARTS = set("article content post entry story main body text".split())
#: Parts that make a name one of a state or a subject and not of a container.
_QUALIFIERS = set("has with without no not is js off on hide show category tag type layout page theme".split())


@dataclass
class Block:
    text: str
    words: int
    link_words: int
    heading: bool
    place: int
    chars: int = 0

    @property
    def links(self) -> float:
        return self.link_words / self.words


def _hint(name: str, attributes: str) -> int:
    """What an element is named for: 1 an article, -1 what surrounds one, 0 neither."""
    if name in ("html", "body"):
        return 0
    inside = outside = whole = False
    for kind, *values in _NAMED.findall(attributes):
        for token in "".join(values).lower().split():
            parts = _PART.findall(token)
            if not parts or (len(parts) > 1 and (parts[0] in _QUALIFIERS or parts[-1] in _QUALIFIERS)):
                continue
            around = any(p in _OUTSIDE_PARTS or p.startswith(_OUTSIDE_STARTS) or p.endswith(_OUTSIDE_ENDS) for p in parts)
            outside |= around
            inside |= not around and any(p in _INSIDE_PARTS for p in parts)
            whole |= not around and (kind.lower() == "id" or len(parts) == 1) and parts[0] in _INSIDE_PARTS
            if name in _INSIDE and parts[0].startswith(("comment", "repl")):
                return -1
    if name in _INSIDE:
        return 1
    if name in _OUTSIDE:
        return -1
    if outside and not whole:
        return -1
    return 1 if inside else 0


@dataclass
class _Reader:
    """The open containers and the block that is being read."""

    #: Name of every open element, and the hint of the nearest named one up to it.
    stack: list[tuple[str, int]] = field(default_factory=list)
    open_names: Counter = field(default_factory=Counter)
    pieces: list[tuple[str, bool]] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)
    anchors: int = 0
    heading: bool = False

    def flush(self) -> None:
        # References may stand across no tag, so a piece is decoded as it was written, once.
        decoded = [(html.unescape(x), linked) for x, linked in self.pieces]
        self.pieces = []
        words = "".join(x for x, _ in decoded).split()
        if not words:
            return
        linked = len(" ".join(x for x, is_link in decoded if is_link).split())
        place = self.stack[-1][1] if self.stack else 0
        self.blocks.append(Block(" ".join(words), len(words), min(linked, len(words)), self.heading, place, sum(map(len, words))))

    def open(self, name: str, attributes: str) -> None:
        above = self.stack[-1][1] if self.stack else 0
        hint = _hint(name, attributes)
        if name == "header" and above != 1 and not hint:
            hint = -1
        self.stack.append((name, hint or above))
        self.open_names[name] += 1

    def pop(self) -> None:
        self.open_names[self.stack.pop()[0]] -= 1

    def close(self, name: str) -> None:
        if self.open_names[name]:
            while self.stack[-1][0] != name:
                self.pop()
            self.pop()


def tokens(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, name, closing, attributes) of every tag, name empty for what is skipped whole.

    Every character is looked at a bounded number of times: what isn't found from one place on isn't looked for again.
    """
    at, size = 0, len(page)
    absent: set[str] = set()

    def find(what: str, start: int) -> int:
        if what in absent:
            return -1
        found = page.find(what, start)
        if found < 0:
            absent.add(what)
        return found

    while (start := page.find("<", at)) >= 0:
        if page.startswith("<!--", start):
            end = find("-->", start + 4)
            at = end + 3 if end >= 0 else size
            yield start, at, "", False, ""
        elif page.startswith(("<!", "<?"), start):
            end = find(">", start)
            at = end + 1 if end >= 0 else size
            yield start, at, "", False, ""
        elif (tag := _NAME.match(page, start)) is None:
            at = start + 1
        else:
            stop = tag.end()
            while True:
                stop = _UNQUOTED.match(page, stop).end()
                if stop >= size or page[stop] == ">":
                    break
                quote = find(page[stop], stop + 1)
                if quote < 0:  # never closed
                    end = find(">", stop)
                    stop = end if end >= 0 else size
                    break
                stop = quote + 1
            name, closing = tag[1].lower(), page[start + 1] == "/"
            attributes, at = page[tag.end() : stop], min(stop + 1, size)
            if name in _RAW and not closing and not attributes.endswith("/"):
                ended = None if name in absent else _ENDS[name].search(page, at)
                if ended is None:
                    absent.add(name)
                at = ended.end() if ended else size
                yield start, at, "", False, ""
            else:
                yield start, at, name, closing, attributes


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page in order."""
    reader, at, in_head = _Reader(), 0, False
    for start, end, name, closing, attributes in tokens(page):
        if start > at and not in_head:
            reader.pieces.append((page[at:start], reader.anchors > 0))
        at = end
        if not name:
            continue
        if name in ("head", "body"):
            in_head = name == "head" and not closing
        if name in _INLINE:
            if name == "a":
                reader.anchors = 0 if closing else 1
            elif name == "br":
                reader.pieces.append((" ", reader.anchors > 0))
            continue
        reader.flush()
        reader.anchors = 0
        if name in _HEADINGS:
            reader.heading = not closing
        elif name not in _ITEMS:
            reader.heading = False
        if closing:
            reader.close(name)
        elif name not in _VOID:
            if name in _ITEMS:
                while reader.stack and reader.stack[-1][0] in ("p", name):
                    reader.pop()
            reader.open(name, attributes)
    if not in_head:
        reader.pieces.append((page[at:], reader.anchors > 0))
    reader.flush()
    return reader.blocks


#: Neighbours on each side whose words and links are features.
NEAR = 2
FEATURES = (
    "words", "links", "density", *(f"{x}{d:+}" for d in (-2, -1, 1, 2) for x in ("words", "links")), "from_top", "to_longest", "heading", "hint"
)
#: Characters of a line of text, in which density counts words.
_LINE = 80


def features(blocks: list[Block]) -> np.ndarray:
    """One row of FEATURES per block; what is beyond a page's edge counts as blocks of no words and no links."""
    n = len(blocks)
    own = np.array([(b.words, b.links) for b in blocks], dtype=float).reshape(-1, 2)
    edge = np.zeros((NEAR, 2))
    wide = np.concatenate([edge, own, edge])
    near = [wide[NEAR + d : NEAR + d + n] for d in (-2, -1, 1, 2)]
    density = np.array([b.words / max(1, -(-(b.chars + b.words) // _LINE)) for b in blocks]).reshape(-1, 1)
    place = ((np.arange(n) + 0.5) / max(n, 1)).reshape(-1, 1)
    longest = own[:, :1] / max(1.0, own[:, 0].max(initial=1.0))
    flags = np.array([(b.heading, b.place) for b in blocks], dtype=float).reshape(-1, 2)
    return np.concatenate([own, density, *near, place, longest, flags], axis=1)


@dataclass(frozen=True)
class Tree:
    """A leaf's answer, or a split: at most ``threshold`` goes to ``low``."""

    keep: bool
    feature: int = -1
    threshold: float = 0.0
    low: Tree | None = None
    high: Tree | None = None

    def decide(self, rows: np.ndarray) -> np.ndarray:
        if self.low is None:
            return np.full(len(rows), self.keep)
        out = np.empty(len(rows), dtype=bool)
        low = rows[:, self.feature] <= self.threshold
        out[low], out[~low] = self.low.decide(rows[low]), self.high.decide(rows[~low])
        return out


def grow(rows: np.ndarray, keep: np.ndarray, depth: int = 8, least: int = 4) -> Tree:
    """A tree by the Gini impurity; splits leave ``least`` rows or more on both sides."""
    share = keep.mean() if len(keep) else 0.0
    leaf = Tree(bool(share >= 0.5))
    if depth == 0 or share in (0.0, 1.0):
        return leaf
    best, split = share * (1 - share) - 1e-9, None
    for feature in range(rows.shape[1]):
        values = np.unique(rows[:, feature])
        for threshold in (values[1:] + values[:-1]) / 2:
            low = rows[:, feature] <= threshold
            if min(low.sum(), (~low).sum()) >= least:
                a, b, w = keep[low].mean(), keep[~low].mean(), low.mean()
                impurity = w * a * (1 - a) + (1 - w) * b * (1 - b)
                if impurity < best:
                    best, split = impurity, (feature, threshold)
    if split is None:
        return leaf
    low = rows[:, split[0]] <= split[1]
    return Tree(leaf.keep, *split, grow(rows[low], keep[low], depth - 1, least), grow(rows[~low], keep[~low], depth - 1, least))


def labelled_rows(pages: Sequence[Page] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of labelled pages; a part's label holds for all its blocks."""
    rows, keep = [], []
    for page in labelled_pages() if pages is None else pages:
        blocks = blocks_of("".join(f"<div data-part>{part}</div>" if wrap else part for _, part, wrap in page))
        counts = [len(blocks_of(part)) for _, part, _ in page]
        labels = [label for (label, _, _), n in zip(page, counts, strict=True) for _ in range(n)]
        if len(labels) != len(blocks):
            raise AssertionError("the parts of a labelled page do not add up to its blocks")
        rows.append(features(blocks))
        keep += labels
    return np.concatenate(rows), np.array(keep, dtype=bool)


def trained_tree() -> Tree:
    return grow(*labelled_rows())


def extract(page: str, tree: Tree) -> tuple[str, int]:
    """The text of a page, and the number of its blocks."""
    blocks = blocks_of(page)
    if not blocks:
        return "", 0
    kept = tree.decide(features(blocks))
    return "\n\n".join(b.text for b, k in zip(blocks, kept, strict=True) if k), len(blocks)


def extract_pages(pages: DataFrame, tree: Tree | None = None) -> DataFrame:
    """(page_id, url, text, n_chars, n_blocks) of every row of ``pages``."""
    tree = tree or trained_tree()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [extract(x or "", tree) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array([x for x, _ in found], pa.string()),
                    pa.array([len(x) for x, _ in found], pa.int64()),
                    pa.array([n for _, n in found], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars", "n_blocks"],
            )

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long, n_blocks long")
