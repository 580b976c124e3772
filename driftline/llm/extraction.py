"""Main text of web pages: text blocks told apart by a small decision tree."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Elements by their role in a page.
SKIPPED = frozenset("script style head title noscript template iframe svg math object embed canvas form select button textarea dialog".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span strike strong sub sup time tt u var wbr".split()
)
FRAME = frozenset("nav header footer aside menu".split())
ARTICLE = frozenset("article main".split())
# Self-closing by the next of their kind.
LOOSE = frozenset("li dt dd tr td th option".split())
# A paragraph ends where one of these begins.
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main "
    "menu nav ol p pre search section summary table ul".split()
)
# Names that tell a side matter, and those that tell it only if nothing in the name says content.
HINT = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|sponsor\w*|promo\w*|cookies?|consent|gdpr|newsletter|subscri\w*|popup|modal|related|recommend\w*|"
    r"trending|sharing|breadcrumbs?|comments?|reply|replies|respond|disqus|discussion|login|signup|pagination|pager)(?=$|[\s_-])",
    re.I,
)
WEAK_HINT = re.compile(
    r"(?:^|[\s_-])(?:banner|notice|alert|sidebar|side|widget|rail|share|social|menu|nav\w*|header|footer|masthead|copyright|search|tags?)(?=$|[\s_-])", re.I
)
# Names that tell side matter within a line.
LINE_HINT = re.compile(r"(?:^|[\s_-])(?:ad|ads|advert\w*|sponsor\w*)(?=$|[\s_-])", re.I)
CONTENT = re.compile(r"(?:^|[\s_-])(?:article|main|content|post|entry|story|body|text|page)(?=$|[\s_-])", re.I)
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<close>/?)(?P<name>[a-zA-Z][\w:-]*)(?P<rest>(?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*)(?:>|\Z)|(?P<text>[^<]+|<)",
    re.S,
)
MARKS = re.compile(r"(?:\b(?:class|id|role|aria-label)\s*=\s*)(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
# A slash that ends an unquoted value does not close the element.
CLOSED = re.compile(r"(?:^|[\s\"'])/\s*\Z")
NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\s*(?:!\s*important\s*)?(?:;|$)", re.I)


@dataclass
class Block:
    text: str
    words: int
    linked: int
    article: bool
    frame: bool
    hinted: bool
    heading: bool


# How much is left out: nothing; a form, but for an article in it; everything.
KEPT, FORM, LEFT_OUT = 0, 1, 2


def _names(rest: str) -> list[str]:
    return [a or b or c for a, b, c in MARKS.findall(rest)]


def _hinted(rest: str) -> bool:
    names = _names(rest)
    return any(HINT.search(n) or WEAK_HINT.search(n) and not CONTENT.search(n) for n in names)


def _hidden(rest: str) -> bool:
    """Whether the attributes hide their element: `hidden`, aria-hidden="true", or a style of display: none."""
    seen = set()
    for name, a, b, c in ATTRIBUTE.findall(rest):
        name, value = name.lower(), html.unescape(a or b or c).strip()
        # Of an attribute that is given again, the first counts.
        if name not in seen and (name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and NO_DISPLAY.search(value)):
            return True
        seen.add(name)
    return False


def blocks_of(page: str | None) -> list[Block]:
    """The flat text blocks of a page, in order. What stands in skipped or hidden elements is left out."""
    found: list[Block] = []
    # Open elements: name, and whether from here on it is article, frame, hinted, and what is left out.
    stack: list[tuple[str, bool, bool, bool, int]] = []
    opened: Counter[str] = Counter()
    parts: list[str] = []
    links: list[str] = []
    in_link, heading = 0, False
    # An element within a line that is left out: its name, how many of the name are open, and how deep it stands.
    muted: tuple[str, int, int] | None = None

    def state() -> tuple[bool, bool, bool, int]:
        return stack[-1][1:] if stack else (False, False, False, KEPT)

    def flush() -> None:
        text = " ".join("".join(parts).split())
        if text:
            article, frame, hinted, _ = state()
            found.append(Block(text, len(text.split()), len("".join(links).split()), article, frame, hinted, heading))
        parts.clear()
        links.clear()

    def close() -> str:
        name = stack.pop()[0]
        opened[name] -= 1
        return name

    page = page or ""
    at = 0
    while at < len(page):
        token = TOKEN.match(page, at)
        at = token.end()
        if token["text"] is not None:
            if state()[3] == KEPT and muted is None:
                text = html.unescape(token["text"])
                parts.append(text)
                if in_link:
                    links.append(text)
            continue
        if token["name"] is None:
            continue
        name, rest = token["name"].lower(), token["rest"]
        if token["close"]:
            if name == "a":
                in_link = 0
            if name in INLINE:
                if muted and name == muted[0]:
                    muted = (name, muted[1] - 1, muted[2]) if muted[1] > 1 else None
                continue
            flush()
            if len(name) == 2 and name[0] == "h" and name[1] in "123456":
                heading = False
            if opened[name]:
                while close() != name:
                    pass
            if muted and len(stack) < muted[2]:
                muted = None
            continue
        if name in ("script", "style", "textarea", "title"):
            # Their content is not markup.
            end = re.compile(rf"</{name}\b", re.I).search(page, at)
            at = end.start() if end else len(page)
            if name in ("script", "style"):
                continue
        if name == "br":
            parts.append(" ")
            continue
        if name in INLINE:
            in_link = 1 if name == "a" else in_link
            if muted:
                muted = (muted[0], muted[1] + (name == muted[0]), muted[2])
            elif name not in VOID and not CLOSED.search(rest) and (_hidden(rest) or any(LINE_HINT.search(n) for n in _names(rest))):
                muted = (name, 1, len(stack))
            continue
        flush()
        if stack and (stack[-1][0] == name and name in LOOSE or stack[-1][0] == "p" and name in ENDS_PARAGRAPH):
            close()
            if muted and len(stack) < muted[2]:
                muted = None
        if name in VOID or CLOSED.search(rest):
            continue
        if len(name) == 2 and name[0] == "h" and name[1] in "123456":
            heading, in_link = True, 0
        article, frame, hinted, left_out = state()
        outer = frame or hinted
        # A header within an article is the article's own, but for what it links to.
        frame = frame or (name in FRAME and not (article and name == "header"))
        # What an article is called does not make it a side matter, unless it stands in another.
        own_name = name in ("html", "body") or name in ARTICLE and not article
        hinted = hinted or (not own_name and _hinted(rest))
        if left_out == FORM and name in ARTICLE:
            # A form around the whole page.
            left_out = KEPT
        if name in SKIPPED or _hidden(rest):
            left_out = max(left_out, FORM if name == "form" and not _hidden(rest) else LEFT_OUT)
        stack.append((name, article or (name in ARTICLE and not outer), frame, hinted, left_out))
        opened[name] += 1
    flush()
    return found


FEATURES = ("words", "link_density", "words_before", "links_before", "words_after", "links_after", "article", "frame", "hinted", "heading")


def features(blocks: list[Block]) -> np.ndarray:
    """A row per block: its words and link density, its neighbours', and where it stands."""
    density = [b.linked / max(1, b.words) for b in blocks]
    rows = []
    for i, b in enumerate(blocks):
        before = (blocks[i - 1].words, density[i - 1]) if i else (0, 0.0)
        after = (blocks[i + 1].words, density[i + 1]) if i + 1 < len(blocks) else (0, 0.0)
        rows.append((b.words, density[i], *before, *after, b.article, b.frame, b.hinted, b.heading))
    return np.array(rows, float).reshape(-1, len(FEATURES))


# Labelled blocks, written for this purpose: the features in order, then whether the block is main text.
LABELLED = (
    # In an article: short and long paragraphs, headings, lists with and without links.
    (2, 0.0, 40, 0.0, 55, 0.0, 1, 0, 0, 0, 1), (45, 0.0, 2, 0.0, 80, 0.0, 1, 0, 0, 0, 1), (80, 0.05, 45, 0.0, 1, 0.0, 1, 0, 0, 0, 1),
    (1, 0.0, 80, 0.05, 8, 1.0, 1, 0, 0, 0, 1), (9, 0.0, 12, 0.0, 60, 0.0, 1, 0, 0, 1, 1), (4, 0.25, 30, 0.0, 30, 0.0, 1, 0, 0, 0, 1),
    (1, 0.0, 0, 0.0, 0, 0.0, 1, 0, 0, 0, 1), (300, 0.01, 9, 0.0, 20, 0.0, 1, 0, 0, 0, 1), (6, 0.0, 6, 0.0, 6, 0.0, 1, 0, 0, 0, 1),
    (3, 0.0, 11, 0.0, 2, 0.0, 1, 0, 0, 1, 1), (25, 0.3, 30, 0.0, 30, 0.0, 1, 0, 0, 0, 1), (14, 0.0, 0, 0.0, 3, 0.0, 1, 0, 0, 0, 1),
    # In an article, but a side matter by its element or name.
    (12, 0.0, 40, 0.0, 30, 0.0, 1, 0, 1, 0, 0), (60, 0.0, 40, 0.0, 30, 0.0, 1, 0, 1, 0, 0), (8, 0.9, 30, 0.0, 0, 0.0, 1, 0, 1, 0, 0),
    (20, 0.1, 30, 0.0, 12, 0.0, 1, 1, 0, 0, 0), (5, 0.0, 60, 0.0, 9, 0.0, 1, 1, 0, 0, 0), (3, 0.0, 20, 0.0, 20, 0.0, 1, 0, 1, 1, 0),
    (4, 1.0, 30, 0.0, 4, 1.0, 1, 1, 0, 0, 0), (1, 1.0, 1, 1.0, 1, 1.0, 1, 0, 1, 0, 0), (150, 0.0, 80, 0.0, 80, 0.0, 1, 0, 1, 0, 0),
    # Lists of links in an article lead elsewhere.
    (4, 1.0, 4, 1.0, 5, 1.0, 1, 0, 0, 0, 0), (7, 1.0, 4, 1.0, 6, 1.0, 1, 0, 0, 0, 0), (2, 1.0, 2, 1.0, 0, 0.0, 1, 0, 0, 0, 0),
    # Frames of the page.
    (1, 1.0, 0, 0.0, 1, 1.0, 0, 1, 0, 0, 0), (1, 1.0, 1, 1.0, 1, 1.0, 0, 1, 0, 0, 0), (9, 0.0, 60, 0.0, 0, 0.0, 0, 1, 0, 0, 0),
    (40, 0.0, 5, 0.0, 5, 0.0, 0, 1, 0, 0, 0), (3, 0.0, 1, 1.0, 12, 0.0, 0, 1, 0, 1, 0), (70, 0.1, 30, 0.0, 30, 0.0, 0, 1, 1, 0, 0),
    (8, 0.0, 1, 1.0, 8, 0.0, 0, 0, 1, 0, 0), (30, 0.0, 1, 1.0, 60, 0.0, 0, 0, 1, 0, 0), (120, 0.0, 60, 0.0, 40, 0.0, 0, 0, 1, 0, 0),
    (6, 0.0, 8, 0.0, 30, 0.0, 0, 0, 1, 1, 0),
    # Pages without an article element: paragraphs of some length and headings among them are text; scraps are not.
    (60, 0.0, 9, 0.0, 45, 0.0, 0, 0, 0, 0, 1), (45, 0.1, 60, 0.0, 70, 0.0, 0, 0, 0, 0, 1), (22, 0.0, 50, 0.0, 3, 0.0, 0, 0, 0, 0, 1),
    (15, 0.0, 40, 0.0, 40, 0.0, 0, 0, 0, 0, 1), (9, 0.0, 4, 1.0, 60, 0.0, 0, 0, 0, 1, 1), (6, 0.0, 40, 0.0, 55, 0.0, 0, 0, 0, 1, 1),
    (5, 0.0, 50, 0.0, 50, 0.0, 0, 0, 0, 0, 1), (30, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 0, 1), (12, 0.0, 30, 0.0, 25, 0.0, 0, 0, 0, 0, 1),
    (3, 1.0, 3, 1.0, 4, 1.0, 0, 0, 0, 0, 0), (5, 0.8, 0, 0.0, 3, 1.0, 0, 0, 0, 0, 0), (20, 0.9, 3, 1.0, 4, 1.0, 0, 0, 0, 0, 0),
    (4, 0.0, 3, 1.0, 4, 1.0, 0, 0, 0, 0, 0), (3, 0.0, 2, 0.0, 2, 1.0, 0, 0, 0, 0, 0), (40, 0.7, 5, 1.0, 5, 1.0, 0, 0, 0, 0, 0),
    (2, 0.5, 4, 0.0, 3, 0.0, 0, 0, 0, 0, 0), (4, 0.0, 0, 0.0, 3, 1.0, 0, 0, 0, 0, 0), (5, 0.0, 3, 1.0, 2, 0.0, 0, 0, 0, 1, 0),
)


def _systematic() -> Iterator[tuple]:
    """Further labelled blocks, one for each combination of a few values, labelled by where they stand.

    In an article all are text, paragraphs that are links as well as headings, whatever stands beside them, but for short links among
    short links, which lead elsewhere. In a frame, or under a name that tells side matter, none is. Elsewhere paragraphs of some
    length are, headings before them, and what stands between them.
    """
    beside = ((0, 0.0), (1, 1.0), (5, 1.0), (3, 0.0), (9, 0.5), (30, 0.0), (45, 0.9))
    for words, density, before, after, heading in product((1, 3, 7, 14, 40, 200), (0.0, 0.3, 0.7, 1.0), beside, beside, (0, 1)):
        near = (before, after)
        in_list = words < 9 and density == 1.0 and any(n == 1.0 and w for w, n in near) and all(n == 1.0 or not w for w, n in near)
        among = [w >= 10 and n < 0.5 for w, n in near]
        alone = density < 0.5 and (words >= 10 or words > 2 and (all(among) or heading and among[1]))
        block = (words, density, *before, *after)
        yield *block, 1, 0, 0, heading, int(not in_list)
        yield *block, 0, 0, 0, heading, int(alone)
        for article, frame, hinted in ((1, 1, 0), (1, 0, 1), (0, 1, 0), (0, 0, 1)):
            yield *block, article, frame, hinted, heading, 0


def grow(rows: np.ndarray, labels: np.ndarray, least: int = 2, depth: int = 12) -> tuple:
    """A decision tree by Gini impurity: (feature, threshold, below, above), or (share of text,) as a leaf."""
    share = float(labels.mean())
    if share in (0.0, 1.0) or depth == 0 or len(labels) < 2 * least:
        return (share,)
    best = None
    for f in range(rows.shape[1]):
        values = np.unique(rows[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            left = rows[:, f] < cut
            if min(left.sum(), (~left).sum()) < least:
                continue
            impurity = sum(len(part) * part.mean() * (1 - part.mean()) for part in (labels[left], labels[~left]))
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, f, float(cut))
    if best is None:
        return (share,)
    _, f, cut = best
    left = rows[:, f] < cut
    return f, cut, grow(rows[left], labels[left], least, depth - 1), grow(rows[~left], labels[~left], least, depth - 1)


def trained(labelled: tuple = LABELLED) -> tuple:
    table = np.array([*labelled, *_systematic()], float)
    return grow(table[:, :-1], table[:, -1])


def decide(tree: tuple, row: np.ndarray) -> bool:
    while len(tree) > 1:
        tree = tree[2] if row[tree[0]] < tree[1] else tree[3]
    return tree[0] >= 0.5


def main_text(page: str | None, tree: tuple) -> str:
    blocks = blocks_of(page)
    return "\n\n".join(b.text for b, row in zip(blocks, features(blocks), strict=True) if decide(tree, row))


def extract(pages: DataFrame, html_col: str = "html", *, labelled: tuple = LABELLED) -> DataFrame:
    """The input's other columns with `text`, the page's main text, and `n_chars`, its code points.

    A page is cut into flat blocks at block elements. Each block is described by its number of words and link
    density, those of the blocks before and after it, and where it stands; a decision tree trained on
    `labelled` and `_systematic` keeps or drops it. Kept blocks are joined in page order by an empty line. Character references
    are decoded and white space within a block becomes one space. Null, empty and text-free
    pages give an empty text; broken markup is read as far as it goes. Pages are whole, one at a time.
    """
    others = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    tree = trained(labelled)
    kinds = ", ".join(f"`{c}` {t}" for c, t in pages.dtypes if c in others)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p.as_py(), tree) for p in batch.column(html_col)]
            columns = [*[batch.column(c) for c in others], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*others, "text", "n_chars"])

    return pages.select(*others, html_col).mapInArrow(work, f"{kinds}, text string, n_chars long")
