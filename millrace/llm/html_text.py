"""Main text of web pages: flat text blocks, kept or dropped by a small decision tree.

A page is cut into blocks of text between block-level tags.  A block is
described by its own word count and link density, by those of the blocks
before and after it, by those of all blocks in the element around it and of the
page, and by where it stands: under an element whose tag says that it is no
article text, under one whose class, id or role says so, under one that says it
is, or as a heading.  A decision tree trained on the labelled blocks of
:mod:`millrace.llm.page_shapes` judges it.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import page_shapes
from millrace.llm.texts import byte_slices

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_NOT_SHOWN = re.compile(r"(?:^|;)\s*display\s*:\s*none")

# Elements without text of the page, elements that are no article, and words that say so.
SILENT = frozenset("script style noscript template title svg math iframe object canvas select textarea button audio video map".split())
RAW = frozenset("script style title textarea iframe".split())  # of these, elements that hold no other elements
APART = frozenset("nav header footer aside form menu dialog".split())
MAIN = frozenset(("article", "main"))
HOLDS_P = APART | MAIN | {"div", "section", "td", "li", "blockquote"}  # a block inside one leaves paragraphs around it open
HEADING = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CUES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist complementary "
    "consent contentinfo cookie cookies disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice "
    "notices pagination pager popup promo promoted promotion recommended related replies respond search share sharing sidebar "
    "sidebars signup social sponsor sponsored subscribe tags toolbar topbar widget widgets".split()
)
#: class and id words of elements that hold the article
MAIN_CUES = frozenset("article articlebody content entry main maincontent post story".split())
#: words before a cue that make a class a state of the element, and cues of elements that do not wrap an article without saying so
STATES = frozenset("has with without no not is show hide hidden".split())
TALK = frozenset("comment comments commentlist disqus replies respond".split())
FEATURES = (
    "words", "links", "words_before", "links_before", "words_after", "links_after",
    "apart", "cued", "main", "heading", "box_words", "box_links", "page_words",
)


@dataclass
class Block:
    text: str
    links: float
    apart: bool
    main: bool
    heading: bool
    box: int
    cue: int  # innermost element around it whose class, id or role says apart; 0 for none
    cued: bool = False


def _attributes(rest: str) -> tuple[set[str], bool]:
    """Words of class, id and role but for states such as ``has-sidebar``, and whether the element is hidden."""
    cues: set[str] = set()
    hidden = False
    for name, value in _ATTRIBUTE.findall(rest.lower()):
        value = value.strip("\"'")
        if name in ("class", "id", "role"):
            for token in value.split():
                words = [w for w in re.split(r"[^a-z0-9]+", token) if w]
                if words and not (len(words) > 1 and words[0] in STATES):
                    cues.update(words)
        hidden = hidden or name == "hidden" or name == "aria-hidden" and value.strip() == "true" or name == "style" and bool(_NOT_SHOWN.search(value))
    return cues, hidden


def _spread(found: list[Block], parents: list[int], articles: list[int], talk: set[int]) -> None:
    """Mark blocks as cued by the cues around them, but not by those of a wrapper.

    A wrapper holds every article and main element of the page, or, where there
    are none, most of the words with few links, all text marked as main, and the first
    heading; an element of comments wraps nothing without such a heading.
    """
    words, mains, heads = ([0] * len(parents) for _ in range(3))
    first = next((b for b in found if b.heading and not b.apart), None)
    for b in found:
        if not b.apart:
            words[b.cue] += len(b.text.split(" ")) if b.links < 0.3 else 0
            mains[b.cue] += b.main
            heads[b.cue] += b is first
    for i in range(len(parents) - 1, 0, -1):  # an element comes after those around it
        for held in (words, mains, articles, heads):
            held[parents[i]] += held[i]
    cued = [False] * len(parents)
    for i in range(1, len(parents)):
        most = 2 * words[i] > words[0] and mains[i] == mains[0] and heads[i] == heads[0] and (heads[0] or i not in talk)
        wraps = articles[i] == articles[0] if articles[0] else most
        cued[i] = not wraps or cued[parents[i]]
    for b in found:
        b.cued = cued[b.cue]


def _raw_end(page: str, tag: str, at: int) -> int:
    over = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
    return over.end() if over else len(page)


def closings(page: str) -> dict[int, int]:
    """Where the closing tags of silent elements end, by the end of their start tags; unclosed ones are left out.

    An element that is open when one around it closes has no closing tag of its own.
    """
    out: dict[int, int] = {}
    stack: list[tuple[str, int]] = []
    count: Counter[str] = Counter()
    at = 0
    while m := _TOKEN.search(page, at):
        at = m.end()
        tag, end, rest = (m[2] or m[5] or "").lower(), m[1] or m[4], m[3] or m[6] or ""
        if tag in RAW:
            if not end and not rest.endswith("/"):
                at = _raw_end(page, tag, at)
        elif end:
            while count[tag]:
                name, start = stack.pop()
                count[name] -= 1
                if name == tag:
                    out[start] = at
                    break
        elif tag and tag not in VOID and tag not in INLINE and not rest.endswith("/"):
            if tag in ("button", "select"):  # never one inside another
                while count[tag]:
                    count[stack.pop()[0]] -= 1
            stack.append((tag, at))
            count[tag] += 1
    return out


def blocks(page: str) -> list[Block]:
    """Text blocks of a page in order, references decoded and white space made single."""
    out: list[Block] = []
    parts: list[str] = []
    linked: list[str] = []
    # open elements: tag, apart, main, heading, link, own number and that of the element around it, innermost cue, and
    # where the paragraph and the list item stand that a new one closes
    stack: list[tuple[str, bool, bool, bool, bool, int, int, int, int, int]] = [("", False, False, False, False, 0, 0, 0, 0, 0)]
    count: Counter[str] = Counter()
    opened = 0
    # elements with a cue: the one around, and article and main elements inside; the first stands for the page
    parents, articles, talk = [0], [0], set()
    closed: dict[int, int] | None = None
    muted = False  # behind an unclosed silent element, up to the next block

    def flush() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            in_links = len(" ".join(html.unescape("".join(linked)).split()))
            _, apart, main, heading, _, _, box, cue, *_ = stack[-1]
            out.append(Block(text, min(1.0, in_links / len(text)), apart, main, heading, box, cue))
        parts.clear()
        linked.clear()

    def add(text: str) -> None:
        if muted:
            return
        parts.append(text)
        if stack[-1][4]:
            linked.append(text)

    def cut(i: int) -> None:
        """Close the element at place ``i`` and all inside it."""
        count.subtract(e[0] for e in stack[i:])
        del stack[i:]

    def close(tag: str) -> None:
        if count[tag]:
            i = len(stack) - 1
            while stack[i][0] != tag:
                i -= 1
            cut(i)

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        end, rest = bool(m[1] or m[4]), m[3] or m[6] or ""
        if tag in SILENT:
            if not end and not rest.endswith("/"):
                if tag not in INLINE and tag not in ("button", "select"):
                    flush()
                if tag in RAW:
                    at = _raw_end(page, tag, at)
                    continue
                closed = closings(page) if closed is None else closed
                muted, at = at not in closed, closed.get(at, at)
            elif end:
                muted = False
            continue
        if tag == "head":  # its text is in silent elements; any other begins the body
            flush()
            continue
        if tag in ("br", "wbr", "img", "input"):
            add(" " if tag != "wbr" else "")
            continue
        inline = tag in INLINE
        if not inline:
            flush()
            if tag in VOID:
                continue
            muted = muted and tag in ("option", "optgroup")
        if end:
            if inline and (stack[-1][1] or stack[-1][7]):
                flush()
            if tag in ("a", "span") or not inline:
                close(tag)
            continue
        if rest.endswith("/") and inline:
            continue
        if not inline:
            if stack[-1][8]:
                cut(stack[-1][8])
            if tag == "li" and stack[-1][9]:
                cut(stack[-1][9])
            elif tag in HEADING and stack[-1][0] in HEADING:
                cut(len(stack) - 1)
        elif tag not in ("a", "span"):
            continue
        _, apart, main, heading, link, own, box, cue, p_at, li_at = stack[-1]
        said, holds, cued = tag in APART, tag in MAIN, False
        if rest and tag not in ("html", "body", "article", "main"):
            cues, hidden = _attributes(rest)
            said, cued = said or hidden, not cues.isdisjoint(CUES)
            holds = holds or not inline and not cues.isdisjoint(MAIN_CUES)
        if cued:
            parents.append(cue)
            articles.append(0)
            cue = len(parents) - 1
            if not cues.isdisjoint(TALK):
                talk.add(cue)
        if tag in MAIN and not (apart or said):
            articles[cue] += 1
        if not inline:
            opened += 1
            own, box = opened, own
        if (said or cued) and inline:  # an inline element apart is no part of the block around it
            flush()
        p_at = len(stack) if tag == "p" else 0 if tag in HOLDS_P else p_at
        li_at = len(stack) if tag == "li" else 0 if tag in ("ul", "ol", "menu") else li_at
        stack.append((tag, apart or said, main or holds, heading or tag in HEADING, link or tag == "a", own, box, cue, p_at, li_at))
        count[tag] += 1
    flush()
    _spread(out, parents, articles, talk)
    return out


def described(found: Sequence[Block]) -> np.ndarray:
    """One row of FEATURES per block."""
    own = [(len(b.text.split(" ")), b.links) for b in found]
    around = [(0, 0.0), *own, (0, 0.0)]
    boxes: dict[int, tuple[int, float]] = {}
    for b, (n, links) in zip(found, own):
        held, linked = boxes.get(b.box, (0, 0.0))
        boxes[b.box] = (held + n, linked + n * links)
    page = sum(n for b, (n, links) in zip(found, own) if links < 0.3 and not (b.apart or b.cued))
    rows = [
        (*own[i], *around[i], *around[i + 2], float(b.apart), float(b.cued), float(b.main), float(b.heading),
         boxes[b.box][0], boxes[b.box][1] / boxes[b.box][0], page)
        for i, b in enumerate(found)
    ]
    return np.array(rows, float).reshape(-1, len(FEATURES))


@dataclass(frozen=True)
class Node:
    """Leaf with the share of article text, or a test ``feature <= cut`` with two branches."""

    share: float
    feature: int = -1
    cut: float = 0.0
    below: Node | None = None
    above: Node | None = None

    def judge(self, rows: np.ndarray) -> np.ndarray:
        if self.feature < 0:
            return np.full(len(rows), self.share)
        left = rows[:, self.feature] <= self.cut
        out = np.empty(len(rows))
        out[left], out[~left] = self.below.judge(rows[left]), self.above.judge(rows[~left])
        return out


def train(rows: np.ndarray, labels: np.ndarray, depth: int = 7) -> Node:
    """Decision tree by Gini impurity; among equal splits the first feature and the lowest cut win."""
    share = float(labels.mean())
    if depth == 0 or share in (0.0, 1.0):
        return Node(share)
    best = (share * (1 - share) - 1e-9, -1, 0.0)
    for f in range(rows.shape[1]):
        values = np.unique(rows[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            left = rows[:, f] <= cut
            p, q = labels[left].mean(), labels[~left].mean()
            impurity = left.mean() * p * (1 - p) + (~left).mean() * q * (1 - q)
            if impurity < best[0] - 1e-12:
                best = (impurity, f, float(cut))
    _, f, cut = best
    if f < 0:
        return Node(share)
    left = rows[:, f] <= cut
    return Node(share, f, cut, train(rows[left], labels[left], depth - 1), train(rows[~left], labels[~left], depth - 1))


def main_text(page: str | None, tree: Node) -> str:
    """The kept blocks joined by an empty line; empty for null and for pages without text."""
    found = blocks(page or "")
    if not found:
        return ""
    keep = tree.judge(described(found)) >= 0.5
    return "\n\n".join(b.text for b, k in zip(found, keep) if k)


def trained() -> Node:
    """The tree of the labelled shapes."""
    return train(*page_shapes.measured())


def extract_text(pages: DataFrame, key: str = "page_id", page: str = "html", carry: Sequence[str] = (), tree: Node | None = None) -> DataFrame:
    """Key, the columns ``carry``, ``text`` and ``n_chars`` of every row.

    Null, empty and textless pages give an empty text.  Rows are judged one by
    one, so repeated rows give repeated results.  Columns that are not named are not
    read; a carried column named ``text`` or ``n_chars``, or like the key, comes out with ``page_`` before its name.
    ``tree`` judges rows of FEATURES.
    """
    tree = tree or trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "page"):
            texts = [main_text(p, tree) for p in batch.column("page").to_pylist()]
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                [*batch.schema.names[:-1], "text", "n_chars"],
            )

    names = [key, *carry]
    picked = pages.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)], F.col(page).cast("string").alias("page"))
    kinds = ", ".join(f"c{i} {picked.schema[f'c{i}'].dataType.simpleString()}" for i in range(len(names)))
    out = picked.mapInArrow(run, f"{kinds}, text string, n_chars bigint")
    return out.toDF(key, *[f"page_{c}" if c in ("text", "n_chars", key) else c for c in carry], "text", "n_chars")
