"""Labelled page shapes, from which the tree of :mod:`millrace.llm.html_text` learns.

A shape is the markup of a kind of page with its texts left out: ``Y45`` stands
for a text of 45 words that belongs to the article, ``N12`` for one of 12 words
that does not, and an ``L`` before the number puts the text into a link.  Shapes
are filled with words and measured like any page, at several lengths, and once more with every tag and class
removed that names a part of the page, so that lengths and links have to tell.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np

#: factors on the lengths of texts
LENGTHS = (0.5, 1.0, 1.7, 3.0)

_MENU = "<ul><li>NL1</li><li>NL1</li><li>NL2</li><li>NL1</li></ul>"
_LINES = "<div>NL1</div><div>NL2</div><div>NL1</div>"

SHAPES = (
    # news with every part named
    f"<header><h1>N2</h1></header><nav>{_MENU}</nav><article><h1>Y7</h1><p>Y40</p><p>Y55</p><h2>Y4</h2><p>Y30</p><ul><li>Y9</li><li>Y6</li></ul>"
    f"<blockquote>Y18</blockquote><p>Y25</p></article><aside><h3>N3</h3><p>N30</p><p>N45</p></aside><footer><p>N9</p>{_LINES}</footer>",
    # a blog post with long comments
    f"<nav>{_MENU}</nav><main><article><h2>Y6</h2><p>Y35</p><p>Y20 YL2</p><p>Y50</p></article><section id=comments><h3>N2</h3><div><p>N30</p></div>"
    "<div><p>N60</p><p>N90</p></div><form><p>N3</p></form></section></main><footer><p>N6</p></footer>",
    # nothing but blocks between menus
    f"{_MENU}<h1>Y6</h1><p>Y45</p><p>Y28</p><p>Y60</p><h2>Y3</h2><p>Y35</p>{_LINES}<div>N8</div>",
    f"<div>{_LINES}</div><div><div>Y40</div><div>Y25</div><div>Y55</div></div><div>{_LINES}</div><div>N5</div>",
    # paragraphs with links inside, and a list of further pages
    f"{_MENU}<h1>Y5</h1><p>Y25 YL3 Y12</p><p>Y18 YL2 Y9 YL4</p><p>Y40</p><h3>N2</h3><ul><li>NL6</li><li>NL7</li><li>NL5</li></ul><p>N4 NL2</p>",
    # short pages
    "<h1>Y4</h1><p>Y14</p><p>Y9</p><p>Y12</p>",
    "<p>Y30</p>",
    "<p>Y9</p>",
    f"{_MENU}<p>Y26</p><p>Y12</p>",
    f"<nav>{_MENU}</nav><article><p>Y8</p></article><footer>N5</footer>",
    # lists and tables as the article
    f"<nav>{_MENU}</nav><main><h1>Y4</h1><p>Y20</p><table><tr><td>Y1</td><td>Y2</td></tr><tr><td>Y1</td><td>Y3</td></tr><tr><td>Y2</td><td>Y1</td></tr></table>"
    "<p>Y25</p></main><footer>NL3 N4</footer>",
    f"{_LINES}<h1>Y5</h1><p>Y30</p><ul><li>Y12</li><li>Y8</li><li>Y15</li><li>Y5</li></ul><p>Y35</p>{_MENU}",
    # notices and adverts among the text
    f"<div class=cookie-notice>N25</div>{_MENU}<article><h1>Y6</h1><p>Y45</p><div class=ad>N12</div><p>Y50</p><div class=newsletter><p>N20</p></div><p>Y30</p></article>"
    "<div class=related><h3>N2</h3><p>N40</p><p>N35</p></div>",
    f"<div class=sidebar><p>N30</p>{_LINES}</div><div class=post><h1>Y5</h1><p>Y40</p><p>Y30</p></div><div class=comments><p>N35</p><p>N80</p><p>N50</p></div>",
    # index pages, which have no article
    f"<nav>{_MENU}</nav><div><div>NL7</div><div>NL8</div><div>NL6</div><div>NL9</div></div><footer>N6</footer>",
    f"<div>{_LINES}</div><ul><li>NL5 N3</li><li>NL6 N2</li><li>NL4 N3</li></ul><div>{_LINES}</div>",
    # long menus, footers, asides and forms
    f"<nav><p>N80</p><p>N140</p>{_MENU}</nav><article><h1>Y5</h1><p>Y45</p><p>Y60</p></article><aside><p>N120</p><p>N90</p></aside>"
    "<form><p>N100</p><p>N60</p></form><footer><p>N110</p><p>N70</p></footer>",
    # a discussion with answers that are the page
    f"<nav>{_MENU}</nav><main><h1>Y8</h1><div><p>Y35</p></div><div><p>Y60</p><p>Y20</p></div></main><div class=widget><p>N12</p>{_LINES}</div>",
)

#: shapes that only their names make out
NAMED = (
    f"<nav>{_MENU}</nav><article><h1>Y3</h1><p>Y1</p><p>Y2</p><p>Y1</p><p>Y30</p><p>Y1</p></article><footer>N5</footer>",
    f"<nav>{_MENU}</nav><div class=ad>N9</div><article><h1>Y1</h1><p>Y2</p></article><footer>N12</footer>",
    f"<nav>{_MENU}</nav><main><h2>Y3</h2><ul><li>YL3</li><li>YL4</li><li>YL3 Y2</li></ul><p>Y30</p><p>YL2</p><p>Y1</p></main><footer>{_LINES}</footer>",
    f"<header>{_MENU}</header><article><p>YL5</p><p>Y20</p><p>YL1 Y1</p><table><tr><td>YL2</td><td>Y1</td></tr></table></article>{_LINES}",
    f"<article><h1>Y6</h1><p>Y40</p><aside><p>N30</p></aside><p>Y1</p><div class=share>NL1 NL1</div><form><p>N8</p></form><p>YL3</p></article><nav>{_MENU}</nav>",
)

#: further shapes, to measure the tree by
HELD_OUT = (
    f"<header>N4</header><nav>{_MENU}</nav><div class=content><h1>Y9</h1><p>Y30</p><p>Y70</p><p>Y15</p><h2>Y5</h2><p>Y44</p></div><aside>N50</aside><footer>N14</footer>",
    f"<div>{_LINES}{_LINES}</div><h1>Y8</h1><p>Y50</p><p>Y33</p><p>Y21 YL1 Y10</p><div>{_LINES}</div><p>N6</p>",
    f"<main><h1>Y3</h1><ol><li>Y20</li><li>Y14</li><li>Y30</li></ol></main><section class=comments><p>N40</p><p>N100</p></section>{_MENU}",
    "<h2>Y5</h2><p>Y18</p><p>Y25</p>",
    f"{_MENU}<article><p>Y55</p><div class=promo>N25</div><p>Y40</p></article><div class=share>NL1 NL1</div><footer><p>N90</p></footer>",
)


def _bare(shape: str) -> str:
    """Without names of parts; texts that only a name tells from an article's are left out."""
    shape = re.sub(r"<(aside|form|section)\b.*?</\1>|<div class=(?:sidebar|comments|related|newsletter|cookie-notice|ad|promo)>.*?</div>", "", shape)
    shape = re.sub(r"<nav><p>.*?</nav>|<footer><p>N\d\d+.*?</footer>", "", shape)
    return re.sub(r"<(/?)(?:header|nav|footer|article|main)>", r"<\1div>", re.sub(r" (?:class|id)=[a-z-]+", "", shape))


def filled(shape: str, factor: float = 1.0) -> str:
    """A page with words for texts; the first word of each tells its label."""

    def words(m: re.Match) -> str:
        n = max(1, round(int(m[3]) * factor)) if int(m[3]) > 3 else int(m[3])
        text = " ".join(["yes" if m[1] == "Y" else "no", *["word"] * (n - 1)])
        return f"<a href=x>{text}</a>" if m[2] else text

    return re.sub(r"\b([YN])(L?)(\d+)\b", words, shape)


def measured(shapes: Sequence[str] = SHAPES, lengths: Sequence[float] = LENGTHS) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of all blocks of the shapes, as they are and bare."""
    from millrace.llm import html_text

    rows, labels = [], []
    for shape in (*shapes, *(NAMED if shapes is SHAPES else ())):
        forms = (shape,) if shape in NAMED else (shape, _bare(shape))
        for page in {filled(s, f): None for s in forms for f in lengths}:
            found = html_text.blocks(page)
            rows.append(html_text.described(found))
            labels += [b.text.startswith("yes") for b in found]
    return np.concatenate(rows), np.array(labels, float)
