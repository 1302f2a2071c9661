"""Main text of raw web pages by the distribution of text over line blocks.

1. Markup is stripped: comments, scripts, styles and other unseen elements go, a
   block-level tag ends a line, inline tags go without a trace.  Elements that are
   furniture by their tag, role or class (menus, headers, footers, sidebars,
   notices, adverts, forms, reader comments) leave empty lines in their place.  A class
   or id counts only as a whole token made of furniture words (``site-footer``, not
   ``footer-notes-on-law``); ids of headings and paragraphs never do, and within an article
   only containers are judged.  What
   holds the page's principal article (that with the most text outside articles within
   it) is no furniture by its class or id; an article within an article or in a block of
   comments, related texts or adverts is never the principal one.
2. A line's length is the number of its characters once references are decoded.
   Sums over sliding windows of WINDOW lines reach DENSE where text begins (a surge)
   and fall below where it ends (a dive); on a page without such windows any text is dense.
3. The dense text between surges and dives tells where the text is.  If most of it
   lies in the elements that the page marks as articles (or else in main elements), the text is all
   lines of these.  Otherwise it is sought from body downwards: in the container that
   holds more than half of the dense text, in its container that does, and so on to the last.
   All lines there stay, short ones too; if that is body itself, those of its containers
   that hold at least NEIGHBOUR of the dense text of the largest.

Lines have their white space collapsed and are joined by one space.  Null or empty
html gives an empty text; repeated rows are extracted each on its own; very long
pages are read whole; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import html as _html
import re
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchkit.llm.common import mapped, slices

#: Lines in a window: as many empty lines end a region.
WINDOW = 3
#: Characters that a window of dense text holds at least.
DENSE = 80
#: Share of the largest container's dense text that others in body need, where body itself holds the text.
NEIGHBOUR = 0.25

_UNSEEN = "script style noscript template svg math iframe object canvas video audio select textarea button head title datalist".split()
_FURNITURE = "nav header footer aside form menu dialog".split()
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
#: Words of classes and ids of furniture, and words that may stand with them in one token.
_FURNITURE_WORDS = set("nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar side aside widget widgets ad ads advert adverts advertisement sponsor sponsored promo banner "
                       "notice notices alert alerts cookie cookies consent gdpr popup modal overlay comment comments commentlist replies reply respond disqus share sharing social related recommended "
                       "newsletter subscribe signup login search pagination pager toolbar copyright legal disclaimer".split())
_WITH = set("site page main global top bottom left right primary secondary sticky fixed mobile desktop list lists item items box bar block blocks container wrapper wrap inner outer links link buttons "
            "button icons icon posts articles stories section area slot unit form text content row column col group panel reader user post entry article blog story the wp bs js d".split())
_STATES = set("has no with without is category tag topic".split())
#: Elements that hold lines of text: an id on them names a topic.
_TOPICS = set("h1 h2 h3 h4 h5 h6 p pre blockquote li dt dd td th figcaption caption".split())
#: Elements that are judged by class and id within an article, too.
_CONTAINERS = set("div section aside nav ul ol dl table header footer form article figure details fieldset".split())
#: Class words and ids of blocks whose articles are comments, teasers and adverts, also of such an article itself; not those that tell a state or a topic.
_APART = re.compile(
    r"(?:^|\s)(?!(?:has|no|with|without|is|category|tag|topic)[_-])(?:[\w-]*[_-])?(?:comments?|commentlist|replies|reply|respond|disqus|related|recommended|teasers?|ads?|adverts?|advertisement|sponsor(?:ed)?|promo)"
    r"(?:[_-](?!(?:open|closed|enabled|disabled|on|off)(?=$|\s))[\w-]*)?(?=$|\s)", re.I)
_ROLES = re.compile(r"(?:navigation|banner|contentinfo|complementary|search|form|alert|dialog|menu|menubar)$", re.I)
#: No character fits two ways and nothing is tried again, so a page is read in one pass; what is unfinished runs to the end.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))?+)*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"(?<![\w-])(class|id|role|hidden|aria-hidden)(?![\w-])(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_BLANK = re.compile(r"\s+")
#: Block elements that hold lines only, and so are no containers.
_LINES = set("p h1 h2 h3 h4 h5 h6 pre li dt dd".split())
#: An end tag closes elements left open inside it, but never beyond one of these.
_CLOSES = {"li": {"li"}, "p": {"p"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


def _apart(attrs: str) -> bool:
    return any(name.lower() in ("class", "id") and _APART.search(a or b or c) for name, a, b, c in (_ATTR.findall(attrs) if attrs else ()))


@functools.lru_cache(maxsize=10_000)
def _furniture_words(value: str) -> frozenset[str]:
    """The furniture words of a class or id, from tokens that hold no word beyond such words and their usual company."""
    found: set[str] = set()
    for token in value.split():
        words = [w.rstrip("0123456789") for w in re.split(r"[_-]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", token).lower()) if w]
        words = [w for w in words if w]
        if words and words[0] not in _STATES and all(w in _FURNITURE_WORDS or w in _WITH for w in words):
            found |= _FURNITURE_WORDS.intersection(words)
    return frozenset(found)


def _furniture(tag: str, attrs: str, inside_article: bool) -> bool:
    if tag in _FURNITURE and not (tag == "header" and inside_article):
        return True
    for name, a, b, c in _ATTR.findall(attrs) if attrs else ():
        name, value = name.lower(), a or b or c
        if name == "role" and _ROLES.match(value.strip()):
            return True
        if name in ("class", "id") and tag not in ("body", "html", "article", "main"):
            judged = tag in _CONTAINERS if inside_article else not (name == "id" and tag in _TOPICS)
            if judged and _furniture_words(value) - ({"header", "masthead"} if inside_article else set()):  # an article's own header holds its title
                return True
        if tag == "article" and name in ("class", "id") and _APART.search(value):
            return True
        if not inside_article and (name == "hidden" and tag not in ("body", "html") or name == "aria-hidden" and value.lower() == "true"):
            return True
    return False


class Line(NamedTuple):
    """A line: ``mark`` is 2 within an article, 1 within main, else 0; ``box`` the innermost container, 0 for body."""

    text: str
    mark: int
    furniture: bool
    box: int


def lines(page: str) -> tuple[list[Line], dict[int, int], set[int]]:
    """The lines of a page, the containers' containers (0: body), and those containers that hold blocks of their own."""
    out: list[tuple[str, int, tuple[int, ...], int]] = []  # furniture as the numbers of the open elements that are
    text: list[str] = []
    stack: list[tuple[str, bool, int]] = []  # open elements that matter: (tag, furniture, number)
    open_tags: Counter[str] = Counter()
    marked: tuple[int, ...] = ()  # numbers of the open furniture
    by_tag: set[int] = set()  # furniture whatever it holds
    apart: set[int] = set()
    boxes: list[int] = [0]  # open containers
    parent: dict[int, int] = {}
    blocks: set[int] = set()
    holders: dict[int, list] = {}  # articles and mains: [tag, open furniture with itself, nested in an article, characters]
    held: dict[str, list[int]] = {"article": [], "main": []}  # those open
    unclosed: set[str] = set()  # unseen elements that have no end tag from here on
    count = article = main = 0
    at, n = 0, len(page)

    def row(s: str, bad: tuple[int, ...]):
        out.append((s, 2 if article else 1 if main else 0, bad, boxes[-1]))

    def flush():
        s = _BLANK.sub(" ", _html.unescape("".join(text))).strip()
        text.clear()
        if s:
            row(s, marked)
            for kind in ("article", "main"):
                if held[kind] and marked == holders[held[kind][-1]][1]:
                    holders[held[kind][-1]][3] += len(s)

    def pop(k: int):
        nonlocal marked, article, main
        for tag, f, number in reversed(stack[k:]):
            article -= tag == "article" and not f
            main -= tag == "main" and not f
            open_tags[tag] -= 1
            if tag in held:
                held[tag].pop()
            if boxes[-1] == number:
                boxes.pop()
        gone = sum(f for _, f, _ in stack[k:])
        marked = marked[:len(marked) - gone]
        del stack[k:]

    while at < n:
        m = _TOKEN.search(page, at)
        if not m:
            text.append(page[at:])
            break
        text.append(page[at:m.start()])
        at = m.end()
        closing, tag, attrs = m[1], (m[2] or "").lower(), m[3] or ""
        selfclosing = attrs.endswith("/")
        if not tag or tag in _INLINE and not _ATTR.search(attrs) and tag != "label":
            if tag == "" and m[0].startswith("<![CDATA["):
                text.append(_html.escape(m[0][9:].removesuffix("]]>")))
            # an inline tag that closes an inline element which was kept on the stack
            if closing and any(t == tag for t, _, _ in stack[-4:]):
                k = max(i for i, (t, _, _) in enumerate(stack) if t == tag)
                flush()
                pop(k)
            continue
        if not closing and tag in _UNSEEN:
            flush()
            if not selfclosing:
                end = None if tag in unclosed else re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                if end:
                    at = end.end()
                else:
                    unclosed.add(tag)
                    at = n if tag in ("script", "style") else at
            continue
        if tag in _VOID:
            if tag in ("br", "hr"):
                flush()
            continue
        if closing:
            flush()
            for k in range(len(stack) - 1, -1, -1) if open_tags[tag] else ():
                if stack[k][0] == tag:
                    _, furniture, number = stack[k]
                    pop(k)
                    if furniture:
                        for _ in range(WINDOW):
                            row("", (*marked, number))
                    break
                if stack[k][0] in ("article", "main", "body", "table") and tag in ("p", "li", "td", "tr", "span", "div"):
                    break
            continue
        f = _furniture(tag, attrs, article > 0)
        if tag in _INLINE and not f:
            continue
        flush()
        for k in range(len(stack) - 1, max(-1, len(stack) - 4), -1):
            if tag in _CLOSES and stack[k][0] in _CLOSES[tag]:
                pop(k)
                break
            if stack[k][0] in ("ul", "ol", "dl", "table", "article", "main", "div", "section"):
                break
        if selfclosing:
            continue
        count += 1
        if f:
            marked = (*marked, count)
            if tag in _FURNITURE:
                by_tag.add(count)
            if _apart(attrs):
                apart.add(count)
        if tag not in _INLINE:
            blocks.add(boxes[-1])
        if tag not in _LINES and tag not in _INLINE and tag not in ("html", "body"):
            parent[count] = boxes[-1]
            boxes.append(count)
        if tag in ("article", "main"):
            holders[count] = [tag, marked, bool(held["article"]), 0]
            held[tag].append(count)
        stack.append((tag, f, count))
        open_tags[tag] += 1
        article += tag == "article" and not f
        main += tag == "main" and not f
    flush()

    def cleared(never: set[int]) -> set[int]:
        """What holds the principal article or main is no furniture, whatever its class says (say, "has-sidebar")."""
        free: set[int] = set()
        for kind in ("article", "main"):
            able = [h for h in holders.values() if h[0] == kind and h[3] and not h[2] and never.isdisjoint(h[1])]
            free |= set(max(able, key=lambda h: h[3])[1]) if able else set()
        return free

    free = cleared(by_tag | apart)
    if not any(s and free.issuperset(bad) for s, _, bad, _ in out):  # better a text of such a block than none
        free = cleared(by_tag)
    return [Line(s, mark, not free.issuperset(bad), box) for s, mark, bad, box in out if s or bad[-1] not in free], parent, blocks


def regions(lengths: np.ndarray, window: int = WINDOW, dense: int = DENSE) -> list[tuple[int, int]]:
    """Surge and dive points: (first, last + 1) of the lines of each run of windows with at least ``dense`` characters, without empty ends.

    Runs whose lines overlap are one region; ``window`` empty lines always part two.
    """
    n = len(lengths)
    total = np.concatenate([[0], np.cumsum(lengths)])
    starts = np.arange(max(1, n - window + 1) if n else 0)  # whole windows; of a shorter page, all of it
    hit = total[np.minimum(starts + window, n)] - total[starts] >= max(1, dense)
    live = np.concatenate([[False], hit, [False]])
    edges = np.flatnonzero(live[1:] != live[:-1])
    out: list[tuple[int, int]] = []
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        inside = a + np.flatnonzero(lengths[a:b - 1 + window])
        first, last = int(inside[0]), int(inside[-1]) + 1
        if out and first < out[-1][1]:
            first, last = out[-1][0], max(last, out.pop()[1])
        out.append((first, last))
    return out


def _within(box: int, parent: dict[int, int], roots: set[int], known: dict[int, bool]) -> bool:
    """Whether one of ``roots`` is the container ``box`` or holds it."""
    path = []
    while box not in known and box not in roots and box:
        path.append(box)
        box = parent[box]
    answer = known.get(box, box in roots)
    known.update(dict.fromkeys(path, answer))
    return answer


def main_text(page: str | None) -> str:
    """The page's main text; empty if there is none."""
    rows, parent, blocks = lines(page or "")
    kept = [r for r in rows if not r.furniture or not r.text]  # furniture is a gap
    lengths = np.array([len(r.text) for r in kept], np.int64)
    dense = np.zeros(len(kept), np.int64)
    for a, b in regions(lengths) or regions(lengths, dense=1):
        dense[a:b] = lengths[a:b]
    marks = np.array([r.mark for r in kept], np.int64)
    for mark in (2, 1):
        inside = dense[marks >= mark].sum()
        if inside and 2 * inside >= dense.sum():
            return " ".join(r.text for r in kept if r.text and r.mark >= mark)
    # dense text of every container with all that it holds: what a container holds has a greater number
    weight = dict.fromkeys(parent, 0) | {0: 0}
    for r, d in zip(kept, dense.tolist(), strict=True):
        weight[r.box] += d
    inner: dict[int, list[int]] = {}
    for box in sorted(parent, reverse=True):
        weight[parent[box]] += weight[box]
        inner.setdefault(parent[box], []).append(box)
    here = 0
    while True:
        heavy = max(inner.get(here, ()), key=lambda b: weight[b], default=0)
        if not heavy or 2 * weight[heavy] <= weight[0] or heavy not in blocks:
            break
        here = heavy
    if here:
        roots = {here}
    else:
        most = max([weight[b] for b in inner.get(0, ())] + [weight[0] - sum(weight[b] for b in inner.get(0, ()))])
        roots = {b for b in inner.get(0, ()) if weight[b] and weight[b] >= NEIGHBOUR * most}
    known: dict[int, bool] = {}
    return " ".join(r.text for r in kept if r.text and (_within(r.box, parent, roots, known) if r.box else not here))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) per row of ``pages``."""
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}

    def run(batches):
        for b in slices(batches):
            texts = [main_text(x) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    got = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html")) \
               .transform(mapped, run, f"page_id {kinds[page_id]}, url {kinds[url]}, text string")
    return got.withColumn("n_chars", F.length("text").cast("long"))
