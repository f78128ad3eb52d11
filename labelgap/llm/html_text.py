"""Main text of web pages by tag-path ratios.

A page is read once into blocks of text, each with the path of tags from the
root. Per path the page's characters and punctuation marks are added up and divided by
the number of blocks: running text stands on paths with long, punctuated blocks,
menus and labels on paths with many short ones. The two ratios are fused, smoothed
along the page, and blocks above a threshold are selected. The element that
holds most of the selected text is the article, with what stands around it as far as that
is above the threshold, too. Its blocks are the result, lists of links among them, except those
that its own markup names as something else (a menu, an advert, a comment). Elements and roles say so themselves. A class or
an id is evidence only: where the ratios find most of a page's text inside what is so named, the name is of the layout
("right-sidebar", "menu-closed") and counts for nothing.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML and the words by which pages name what isn't their article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
UNREAD = frozenset("script style template noscript iframe object svg canvas math audio video select textarea title noembed noframes xmp".split())
SIDE_ELEMENTS = frozenset("nav aside footer form button menu dialog fieldset datalist".split())
SIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form note".split())
SIDE_WORDS = frozenset(
    """ad ads adbox adsbox advert adverts advertisement advertising sponsor sponsored promo promotion promoted banner nav navbar navigation menu
    menubar breadcrumb breadcrumbs sidebar aside footer header masthead topbar cookie cookies consent gdpr notice notices notification alert popup
    modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations comment comments
    commentlist reply replies respond disqus discussion pagination pager toolbar widget copyright skip search searchbox form""".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist reply replies respond disqus discussion".split())
CLOSES_P = frozenset(
    """address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr
    main menu nav ol p pre section summary table ul""".split()
)
SAME_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("html body article aside div section main nav footer header table td th ul ol dl form blockquote".split())

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""",
    re.S,
)
_NAMES = re.compile(r"""(?:^|[\s"'/])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_WORD = re.compile(r"[a-z0-9]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")

#: Blocks on either side that a block's score is smoothed with, and their weights.
SMOOTHING = (0.25, 0.5, 0.25)
#: Share of the best block's score from which a block is selected.
THRESHOLD = 0.2
#: Share of the selected text that one element must hold to be entered.
MOST_TEXT = 0.8
#: Too short to be selected: they don't keep an article from being widened.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that hold a page and not only its article.
WHOLE_PAGE = frozenset(["", "html", "body"])
#: Share of a path's text in links from which it is a list of links.
LINK_SHARE = 0.7
#: Share of a page's selected text from which what holds it is not what its name says, and the share for comments, which may well be longer than an article.
NAMED_SHARE, COMMENT_SHARE = 0.7, 0.9


@dataclass
class Block:
    text: str
    path: int
    element: int
    side: bool
    linked: int
    #: The innermost name it stands under, 0 for none.
    named: int = 0
    score: float = 0.0
    #: The score if what is marked as something else were not on the page.
    alone: float = 0.0


@dataclass
class Page:
    """Blocks in order; elements numbered in order, with the element each stands in; paths numbered, each a path and a name."""

    blocks: list[Block] = field(default_factory=list)
    parents: list[int] = field(default_factory=lambda: [0])
    names: list[str] = field(default_factory=lambda: [""])
    paths: dict[tuple[int, str], int] = field(default_factory=dict)
    #: Elements named as something else, numbered in order from 1.
    marks: list[Mark] = field(default_factory=lambda: [Mark(0, 1.0)])


@dataclass
class Mark:
    """An element whose class or id names it as something else: the mark it stands in, and the share of the text that speaks against the name."""

    parent: int
    share: float
    articles: int = 0
    has_main: bool = False


@dataclass
class _Open:
    name: str
    element: int
    path: int
    side: bool = False
    named: int = 0
    in_link: bool = False
    in_article: bool = False


def _markup_says(name: str, attributes: str, in_article: bool) -> tuple[bool, float]:
    """Whether an element itself says that it isn't part of an article, and if only its name does, the share of text that speaks against it."""
    if name in SIDE_ELEMENTS or (name == "header" and not in_article):
        return True, 0.0
    if not attributes or name in ("html", "body", "main"):
        return False, 0.0
    share = 0.0
    for key, value in _NAMES.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none", value)):
            return True, 0.0
        if key == "role" and value in SIDE_ROLES:
            return True, 0.0
        if key in ("class", "id"):
            for part in value.split():
                words = _WORD.findall(part)
                if words and (words[0] in ("has", "no", "with", "without") or words[-1] in ("free", "less")):
                    continue
                if in_article:  # like the element, it may hold the headline
                    words = [w for w in words if w != "header"]
                if name == "article":  # an article may well be called anything, but a comment isn't one
                    words = [w for w in words if w.startswith(("comment", "repl"))]
                if not SIDE_WORDS.isdisjoint(words):
                    share = max(share, NAMED_SHARE if COMMENT_WORDS.isdisjoint(words) else COMMENT_SHARE)
    return False, share


def read_page(page: str) -> Page:
    """The blocks of text of a page, without scripts, styles and the head's texts."""
    found = Page()
    stack = [_Open("", 0, 0)]
    open_names: Counter[str] = Counter()
    held: list[str] = []
    linked = 0

    def close() -> None:
        nonlocal linked
        text = " ".join("".join(held).split())
        if text:
            at = stack[-1]
            found.blocks.append(Block(text, at.path, at.element, at.side, linked, at.named))
        held.clear()
        linked = 0

    def leave(place: int) -> None:
        for element in stack[place:]:
            open_names[element.name] -= 1
        del stack[place:]

    def say(raw: str) -> None:
        nonlocal linked
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            held.append(text)
            if stack[-1].in_link:
                linked += len(text)

    at, size = 0, len(page)
    while at < size:
        start = page.find("<", at)
        token = _TOKEN.match(page, start) if start >= 0 else None
        if start >= 0 and token is None:  # a bare sign
            say(page[at : start + 1])
            at = start + 1
            continue
        say(page[at : start if start >= 0 else size])
        if token is None:
            break
        at = token.end()
        name = token[2] or token[5]
        if name is None:
            if token[0].startswith("<![CDATA["):
                say(html.escape(token[0][9:].removesuffix("]]>")))
            continue
        name = name.lower()
        if token[1] or token[4]:
            # An end without a start is not looked for.
            place = next(i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name) if open_names[name] else 0
            if name == "br" or (name == "p" and not place):
                held.append(" ")
            if place:
                if any(e.name not in INLINE for e in stack[place:]):
                    close()
                leave(place)
            continue
        if name in UNREAD:
            end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if name in VOID:
            if name == "br":
                held.append(" ")
            elif name == "hr":
                close()
            continue
        if name not in INLINE:
            close()
            ends = SAME_ENDS.get(name, ())
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name in ends or (stack[i].name == "p" and name in CLOSES_P):
                    leave(i)
                    break
                if stack[i].name in SCOPES:
                    break
        above = stack[-1]
        attributes = token[3] or token[6] or ""
        says, share = _markup_says(name, attributes, above.in_article)
        side, named = above.side or says or name == "head", above.named
        if share and not side:
            named = len(found.marks)
            found.marks.append(Mark(above.named, share))
        if named != above.named or side != above.side:
            close()  # what stands before it in the same block is not part of it
        inline = name in INLINE
        if inline and attributes.endswith("/"):
            continue
        element, path = above.element, above.path
        if not inline:
            element, path = len(found.names), found.paths.setdefault((above.path, name), len(found.paths) + 1)
            found.parents.append(above.element)
            found.names.append(name)
        open_names[name] += 1
        if name in ("article", "main"):
            found.marks[named].articles += 1
            found.marks[named].has_main |= name == "main"
        stack.append(_Open(name, element, path, side, named, above.in_link or name == "a", above.in_article or name in ("article", "main")))
    close()
    return found


def score_blocks(page: list[Block]) -> None:
    """Fused and smoothed path ratios of the blocks that may belong to an article."""
    count: dict[int, int] = defaultdict(int)
    chars: dict[int, int] = defaultdict(int)
    marks: dict[int, int] = defaultdict(int)
    linked: dict[int, int] = defaultdict(int)
    for block in page:
        if not block.side:
            count[block.path] += 1
            chars[block.path] += len(block.text)
            marks[block.path] += len(_PUNCTUATION.findall(block.text))
            linked[block.path] += block.linked
    raw = []
    for block in page:
        n = count.get(block.path)
        if block.side or not n or linked[block.path] > LINK_SHARE * chars[block.path]:
            raw.append(0.0)
        else:
            raw.append(chars[block.path] / n * (1 + marks[block.path] / n))
    reach = len(SMOOTHING) // 2

    def smoothed(values: list[float]) -> list[float]:
        sums = [sum(SMOOTHING[j + reach] * values[i + j] for j in range(-reach, reach + 1) if 0 <= i + j < len(values)) for i in range(len(values))]
        return [total if value else 0.0 for total, value in zip(sums, values)]

    for block, value in zip(page, smoothed(raw)):
        block.score = value
    unmarked = [i for i, block in enumerate(page) if not block.side]
    for i, value in zip(unmarked, smoothed([raw[i] for i in unmarked])):
        page[i].alone = value


def weigh_names(read: Page) -> None:
    """Set aside the blocks under a name, unless the ratios speak against the name.

    They do where an element so named holds a ``main``, or most of the text that is selected if no name counts, as long as no article stands outside it. If
    all of that text stands under names, the one that holds the most counts for nothing, unless it is one of comments.
    """
    marks = read.marks
    if len(marks) == 1:
        return
    score_blocks(read.blocks)
    best = max((b.score for b in read.blocks), default=0.0)
    held, articles, has_main = [0] * len(marks), [m.articles for m in marks], [m.has_main for m in marks]
    for block in read.blocks:
        if block.score >= THRESHOLD * best > 0:
            held[block.named] += len(block.text)
    for i in range(len(marks) - 1, 0, -1):  # what an inner mark holds, the outer ones hold, too
        above = marks[i].parent
        held[above] += held[i]
        articles[above] += articles[i]
        has_main[above] |= has_main[i]
    outermost = [i for i in range(1, len(marks)) if marks[i].parent == 0]
    fullest = max((i for i in outermost if marks[i].share < COMMENT_SHARE), key=held.__getitem__, default=0)
    if sum(held[i] for i in outermost) < held[0]:
        fullest = 0
    counts = [False] * len(marks)
    for i in range(1, len(marks)):
        most = held[i] >= marks[i].share * held[0] > 0 and articles[i] == articles[0]
        counts[i] = counts[marks[i].parent] or not (has_main[i] or most or i == fullest)
    for block in read.blocks:
        block.side = block.side or counts[block.named]


def main_text(page: str | None) -> str:
    """Text of the article of a page, blocks joined by a blank; empty if there is none."""
    read = read_page(page) if page else Page()
    weigh_names(read)
    score_blocks(read.blocks)
    best = max((b.score for b in read.blocks), default=0.0)
    if best <= 0:
        return ""
    # An element holds what stands in it and in the elements inside it, whose numbers follow its own.
    size = len(read.names)
    holds, several, last = [0] * size, [0] * size, list(range(size))
    selected, others = [0] * size, [0] * size
    for block in read.blocks:
        several[block.element] += not block.side
        if block.score >= THRESHOLD * best:
            holds[block.element] += len(block.text)
        # A first or last paragraph may stand next to a marked block, so that smoothing lowers its score.
        if block.alone >= THRESHOLD * best:
            selected[block.element] += 1
        elif not block.side and read.names[block.element] not in HEADINGS:
            others[block.element] += 1
    for element in range(size - 1, 0, -1):
        parent = read.parents[element]
        holds[parent] += holds[element]
        several[parent] += several[element]
        selected[parent] += selected[element]
        others[parent] += others[element]
        last[parent] = max(last[parent], last[element])
    # Those that hold enough stand one inside the other.
    holders = [e for e in range(1, size) if holds[e] >= MOST_TEXT * holds[0]]
    named = [e for e in holders if read.names[e] in ("article", "main")]
    article = max(named, default=max((e for e in holders if several[e] > 1), default=0))
    lists = read.names[article] not in WHOLE_PAGE  # a list of links belongs to an article, but not to a page's text
    around = article
    while around and not named:
        # Outwards, as long as no block is added that is neither above the threshold nor marked as something else.
        around = read.parents[around]
        if others[around] > others[article]:
            break
        if selected[around] > selected[article]:
            article = around
    inside = [article <= b.element <= last[article] for b in read.blocks]
    headline = [read.names[b.element] == "h1" for b in read.blocks]
    if not any(i and h for i, h in zip(inside, headline)):
        # It may stand before the element that holds the text.
        first = inside.index(True)
        inside = [i or (at < first and h) for at, (i, h) in enumerate(zip(inside, headline))]
    return " ".join(b.text for i, b in zip(inside, read.blocks) if i and not b.side and (lists or b.score > 0))


def extract(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every page, from its whole markup.

    A null or empty page has an empty text, and so has one without an article. Ids and urls
    are passed on as they are, nulls included; repeated rows stay. A page is one row's work; nothing is shuffled.
    """

    def run(batches):
        for batch in batches:
            texts = [main_text(page) for page in batch.column(2).to_pylist()]
            lengths = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), lengths], ["page_id", "url", "text", "n_chars"])

    columns = pages.select(
        F.col(f"`{id_column}`").cast("long").alias("page_id"), F.col(f"`{url_column}`").cast("string").alias("url"), F.col(f"`{html_column}`").cast("string").alias("html")
    )
    return columns.mapInArrow(run, "page_id long, url string, text string, n_chars long")
