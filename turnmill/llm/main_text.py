"""Main text of HTML pages by line-block distribution.

Markup is stripped to lines, one per block element. The lengths of the lines, links not
counted, are summed over sliding windows of ``WINDOW`` lines. Where the sums surge over the
threshold a text begins, at the first line of its window that isn't blank; it ends where they
dive to nothing. The threshold is ``SURGE`` characters, but never more than the greatest
window of the page, so that a short page has a text as well.

Elements that can't hold main text are stripped like other markup and leave blank lines:
scripts, styles, forms, menus, page headers, footers, sidebars, and those whose class, id or
role says that they are adverts, notices, comments and the like, unless they hold the page's
article. Where a page has an article (or else main) element, only its lines have a length.

Null, empty and blank pages and pages of mere markup have an empty text. Markup may break off
anywhere: what is open is closed at the end, a tag or comment that breaks off is dropped.
Nothing depends on other rows, and the result is a Column, so other columns keep their names.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Lines of a window.
WINDOW = 3
#: Characters of a window where a text begins.
SURGE = 86
#: Texts besides the largest need this share of its greatest window.
SHARE = 0.25

# Kinds of elements.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p "
    "pre section summary table tbody tfoot thead tr ul".split()
)
#: Blocks that set their surroundings apart.
SECTIONS = frozenset("article aside body details dialog div footer form header main nav section table".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: White space between words that are set apart without a block of their own.
SPACES = frozenset("br td th".split())
NEVER = frozenset(
    "aside audio button canvas datalist dialog fieldset footer form frameset iframe label menu nav noscript object "
    "optgroup option select svg template video head".split()
)
#: Elements within a line: where they are furniture, their text is left out of the line.
INLINE = frozenset(
    "a abbr audio b bdi bdo big button canvas cite code data del dfn em font i ins kbd label mark optgroup option q s "
    "samp select small span strike strong sub sup svg time tt u var video".split()
)
#: An open paragraph ends where one of these begins.
ENDS_PARAGRAPH = BLOCKS - {"body", "html", "head", "caption", "legend", "option", "optgroup", "tbody", "thead", "tfoot", "tr"}
#: Elements of which one ends the last: the parents within which that holds.
ENDS_LIKE = {
    "li": frozenset(("ul", "ol", "menu")), "option": frozenset(("select",)), "dt": frozenset(("dl",)),
    "dd": frozenset(("dl",)), "tr": frozenset(("table",)), "td": frozenset(("tr", "table")), "th": frozenset(("tr", "table")),
}

# Words of class and id, and roles, of what is no main text.
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adbox adslot sponsor sponsored sponsors promo "
    "promos promoted promotion banner cookie cookies consent gdpr notice notices notification notifications alert "
    "alerts disclaimer newsletter subscribe subscription signup signin login sidebar sidebars aside rail widget "
    "widgets menu menus menubar nav navbar navigation navi breadcrumb breadcrumbs pagination pager paginator toolbar "
    "topbar footer footnav colophon comment comments commentlist respond replies discussion disqus share sharing "
    "social related recommended recommendations popup modal overlay paywall searchform searchbox copyright skiplink "
    "masthead".split()
)
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
PAGE_HEADERS = frozenset(("header", "topnav"))
#: With these words a class speaks of something else: no-sidebar, has-ads.
NOT_ITSELF = frozenset("no has with without".split())

# A quote opens a value only behind an equals sign.
_ATTRIBUTES = r"""((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|["'][^>]*+|[^\s"'>][^\s>]*+)?+)*+)"""
_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    rf"|<(script|style|textarea|title|xmp|noembed|noframes)(?=[\s/>]){_ATTRIBUTES}>.*?(?:</\1(?=[\s/>])[^>]*>|\Z)"
    rf"|<(/?)([a-z][^\s/>]*+){_ATTRIBUTES}>"
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
_TAG_STARTS = re.compile(r"<[a-z/!?]", re.I)
_NAMED = re.compile(r"""(?<![^\s"'/])(class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


@dataclass
class Element:
    """An open element that matters: one that hints at furniture, or one that names the main text."""

    parent: Element | None
    hint: bool
    root: str = ""
    length: int = 0
    holds_main: bool = False
    gone: bool = False
    #: Whether any element around it hints at furniture, and whether any names a main text.
    under_hint: bool = False
    under_root: bool = False

    def __post_init__(self):
        if self.parent is not None:
            self.under_hint = self.parent.hint or self.parent.under_hint
            self.under_root = bool(self.parent.root) or self.parent.under_root


@dataclass
class Lines:
    """Blocks of a page in order: text, characters outside links, the innermost element that matters.

    A line without text is blank; ``parted`` counts the blank lines before a line.
    """

    texts: list[str] = field(default_factory=list)
    lengths: list[int] = field(default_factory=list)
    within: list[Element | None] = field(default_factory=list)
    parted: list[int] = field(default_factory=list)
    elements: list[Element] = field(default_factory=list)


def _words(value: str) -> set[str]:
    return {w.lower() for w in _WORD.findall(value)}


def _matters(tag: str, attributes: str, within: Element | None) -> Element | None:
    named = {k.lower(): v.strip("\"'") for k, v in _NAMED.findall(attributes)} if "=" in attributes else {}
    role = named.get("role", "").lower()
    words = _words(named.get("class", "")) | _words(named.get("id", ""))
    hint = tag in NEVER or role in ROLES or (bool(words & HINTS) and not words & NOT_ITSELF)
    if not hint and (tag == "header" or (tag == "div" and words & PAGE_HEADERS)):
        # The header of an article is its title; that of a page is none of its text.
        hint = within is None or not (within.root or within.under_root)
    if tag in ("html", "body"):
        hint = False
    root = ""
    if tag == "article" or "articlebody" in named.get("itemprop", "").lower() or role == "article":
        root = "article"
    elif tag == "main" or role == "main":
        root = "main"
    if hint or root:
        return Element(within, hint, root)
    return None


def lines(page: str) -> Lines:
    """Strips markup to lines."""
    out = Lines()
    whole = page.rfind(">") + 1
    tail = page[whole:]
    broken = _TAG_STARTS.search(tail)
    if broken:  # a tag that breaks off at the end
        tail = tail[: broken.start()]
    stack: list[tuple[str, Element | None, bool]] = []  # open elements, what mattered around each, whether it is mute
    opened: dict[str, int] = {}
    within: Element | None = None
    parts: list[str] = []
    plain, blanks, links, mute = 0, 0, 0, 0

    def add(text: str) -> None:
        nonlocal plain
        if mute:
            return
        if "&" in text:
            text = entities.unescape(text)
        parts.append(text)
        if not links:
            plain += len(text.strip())

    def close_line() -> None:
        nonlocal plain, blanks
        text = " ".join("".join(parts).split())
        if text:
            length = min(plain, len(text))
            out.texts.append(text)
            out.lengths.append(length)
            out.within.append(within)
            out.parted.append(blanks)
            if within is not None:
                within.length += length
            blanks = 0
        parts.clear()
        plain = 0

    def forget(at: int) -> tuple[str, Element | None]:
        nonlocal links, mute
        tag, around, silent = stack.pop(at)
        opened[tag] -= 1
        links -= tag == "a"
        mute -= silent
        return tag, around

    def pop() -> str:
        nonlocal within
        tag, around = forget(-1)
        if tag in BLOCKS or around is not within:
            close_line()
        if around is not within:
            if within.root and not within.hint and around is not None:
                around.length += within.length
            within = around
        return tag

    def close(tag: str, until: frozenset = frozenset()) -> None:
        """Closes the last open element of a name, unless one of ``until`` stands between.

        An element within a line closes no blocks that were opened in it.
        """
        nonlocal blanks
        if not opened.get(tag):
            return
        inline = tag in INLINE
        if inline or any(opened.get(u) for u in until):
            for at in range(len(stack) - 1, -1, -1):
                name = stack[at][0]
                if name == tag:
                    break
                if name in until:
                    return
                if inline and name in BLOCKS:
                    while stack[at][0] != tag:
                        at -= 1
                    forget(at)
                    return
        while True:
            last = pop()
            if last in SECTIONS:
                blanks += 1
            if last == tag:
                return

    at = 0
    for found in _TOKEN.finditer(page, 0, whole):
        if found.start() > at:
            add(page[at : found.start()])
        at = found.end()
        tag = found.group(4)
        if tag is None:
            continue
        tag = tag.lower()
        if found.group(3):
            if tag == "p" and not opened.get("p"):
                close_line()
            close(tag)
            continue
        if tag in VOID:
            if tag == "hr":
                close_line()
            elif tag in SPACES:
                add(" ")
            continue
        if opened.get("head") and tag not in IN_HEAD:
            close("head")
        if tag in ENDS_PARAGRAPH and opened.get("p"):
            close("p", _BUTTONS)
        if tag in ENDS_LIKE:
            for like in ("td", "th") if tag in ("td", "th") else ("dt", "dd") if tag in ("dt", "dd") else (tag,):
                close(like, ENDS_LIKE[tag])
        attributes = found.group(5)
        element = _matters(tag, attributes, within) if tag in NEVER or tag in SECTIONS or "=" in attributes else None
        silent = element is not None and element.hint and tag in INLINE
        if silent:
            element = None
        if tag in BLOCKS or element is not None:
            close_line()
        elif tag in SPACES:
            add(" ")
        if tag in SECTIONS:
            blanks += 1
        stack.append((tag, within, silent))
        opened[tag] = opened.get(tag, 0) + 1
        links += tag == "a"
        mute += silent
        if element is not None:
            out.elements.append(element)
            within = element
    if at < whole:
        add(page[at:whole])
    if tail:
        add(tail)
    close_line()
    while stack:
        pop()
    return out


_BUTTONS = frozenset(("button", "object", "table", "td", "th", "caption"))
IN_HEAD = frozenset("base link meta noscript script style template title".split())


def _main_element(elements: list[Element]) -> Element | None:
    """The element that names the main text: the longest article, or else the longest main."""
    for without_hints in (True, False):
        roots = [e for e in elements if e.root and (not without_hints or not (e.hint or e.under_hint))]
        for kind in ("article", "main"):
            own = [e for e in roots if e.root == kind and e.length]
            if own:
                return max(own, key=lambda e: e.length)
    return None


def _lengths(found: Lines) -> tuple[list[int], bool]:
    """The length that counts of each line (-1: stripped), and whether an element names the main text."""
    main = _main_element(found.elements)
    above = main
    while above is not None:
        above.holds_main = True
        above = above.parent
    inside: dict[int, bool] = {}
    for e in found.elements:  # parents come first
        over = e.parent
        e.gone = (over.gone if over is not None else False) or (e.hint and not e.holds_main)
        alike = e.root and main is not None and e.root == main.root and not e.hint and 2 * e.length >= main.length
        inside[id(e)] = e is main or bool(alike) or (over is not None and inside[id(over)])
    out = []
    for length, within in zip(found.lengths, found.within, strict=True):
        if within is not None and within.gone:
            out.append(-1)
        elif main is not None:
            # In the article every line counts, links too: it is all one text.
            out.append(max(length, 1) if within is not None and inside[id(within)] else -1)
        else:
            out.append(length)
    return out, main is not None


def distribution(lengths: list[int]) -> list[int]:
    """Sums over windows of lines, each beginning at a line."""
    sums = [0]
    for length in lengths:
        sums.append(sums[-1] + length)
    n = len(lengths)
    return [sums[min(i + WINDOW, n)] - sums[i] for i in range(n)]


def surges(sums: list[int]) -> list[tuple[int, int, int]]:
    """(first, last, greatest sum) of the runs of lines between a surge and the dive after it."""
    out = []
    i, n = 0, len(sums)
    threshold = min(SURGE, max(sums, default=0))
    while i < n:
        if not sums[i]:
            i += 1
            continue
        end = i
        while end < n and sums[end]:
            end += 1
        if (top := max(sums[i:end])) >= threshold:
            out.append((i, end, top))
        i = end
    return out


def extract(page: str | None) -> str:
    """The main text of a page, its blocks joined by two line ends."""
    if not page:
        return ""
    found = lines(page)
    lengths, named = _lengths(found)
    # The lines as they stand on the page, with blank ones between sections.
    spread, texts = [], []
    for text, length, blanks in zip(found.texts, lengths, found.parted, strict=True):
        if length < 0:
            blanks += 1
        if not named:
            spread += [0] * blanks
            texts += [""] * blanks
        if length >= 0:
            spread.append(length)
            texts.append(text)
    runs = surges(distribution(spread))
    most = max((top for _, _, top in runs), default=0)
    kept: list[str] = []
    for first, last, top in runs:
        if top >= SHARE * most:
            # A window begins before its first line with a length; mere links there are no text.
            held = [i for i in range(first, last) if spread[i]]
            kept += [t for t in texts[held[0] : held[-1] + 1] if t]
    return "\n\n".join(kept)


def main_text(page: Column) -> Column:
    """The main text of a column of HTML pages; empty where there is none."""

    @F.arrow_udf("string")
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array([extract(x.as_py()) for x in column], pa.string())

    return run(page)
