"""One page of HTML as text blocks with the structural path each stands on. Plain Python, linear time."""

import html
import re
from dataclasses import dataclass
from itertools import takewhile

import xxhash

BOILER, MAIN, HEADING, MARKED, STAYS = 1, 2, 4, 8, 16

# Element names by what they mean for a text.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr "
    "math maction merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle "
    "msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe noembed noframes template xmp svg select object canvas".split())
DROPPED = frozenset("nav footer aside button dialog menu fieldset head".split())
CONTAINERS = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NEVER_BOILER = frozenset("html body article main".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main "
    "menu nav ol p pre section table ul".split()
)
# An open element that a new one of the same group closes, unless one of the limits lies between.
SIBLINGS = {name: group for group in (("li",), ("dt", "dd"), ("tr",), ("td", "th"), ("option",)) for name in group}
LIMITS = frozenset("ul ol dl table tbody thead tfoot tr select article section div".split())
# Words in class, id or role that mark what is not the article.
BOILER_WORDS = frozenset(
    "nav navbar navigation menu topbar masthead footer sidebar aside widget widgets notice notices cookie cookies consent gdpr "
    "banner ad ads advert adverts advertisement advertising sponsor sponsored promo promotion comment comments commentlist "
    "respond replies reply disqus form newsletter subscribe subscription signup login share sharing social related breadcrumb "
    "breadcrumbs pagination pager popup modal overlay search skip".split()
)
# Words, and whole names, whose mark holds for an article below too: articles there are comments or teasers.
STAYING_WORDS = frozenset(
    "comment comments commentlist respond replies reply disqus related widget widgets ad ads advert adverts advertisement "
    "advertising sponsor sponsored promo promotion".split()
)
STAYING_NAMES = frozenset("sidebar aside".split())
NOT_A_WORD_OF_ITS_OWN = frozenset("has with no is without".split())  # nor is what follows it
MOST = 0.5  # share of the page's text above which a marked wrapper is no boilerplate

TAG = re.compile(
    r"""<!--(?:.*?--!?>|.*)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']++|"[^"]*"|'[^']*')*+)(?P<close>>|\Z)"""
    r"""|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?P<close2>>|\Z)|<[!?/][^>]*(?:>|\Z)""",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role|itemprop|hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/]|$|["'])""", re.I)
DIGITS = re.compile(r"\d+")


@dataclass(slots=True)
class Block:
    text: str
    path: int
    flags: int
    link_chars: int
    place: int = 0  # in the page, behind the element it stands in and before what follows


def _path(parent: int, key: str) -> int:
    return xxhash.xxh64_intdigest(f"{parent}/{key}") >> 1


def _look(name: str, attrs: str) -> tuple[str, int]:
    """The element's name with its class and id, digits masked, and its own flags."""
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attrs)} if attrs.strip(" /") else {}
    names = f"{found.get('id', '')} {found.get('class', '')}".lower()
    flags = BOILER if name in DROPPED else MAIN if name in CONTAINERS else HEADING if name in HEADINGS else MARKED if name == "form" else 0
    role = found.get("role", "").lower()
    if role == "main" or found.get("itemprop", "").lower() == "articlebody":
        flags |= MAIN
    if "hidden" in found or role in ("navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog"):
        flags |= BOILER
    elif role == "form":
        flags |= MARKED
    if name not in ("html", "body", "main"):
        for token in names.split():
            words = list(takewhile(lambda word: word not in NOT_A_WORD_OF_ITS_OWN, re.split(r"[-_]+", token)))
            if not BOILER_WORDS.isdisjoint(words):
                flags |= MARKED
                if token in STAYING_NAMES or not STAYING_WORDS.isdisjoint(words):
                    flags |= STAYS
    key = f"{name} {DIGITS.sub('0', names).strip()} {role}"
    return key, flags


def parse(page: str) -> tuple[list[Block], dict[int, tuple[int, int, int, int]]]:
    """Non-empty text blocks in page order, and the structural elements by path:
    ``(parent path, flags, occurrences, first place)``.

    Inline elements neither end a block nor appear in paths. Comments, scripts, styles and other
    elements without text are skipped; what is open at the end of the page is closed there. A
    ``header`` is the article's own inside an article and dropped elsewhere.

    Elements such as ``nav`` and hidden ones are boilerplate with all below them. A form, a class, id or
    role is a weaker mark: it does not pass to an article or main element below, unless its words
    name comments, teasers or adverts, and it does not hold at all for a wrapper with more than ``MOST`` of the
    text that stands outside of the former.
    """
    blocks: list[Block] = []
    elements: dict[int, tuple[int, int, int, int]] = {}
    stack: list[tuple[str, int, int, int]] = [("", 0, 0, 0)]  # name, path, flags with those above, nearest mark
    marks: list[list[int]] = [[0, 0, 0]]  # mark above, flag that holds (MARKED, STAYS or none), characters
    block_marks: list[int] = []
    element_marks: dict[int, set[int]] = {}
    looks: dict[tuple[str, str], tuple[str, int]] = {}
    pieces: list[str] = []
    link_chars = links = 0
    position = 0

    def flush() -> None:
        nonlocal link_chars
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                blocks.append(Block(text, stack[-1][1], stack[-1][2], link_chars, position - 1))
                block_marks.append(stack[-1][3])
            pieces.clear()
        link_chars = 0

    def add(raw: str) -> None:
        nonlocal link_chars
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            pieces.append(text)
            if links:
                link_chars += len(text)

    def close(names: tuple[str, ...], limits: frozenset[str]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in names:
                del stack[i:]
                return
            if stack[i][0] in limits:
                return

    while position < len(page):
        m = TAG.search(page, position)
        if m is None:
            add(page[position:])
            break
        add(page[position : m.start()])
        position = m.end()
        name = m["name"] or m["name2"]
        if name is None or not (m["close"] or m["close2"]):
            continue  # a comment or declaration, or a tag that the page's end cuts off
        name = name.lower()
        ends = m["end"] or m["end2"]
        if name in INLINE:
            if name == "a":
                links = 0 if ends else 1
            continue
        flush()
        if ends:
            links = 0 if name in ("nav", "li", "ul", "div", "article") else links
            close((name,), frozenset())
            continue
        attrs = m["attrs"] or m["attrs2"] or ""
        if name in RAW:
            if not attrs.endswith("/") or name in ("script", "style", "title", "textarea"):
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, position)
                position = end.end() if end else len(page)
            continue
        if name in VOID:
            continue
        if name in CLOSES_P:
            close(("p",), LIMITS)
        if name in SIBLINGS:
            close(SIBLINGS[name], LIMITS - {"tr"} if name == "tr" else LIMITS)
        look = looks.get((name, attrs))
        if look is None:
            look = looks[name, attrs] = _look(name, attrs)
        _, above, inherited, mark = stack[-1]
        own = look[1] & (BOILER | MAIN | HEADING)
        flags = inherited | own
        if name == "header" and not inherited & MAIN:
            flags |= BOILER
        if mark and own & MAIN:
            marks.append([mark, 0, 0])
            mark = len(marks) - 1
        if look[1] & MARKED:
            marks.append([mark, look[1] & (MARKED | STAYS), 0])
            mark = len(marks) - 1
        path = _path(above, look[0])
        stack.append((name, path, flags, mark))
        _, _, count, first = elements.get(path, (0, 0, 0, position))
        elements[path] = (above, flags, count + 1, first)
        if mark:
            element_marks.setdefault(path, set()).add(mark)
    flush()
    if len(marks) > 1:
        _hold_marks(blocks, block_marks, elements, element_marks, marks)
    return blocks, elements


def _hold_marks(blocks: list[Block], block_marks: list[int], elements: dict, element_marks: dict, marks: list[list[int]]) -> None:
    """Add ``BOILER`` to what stands below a mark that holds. Marks come after those above them."""
    for block, mark in zip(blocks, block_marks):
        marks[mark][2] += 0 if block.flags & BOILER else len(block.text)
    for above, _, chars in reversed(marks[1:]):
        marks[above][2] += chars
    most = MOST * marks[0][2]
    holding = [0]
    for above, flag, chars in marks[1:]:
        if not flag:  # an article or main element
            holding.append(holding[above] & STAYS and MARKED | STAYS)
        else:
            holding.append(holding[above] | (flag if chars <= most else 0))
    for block, mark in zip(blocks, block_marks):
        block.flags |= BOILER if holding[mark] else 0
    for path, those in element_marks.items():
        if all(holding[mark] for mark in those):
            above, flags, count, first = elements[path]
            elements[path] = (above, flags | BOILER, count, first)
