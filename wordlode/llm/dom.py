"""A forgiving reader of HTML: the text blocks of a page with the elements around them."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

import xxhash

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|</[^a-zA-Z>][^>]*>?|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>?",
    re.S,
)
_ATTRIBUTE = re.compile(r"(?i)(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_DIGITS = re.compile(r"\d+")

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# Their content is no markup.
RAW = set("script style textarea title xmp iframe noembed noframes noscript template".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
# A start tag closes open elements of these kinds, up to the nearest element that holds them.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
}
# Elements that are no part of an article, by tag, role, or a whole name in class or id.
NOT_CONTENT = set(
    "nav aside footer head button select option input menu dialog svg math object canvas audio video".split()
) | RAW
ROLES = set(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split()
)
MARKS = set(
    "ad ads adv advert adverts advertisement adbox adsbygoogle sponsor sponsored promo promotion banner "
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead topbar cookie cookies consent "
    "gdpr notice notices alert popup modal overlay newsletter subscribe signup share sharing social related "
    "recommended comment comments commentlist reply replies respond disqus form search login pagination pager "
    "toolbar widget skip".split()
)
# Words that say where or what part, and mean nothing by themselves: comments-area, main-menu.
FRAME = set(
    "area section list wrap wrapper container box block bar panel inner outer main site page top bottom left right "
    "primary secondary global mobile user post thread".split()
)
# Marks that no inner article and no size outweighs as long as there is other text.
FIRM = set(
    "comment comments commentlist reply replies respond disqus nav navbar navigation menu cookie cookies consent gdpr".split()
)
# Content by themselves (an article may have them), none with a word of FRAME: site-header.
ENDS = {"header", "footer"}
_WORDS = re.compile(r"[a-z]+")
# Words of a text for its size; each sign of Chinese or Japanese is one.
_SIZE = re.compile(r"[\u3040-\u30ff\u3400-\u9fff]|\w+")


@dataclass
class Element:
    tag: str
    label: str
    path: int  # hash of the labels from the root
    inline: bool
    drop: bool  # not content by tag or role, or inside such an element
    form: bool  # inside a form
    marks: tuple[int, ...]  # elements around it, and itself, that are not content by class or id
    articles: tuple[int, ...]  # articles around it, and itself, outermost first
    children: list[str] = field(default_factory=list)


@dataclass
class Block:
    text: str
    paths: tuple[int, ...]  # block elements around it, outermost first
    drop: bool
    form: bool
    articles: tuple[int, ...]


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _size(text: str) -> int:
    return len(_SIZE.findall(text))


def _marked(names: str) -> tuple[bool, bool]:
    """Whether a whole name is made of marks, and whether it is firm: cookie-notice is both, with-sidebar neither."""
    marked = firm = False
    for name in names.split():
        words = set(_WORDS.findall(name))
        marks = words & MARKS
        if words <= MARKS | FRAME and marks or words <= ENDS | FRAME and words & ENDS and words & FRAME:
            marked, firm = True, firm or not marks.isdisjoint(FIRM)
    return marked, firm


def _lifted(raw: list[tuple], inside: list[bool], firm: list[bool], holds: set[int]) -> set[int]:
    """Marked elements that count as content all the same.

    One that holds an article, and one that holds most of the text; outside articles
    the latter only if no article has text. Firm ones, and what is in them, only if there
    is no other text.
    """
    if not inside:
        return set()
    open_parts = [(p, articles) for p, _, drop, _, articles in raw if not drop]
    clean = any(a and not marks and not text.isspace() for p, a in open_parts for text, marks in p)
    if clean and not any(inside):
        return holds
    parts = [(text, marks) for p, _ in open_parts for text, marks in p]
    loose = [(text, marks) for text, marks in parts if not any(firm[m] for m in marks)]
    if any(text and not text.isspace() for text, _ in loose):
        parts = loose
    sizes, total = Counter(), 0
    for text, marks in parts:
        size = _size(text)
        total += size
        sizes.update(dict.fromkeys(marks, size))
    return holds | {m for m, size in sizes.items() if 2 * size > total and (inside[m] or not clean)}


def read(page: str | None) -> tuple[list[Block], list[tuple[int, int]]]:
    """Text blocks in page order, and (path, style) of each block element.

    The style of an element is the sequence of its children that are block
    elements. Character references are decoded, white space is one blank.
    Unclosed, misnested and cut tags are taken as browsers mostly take them.
    """
    page = page or ""
    root = Element("", "", 0, False, False, False, (), ())
    stack, raw, styles = [root], [], []
    run: list[tuple[str, tuple[int, ...]]] = []
    # Of each marked element whether it is inside an article, and firm; those that hold an article; number of articles.
    inside: list[bool] = []
    firm: list[bool] = []
    holds: set[int] = set()
    articles_met = 0

    def flush() -> None:
        if run:
            holders = [e for e in stack if not e.inline]
            last = holders[-1]
            raw.append((run[:], tuple(e.path for e in holders), last.drop, last.form, last.articles))
            run.clear()

    # Text of dropped inline elements is left out of the block around them.
    def say(text: str) -> None:
        if text and not (stack[-1].inline and stack[-1].drop and not _block_of(stack).drop):
            run.append((html.unescape(text), stack[-1].marks))

    def close(element: Element) -> None:
        if not element.inline:
            styles.append((element.path, _hash("\n".join(element.children))))

    def pop_to(depth: int) -> None:
        while len(stack) > depth:
            if not stack[-1].inline:
                flush()
            close(stack.pop())

    at = 0
    while True:
        match = _TAG.search(page, at)
        if match is None:
            say(page[at:])
            break
        say(page[at : match.start()])
        at = match.end()
        name = (match[2] or "").lower()
        if not name:
            if match[0].startswith("<![CDATA["):
                run.append((match[0][9:].removesuffix("]]>"), stack[-1].marks))
            continue
        if match[1]:
            if name == "br":
                flush()
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == name:
                    pop_to(depth)
                    break
                # An inline end tag does not reach out of the block it stands in.
                if name in INLINE and not stack[depth].inline:
                    break
            continue
        inline = name in INLINE
        if not inline:
            flush()
            kinds, holders = CLOSES.get(name, ({"p"}, {"table", "td", "th", "button", "object"}))
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in holders:
                    break
                if stack[depth].tag in kinds or stack[depth].tag == "p":
                    pop_to(depth)
        parent, holder = stack[-1], _block_of(stack)
        found = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(match[3] or "")}
        marks = found.get("class", "") + " " + found.get("id", "")
        drop = (
            parent.drop or name in NOT_CONTENT or found.get("role") in ROLES
            or (name == "header" and not parent.articles)
        )
        around, articles = parent.marks, parent.articles
        marked, is_firm = _marked(marks) if name not in ("html", "body", "main") else (False, False)
        if marked:
            around += (len(inside),)
            inside.append(bool(articles))
            firm.append(is_firm)
        # What a reader wrote may stand in an article of its own.
        begins = name in ("article", "main") and not drop and not any(firm[m] for m in around)
        if begins and not marked:
            holds.update(m for m in around if not inside[m])
        if begins:
            articles += (articles_met,)
            articles_met += 1
        label = name if inline else _DIGITS.sub("0", f"{name}.{marks.strip()}")
        element = Element(
            name, label, parent.path if inline else _hash(f"{holder.path}/{label}"), inline, drop,
            parent.form or name == "form", around, articles,
        )
        if not inline:
            holder.children.append(label)
        if name in RAW:
            end = re.compile(rf"(?i)</{re.escape(name)}(?=[\s/>]|\Z)").search(page, at)
            if not inline:
                styles.append((element.path, 0))
            if end is None:
                break
            rest = page.find(">", end.end())
            at = len(page) if rest < 0 else rest + 1
        elif name not in VOID and not (match[3] or "").endswith("/"):
            stack.append(element)
    pop_to(1)
    flush()
    lifted, blocks = _lifted(raw, inside, firm, holds), []
    for parts, paths, *kind in raw:
        text = " ".join("".join(t for t, marks in parts if lifted.issuperset(marks)).split())
        if text:
            blocks.append(Block(text, paths, *kind))
    return blocks, styles


def _block_of(stack: list[Element]) -> Element:
    for element in reversed(stack):
        if not element.inline:
            return element
    return stack[0]


def content(blocks: list[Block]) -> list[Block]:
    """Blocks that can be main text by the kind of the elements around them.

    Text in a form counts if there is nothing else (some pages are one form),
    text outside an article if no article holds at least half of the text.
    """
    left = [b for b in blocks if not b.drop]
    left = [b for b in left if not b.form] or left
    if all(b.articles for b in left) or not any(b.articles for b in left):
        return left
    sizes, total = Counter(), 0
    for block in left:
        size = _size(block.text)
        total += size
        sizes.update(dict.fromkeys(block.articles, size))
    # Of nested articles of one size the outermost.
    most = max(sizes, key=lambda a: (sizes[a], -a))
    return [b for b in left if most in b.articles] if 2 * sizes[most] >= total else left


def normal(text: str) -> int:
    """A hash of a text block regardless of case and numbers."""
    return _hash(_DIGITS.sub("0", text.lower()))
