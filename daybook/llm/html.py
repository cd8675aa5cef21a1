"""Blocks of a web page: a tolerant reader of HTML that keeps block structure and decodes text."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

#: Fixed values of HTML: elements without content, with raw content, inline ones, and those that end an open paragraph.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg math object select".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var ruby rt rp img br wbr".split()
)
ENDS_ALIKE = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
}
#: What is never part of an article: by element, by role, and by a word of a class or id.
ASIDE = frozenset("head nav footer aside form button dialog menu fieldset".split()) | RAW
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar "
    "navigation menu breadcrumb breadcrumbs sidebar widget footer cookie cookies consent gdpr notice alert newsletter "
    "subscribe subscription signup popup modal overlay social share sharing related recommended comment comments "
    "disqus respond replies reply login search pagination pager skip toolbar".split()
)
#: These count only outside of an article, which may have a heading of its own.
HEAD_WORDS = frozenset("header masthead topbar".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    # A quoted value may hold ">"; a quote that is never closed is a sign like any other. Possessive, hence linear.
    r"|<(?P<close>/)?(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+(?=>)|[^>]*+)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"(?<![a-zA-Z-])([a-zA-Z-]++)\s*+=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))")
_PART = re.compile(r"[a-z0-9]+")


@dataclass
class Node:
    """A block element, or a leaf that holds the text of one block."""

    label: str
    depth: int = 0
    aside: int = 0  # depth of the deepest element on the way here that its mark-up sets apart, 0 for none
    article: int = 0
    text: str | None = None
    linked: int = 0  # characters of the text that stand in links
    children: list[Node] = field(default_factory=list)


def read(page: str) -> Node:
    """The block tree of a page. Leaves are blocks of text with references decoded and white space made single."""
    root = Node("page")
    stack: list[tuple[str, Node]] = [("", root)]  # inline elements are on it with the block that holds them
    pending: list[str] = []
    links = linked = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(pending).split())
        pending.clear()
        if text:
            block = stack[-1][1]
            block.children.append(Node("#", block.depth + 1, block.aside, block.article, text, min(linked, len(text))))
        linked = 0

    def pop_to(depth: int) -> None:
        nonlocal links
        if any(tag not in INLINE for tag, _ in stack[depth:]):
            flush()
        links -= sum(tag == "a" for tag, _ in stack[depth:])
        del stack[depth:]

    at, lower = 0, None
    while found := _TOKEN.search(page, at):
        pending.append(html.unescape(page[at : found.start()]))
        linked += len(pending[-1]) if links else 0
        at = found.end()
        tag, closing, rest = (found["tag"] or "").lower(), found["close"], found["rest"] or ""
        if not tag:
            continue
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    pop_to(depth)
                    break
                if tag in INLINE and stack[depth][0] not in INLINE:
                    break
            continue
        if tag == "br":
            pending.append(" ")
            continue
        if tag in RAW:
            if rest.rstrip().endswith("/") and tag not in ("script", "style"):
                continue
            lower = lower if lower is not None else page.lower()
            stop = lower.find(f"</{tag}", at)
            at = len(page) if stop < 0 else (page.find(">", stop) + 1 or len(page))
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag in INLINE:
            stack.append((tag, stack[-1][1]))
            links += tag == "a"
            continue
        flush()
        ends = ENDS_ALIKE.get(tag)
        for depth in range(len(stack) - 1, 0, -1):
            open_tag = stack[depth][0]
            if open_tag == "p" or (ends and open_tag in ends):
                pop_to(depth)
            elif open_tag not in INLINE:
                break
        parent = stack[-1][1]
        node = Node(*described(tag, rest, parent))
        parent.children.append(node)
        stack.append((tag, node))
    pending.append(html.unescape(page[at:]))
    flush()
    return root


def described(tag: str, rest: str, parent: Node) -> tuple[str, int, int, int]:
    """Label and depth of a block element, where it is set apart, and whether it is an article (2) or in main (1)."""
    values = {a.lower(): b or c or d for a, b, c, d in _ATTRIBUTE.findall(rest)} if "=" in rest else {}
    name = f"{values.get('class', '')} {values.get('id', '')}".lower().strip()
    words, role = set(_PART.findall(name)), values.get("role", "").lower()
    aside = tag in ASIDE or role in ROLES or not words.isdisjoint(WORDS)
    if not parent.article and (tag == "header" or not words.isdisjoint(HEAD_WORDS)):
        aside = True
    if "hidden" in rest.lower().split() or values.get("aria-hidden") == "true":
        aside = True
    article = max(parent.article, 2 if tag == "article" else 1 if tag == "main" or role == "main" else 0)
    label = f"{tag}.{' '.join(sorted(words))}" if words else tag
    return label, parent.depth + 1, parent.depth + 1 if aside else parent.aside, article


def leaves(node: Node, path: str = ""):
    """Text leaves in page order, each with the labels on the way to it."""
    stack = [(node, path)]
    while stack:
        current, above = stack.pop()
        if current.text is not None:
            yield current, above
        else:
            stack.extend((child, f"{above}/{current.label}") for child in reversed(current.children))


def main_leaves(root: Node) -> list[tuple[Node, str]]:
    """The leaves beside which nothing speaks: those of articles, else of the main part, else of the page."""
    return among(leaves(root))


def among(found) -> list[tuple[Node, str]]:
    open_ = [(leaf, path) for leaf, path in found if not leaf.aside]
    deepest = max((leaf.article for leaf, _ in open_), default=0)
    return [(leaf, path) for leaf, path in open_ if leaf.article == deepest]
