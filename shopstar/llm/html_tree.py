"""A small HTML tree: block nodes with their text, inline tags merged into them.

Handles what pages in the wild hold: unclosed and stray tags, implied ends of
paragraphs, list items and table cells, raw text of scripts and styles,
comments, SVG and MathML with their self-closed tags, a page cut off anywhere.
One pass, no recursion, linear in the page: what an end tag closes is looked up
by name. Only elements whose content HTML itself reads as raw
text are passed over; all others are in the tree, and the model decides.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from dataclasses import dataclass, field

_TAG = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)"
                  r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[A-Za-z]+|\d+")

# HTML's own classes of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
#: Elements inside which tags follow XML's rules ("/>" closes, nothing is raw), those inside them that hold
#: HTML again, and the tags that end them where their own end is missing.
FOREIGN = frozenset(("svg", "math"))
HTML_AGAIN = frozenset(("foreignobject", "annotation-xml"))
#: Elements without content that stand in a line of text, as an image does in a word.
IN_LINE_VOID = VOID - frozenset(("br", "hr", "col"))
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt "
                   "ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption "
                     "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section "
                     "table ul".split())
LEAVES_FOREIGN = CLOSES_P | frozenset("b big body br code dd dt em embed head i img li meta nobr ruby s small span "
                                      "strike strong sub sup tt u var".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
            "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "body": ("head",),
            "tbody": ("tbody", "thead", "tr"), "thead": ("tbody", "tr"), "tfoot": ("tbody", "thead", "tr")}
SCOPES = frozenset("ul ol dl table select body html article section div".split())

# What elements and the words of their class, id and role say they are.
ROLE_OF_TAG = {
    "article": "main", "main": "main", "nav": "menu", "menu": "menu", "header": "header", "footer": "footer",
    "aside": "sidebar", "form": "form", "button": "form", "select": "form", "fieldset": "form",
    "textarea": "code", "script": "code", "style": "code", "noscript": "code", "template": "code",
    "iframe": "code", "svg": "code", "head": "code", "title": "code", "dialog": "notice"}
ROLE_OF_WORD = {w: role for role, words in {
    "main": "article main content entry post story maincontent articlebody",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc tabs topbar",
    "header": "header masthead banner logo", "footer": "footer foot copyright colophon",
    "sidebar": "sidebar aside widget related recommended recommendations share sharing social more trending popular",
    "notice": "cookie cookies consent gdpr notice notices alert popup modal newsletter subscribe paywall overlay "
              "disclaimer",
    "advert": "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promoted promotion",
    "form": "form search login signup", "comments": "comment comments reply replies respond disqus discussion",
}.items() for w in words.split()}


@dataclass
class Node:
    tag: str
    parent: int
    role: str = ""
    by_word: bool = False  # only words of its class, id or role attribute declare the role
    pieces: list = field(default_factory=list)  # (place in the page, text) directly inside
    link_chars: int = 0


def role_of(tag: str, attributes: str) -> tuple[str, bool]:
    """The role that an element declares, and whether only words of its class,
    id or role attribute do. They are looked at unless the tag has a role of
    its own; a compound's last word that is known is what it names
    ("post-comments": comments). A word of the main text counts beside others."""
    role = ROLE_OF_TAG.get(tag, "")
    if not attributes or role not in ("", "main"):
        return role, False
    found = set()
    for m in _ATTR.finditer(attributes):
        name, value = m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or ""
        if name == "hidden" or name == "style" and "display:none" in value.replace(" ", "").lower() \
                or name == "aria-hidden" and value == "true":
            return "code", False
        if name in ("class", "id", "role"):
            for word in value.split():
                known = [ROLE_OF_WORD[w.lower()] for w in _NAME.findall(word) if w.lower() in ROLE_OF_WORD]
                found.update(known[-1:])
    if not found:
        return role, False
    if "main" in found:
        return "main", not role
    return min(found), True


def parse(page: str) -> list[Node]:
    """Block nodes in page order, parents before children; node 0 is the page."""
    nodes = [Node("#page", -1)]
    stack: list[tuple[str, int]] = [("#page", 0)]  # open elements and their block node
    # places in the stack of the open elements of each name, and of all that are not inline
    opened: dict[str, list[int]] = defaultdict(list)
    blocks: list[int] = [0]
    at, place = 0, 0

    def text(value: str) -> None:
        nonlocal place
        if value:
            if "&" in value:
                value = html.unescape(value)
            node = nodes[stack[-1][1]]
            node.pieces.append((place, value))
            node.link_chars += len(value) if opened["a"] else 0
            place += 1

    def open_(tag: str, node: int) -> None:
        opened[tag].append(len(stack))
        if tag not in INLINE:
            blocks.append(len(stack))
        stack.append((tag, node))

    def close_to(depth: int) -> None:
        for tag, _ in reversed(stack[depth:]):
            opened[tag].pop()
        while blocks[-1] >= depth:
            blocks.pop()
        del stack[depth:]

    def nearest(tags) -> int:
        return max((opened[t][-1] for t in tags if opened.get(t)), default=0)

    def close(tags: tuple[str, ...], within: frozenset) -> None:
        k = nearest(tags)
        if k and k >= nearest(within):
            close_to(k)

    def foreign() -> int:
        """Place of the SVG or MathML element whose rules hold here, else 0."""
        k = nearest(FOREIGN)
        return k if k > nearest(HTML_AGAIN) else 0

    while (m := _TAG.search(page, at)) is not None:
        text(page[at:m.start()])
        at = m.end()
        if m.group(2) is None or not m.group(4):  # a comment, or cut off inside a tag
            continue
        tag, attributes = m.group(2).lower(), m.group(3)
        if m.group(1):
            if tag in VOID and tag != "br":
                continue
            k = nearest((tag,))
            if k and not (tag in INLINE and blocks[-1] > k):
                close_to(k)
            text(" " if tag not in INLINE else "")
            continue
        if tag not in INLINE and tag not in IN_LINE_VOID:
            text(" ")
        if tag in LEAVES_FOREIGN:
            while k := foreign():
                close_to(k)
        inside = foreign()
        if tag in VOID or (inside or tag in FOREIGN) and attributes.endswith("/"):
            continue
        if tag in CLOSES_P:
            close(("p",), frozenset(("button", "table", "td", "th")))
        if tag in SIBLINGS:
            close(SIBLINGS[tag], SCOPES - {"body", "html"} if tag != "body" else frozenset())
        role, by_word = role_of(tag, attributes)
        if tag in RAW and not inside:
            end = re.compile(f"</{re.escape(tag)}(?:[\\s/][^>]*)?>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if (tag in INLINE or tag == "math" or inside) and not role:
            open_(tag, stack[-1][1])
        else:
            nodes.append(Node(tag, stack[-1][1], role, by_word))
            open_(tag, len(nodes) - 1)
    text(page[at:] if not re.match(r"<[a-zA-Z/!?]", page[at:]) else "")
    return nodes


def joined(nodes: list[Node], chosen) -> str:
    """Text of the chosen nodes in page order, white space as one blank."""
    pieces = sorted(p for node, yes in zip(nodes, chosen) if yes for p in node.pieces)
    out, last = [], None
    for place, value in pieces:
        if last is not None and place != last + 1:
            out.append(" ")
        out.append(value)
        last = place
    return " ".join("".join(out).split())
