"""Pages as sequences of leaf blocks: what is between two borders of block elements, with the path of tags to it.

Tags of phrases (``b``, ``a``, ``span``, ``br`` and the like) do not end a block. Elements that a page leaves open are
closed where HTML closes them (a paragraph by the next block element, an item by the next item); an end tag without a
start is a border only. Comments, scripts, styles, the head and other elements that show no text give no block; an
unfinished comment or script takes the rest of the page, as in browsers, and an unfinished tag at the end is dropped.
As in browsers, elements are followed 512 deep; a path names the outermost 8 and the innermost 24 of them.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache
from html import unescape
from typing import NamedTuple

# Names of HTML elements.
PHRASE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter nobr "
                   "picture progress q rp rt ruby s samp small source span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = ("script", "style", "template", "noscript", "iframe", "object", "svg", "math", "canvas", "audio", "video", "textarea", "select", "title")
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
          "option": ("option",), "body": ("head",)}
#: Elements in which an item of a list or a table is looked for.
SCOPES = frozenset("ul ol dl table tbody thead tfoot menu".split())

DEEPEST, OUTER, INNER = 512, 8, 24

TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    rf"|<(?P<unseen>{'|'.join(UNSEEN)})(?=[\s/>])(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=unseen)(?=[\s/>])[^>]*+(?:>|\Z)|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][^\s/>]*+)(?P<more>(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[!?/](?=[^\s])[^>]*+(?:>|\Z)"
    r"|</?[a-z][^>]*+(?:>|\Z)"
    r"|[^<]++|<", re.S | re.I)
NAMED = re.compile(r"""\b(class|id|role|itemprop)\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s"'>]++))""", re.I)
PART = re.compile(r"[a-z]+|[0-9]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Leaf(NamedTuple):
    #: Elements from the outermost: (tag, words of its class, id, role and property).
    path: tuple[tuple[str, tuple[str, ...]], ...]
    text: str
    #: Characters inside links.
    linked: int


@lru_cache(4096)
def names_of(more: str) -> tuple[str, ...]:
    """The words of the attributes that name an element."""
    found = []
    for _, *values in NAMED.findall(more):
        for word in PART.findall(CAMEL.sub(" ", "".join(values)).lower()):
            if word not in found:
                found.append(word)
    return tuple(found)


def leaves(html: str) -> list[Leaf]:
    """The leaf blocks of a page in order. White space inside a block is one space; blocks without text are none."""
    found: list[Leaf] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    open_: Counter[str] = Counter()
    parts, linked, links = [], 0, 0

    def border() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text and not open_["head"]:
                path = stack if len(stack) <= OUTER + INNER else stack[:OUTER] + stack[-INNER:]
                found.append(Leaf(tuple(path), text, min(linked, len(text))))
        parts, linked = [], 0

    def close(at: int) -> None:
        open_.subtract(tag for tag, _ in stack[at:])
        del stack[at:]

    for token in TOKEN.finditer(html):
        name = token["name"]
        if name is None:
            text = token[0]
            if text[0] != "<" or len(text) == 1:
                parts.append(text)
                if links:
                    linked += len(text)
            elif token["unseen"] is not None and token["unseen"].lower() not in PHRASE:
                border()
            continue
        name = name.lower()
        if name in PHRASE:
            if name == "a":
                links = 0 if token["end"] else 1
            elif name in ("br", "img"):
                parts.append(" ")
            continue
        border()
        if token["end"]:
            if open_[name] > 0:
                close(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name))
                links = 0
            continue
        if stack and stack[-1][0] == "p":
            close(len(stack) - 1)
        if any(open_[tag] > 0 for tag in CLOSES.get(name, ())):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in CLOSES[name]:
                    close(i)
                elif stack[i][0] in SCOPES:
                    break
        if name not in VOID and not token["more"].endswith("/") and len(stack) < DEEPEST:
            stack.append((name, names_of(token["more"])))
            open_[name] += 1
    border()
    return found
